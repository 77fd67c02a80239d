"""Queries of cataloguing, releases and incremental rebuilding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import publishing as p
from .base import derived, query, table


def _files(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("region"), F.format_string("%s-%06d.bin", "source", "doc_id").alias("name"), F.encode("text", "UTF-8").alias("content"))


@query("", "SELECT source AS region, printf('%s-%06d.bin', source, doc_id) AS name, CAST(octet_length(encode(text)) AS BIGINT) AS size, sha256(text) AS sha256 FROM documents")
def catalog(spark, sf_dir):
    return p.catalogued(_files(spark, sf_dir))


@query("", "WITH f AS (SELECT doc_id, octet_length(encode(text)) AS size FROM documents), n AS (SELECT *, CAST(ceil(size / 1000.0) AS BIGINT) AS n FROM f WHERE size > 0) SELECT doc_id, CAST(i AS BIGINT) AS piece, size * (i - 1) // n AS start, size * i // n AS stop FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM n)")
def pieces(spark, sf_dir):
    files = table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").cast("long").alias("size"))
    return p.pieces(files, 1000).select("doc_id", "piece", "start", "stop")


@query("", "WITH k AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS place FROM orders) SELECT o_custkey, o_orderkey FROM k WHERE place > 3")
def keep_newest(spark, sf_dir):
    return p.outdated(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], 3).select("o_custkey", "o_orderkey")


@query("", "SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def todo_anti(spark, sf_dir):
    return p.todo(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), ["doc_id"])


@query(
    "",
    """WITH a AS (SELECT o_orderstatus AS area, max(strftime(o_orderdate, '%y%m%d')) AS newest, max(strftime(o_orderdate, '%Y-%m-%d')) FILTER (o_orderpriority = '1-URGENT') AS published, bool_or(o_orderpriority = '2-HIGH') AS draft FROM orders GROUP BY 1)
    SELECT area, '20' || substr(newest, 1, 2) || '-' || substr(newest, 3, 2) || '-' || substr(newest, 5, 2) AS version, CASE WHEN draft THEN 'finish draft' WHEN published IS NULL THEN 'build' WHEN '20' || substr(newest, 1, 2) || '-' || substr(newest, 3, 2) || '-' || substr(newest, 5, 2) > published THEN 'build' ELSE 'nothing' END AS todo FROM a""",
)
def version_decision(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    state = o.groupBy(F.col("o_orderstatus").alias("area")).agg(
        F.max(F.date_format("o_orderdate", "yyMMdd")).alias("newest"), F.max(F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("published"), F.bool_or(F.col("o_orderpriority") == "2-HIGH").alias("draft")
    )
    return p.decided(state)


@query(
    "tiles_a",
    """WITH h AS (SELECT DISTINCT z, x, y, md5(data) AS h FROM tiles_a WHERE z = 9), n AS (SELECT a.x, a.y, string_agg(CAST(b.x - a.x AS VARCHAR) || ':' || CAST(b.y - a.y AS VARCHAR) || ':' || b.h, ',' ORDER BY b.x, b.y) AS s FROM h a JOIN h b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 GROUP BY a.x, a.y)
    SELECT x, y, sha1('v1|' || s) AS key FROM n""",
)
def cache_keys(spark, sf_dir):
    tiles = derived(spark, sf_dir, "tiles_a").where("z = 9").select("x", "y", F.md5("data").alias("hash")).distinct()
    return p.cache_keys(tiles, "v1")


@query("", "SELECT doc_id, CASE WHEN n_chars < 60 THEN 'seconds' WHEN CAST(round_even(n_chars / 60.0, 0) AS INT) < 3 THEN 'a minute or two' WHEN CAST(round_even(n_chars / 60.0, 0) AS INT) < 100 THEN 'about ' || CAST(round_even(n_chars / 60.0, 0) AS INT) || ' minutes' ELSE 'about ' || CAST(round_even(n_chars / 3600.0, 0) AS INT) || ' hours' END AS said, printf('%dh%02dm', n_chars // 3600, (n_chars % 3600) // 60) AS elapsed FROM documents")
def durations(spark, sf_dir):
    s = F.col("n_chars")
    return table(spark, sf_dir, "documents").select("doc_id", p.usually(s).alias("said"), p.elapsed(s).alias("elapsed"))


@query("nodes", "SELECT ref, CASE WHEN lat_e7 >= 0 THEN 'N' ELSE 'S' END || lpad(CAST(abs(CAST(floor(lat_e7 / 1e7) AS INT)) AS VARCHAR), 2, '0') || CASE WHEN lon_e7 >= 0 THEN 'E' ELSE 'W' END || lpad(CAST(abs(CAST(floor(lon_e7 / 1e7) AS INT)) AS VARCHAR), 3, '0') AS tile FROM nodes")
def tile_names(spark, sf_dir):
    return derived(spark, sf_dir, "nodes").select("ref", p.degree_tile(F.col("lat_e7") / 1e7, F.col("lon_e7") / 1e7).alias("tile"))


@query("nodes", "SELECT ref % 10 AS area, CAST(min(lat_e7) AS BIGINT) AS south, CAST(max(lat_e7) AS BIGINT) AS north, CAST(min(lon_e7) AS BIGINT) AS west, CAST(max(lon_e7) AS BIGINT) AS east FROM nodes GROUP BY 1")
def area_bounds(spark, sf_dir):
    return derived(spark, sf_dir, "nodes").groupBy((F.col("ref") % 10).alias("area")).agg(*(f(c).cast("long").alias(n) for f, c, n in ((F.min, "lat_e7", "south"), (F.max, "lat_e7", "north"), (F.min, "lon_e7", "west"), (F.max, "lon_e7", "east"))))


@query("", "SELECT s_suppkey AS area, CASE WHEN s_nationkey % 2 = 0 THEN 'Contains OS data © Crown copyright and database right' ELSE 'Heights from the Copernicus DEM, © DLR e.V. 2010-2014 and © Airbus Defence and Space GmbH 2014-2018 provided under COPERNICUS by the European Union and ESA' END AS credit FROM supplier")
def credits(spark, sf_dir):
    heights = F.when(F.col("s_nationkey") % 2 == 0, "gb").otherwise("dem")
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("area"), p.credit(heights, sentence=True).alias("credit"))


@query("", "SELECT CAST(CASE WHEN bool_or(s_acctbal < 0) THEN 100 ELSE 40 END AS INT) AS need, 64.0 >= CASE WHEN bool_or(s_acctbal < 0) THEN 100 ELSE 40 END AS enough FROM supplier")
def room_needed(spark, sf_dir):
    return p.room(table(spark, sf_dir, "supplier").select((F.col("s_acctbal") >= 0).alias("built")), 64.0)
