"""Queries of spatial joins and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as m
from ..operators import places as p
from .base import derived, query, table


def _xy(rows):
    return rows.withColumnRenamed("e", "x").withColumnRenamed("n", "y")


def _peaks(spark, sf_dir):
    return _xy(derived(spark, sf_dir, "peaks"))


def _parks(spark, sf_dir):
    return _xy(derived(spark, sf_dir, "parks"))


_D2 = "((a.e - b.e) * (a.e - b.e) + (a.n - b.n) * (a.n - b.n))"


@query(
    "parks peaks",
    f"""WITH d AS (SELECT a.id AS park, b.id AS peak, {_D2} AS d2 FROM parks a JOIN peaks b ON {_D2} < 1000000), k AS (SELECT *, row_number() OVER (PARTITION BY park ORDER BY d2, peak) AS o FROM d)
    SELECT parks.id AS park, peak, least(CAST(round_even(coalesce(sqrt(d2), 1000) / 10, 0) AS INT) * 10, 5000) AS path_m FROM parks LEFT JOIN k ON k.park = parks.id AND o = 1""",
)
def nn_parks(spark, sf_dir):
    found = p.nearest(_parks(spark, sf_dir), _peaks(spark, sf_dir), 1000.0, strict=True)
    return found.select(F.col("a").alias("park"), F.col("b").alias("peak"), m.path_metres(F.coalesce("dist", F.lit(1000.0))).alias("path_m"))


@query("parks peaks", f"SELECT a.id AS park, count(b.id) FILTER ({_D2} <= 62500) AS near250, count(b.id) AS near2500 FROM parks a JOIN peaks b ON {_D2} <= 6250000 GROUP BY a.id")
def snap_parks(spark, sf_dir):
    found = p.pairs_within(_parks(spark, sf_dir), _peaks(spark, sf_dir), 2500.0)
    return found.groupBy(F.col("a").alias("park")).agg(F.count_if(F.col("dist") <= 250).alias("near250"), F.count(F.lit(1)).alias("near2500"))


@query("peaks", f"SELECT a.id, count(*) AS around, CAST(sum(CASE WHEN b.score > a.score THEN 1 ELSE 0 END) AS BIGINT) AS higher FROM peaks a JOIN peaks b ON {_D2} <= 25000000 GROUP BY a.id")
def within_radius(spark, sf_dir):
    return p.counts_within(_peaks(spark, sf_dir), 5000.0)


@query("parks peaks", f"SELECT a.id, bool_or(coalesce({_D2} <= 640000, false)) AS near FROM parks a CROSS JOIN peaks b GROUP BY a.id")
def near_road(spark, sf_dir):
    return p.exists_within(_parks(spark, sf_dir), _peaks(spark, sf_dir), 800.0)


@query(
    "peaks counties",
    "SELECT p.id, min(c.id) AS county FROM peaks p LEFT JOIN counties c ON p.e >= x0 AND p.e < x1 AND p.n >= y0 AND p.n < y1 GROUP BY p.id",
)
def point_in_polygon(spark, sf_dir):
    c = derived(spark, sf_dir, "counties")
    rings = c.select("id", p.box_ring(c.x0, c.y0, c.x1, c.y1).alias("ring"))
    return p.containing(_peaks(spark, sf_dir), rings, 4000.0).withColumnRenamed("polygon", "county")


@query(
    "counties",
    "SELECT id, CAST(sx AS BIGINT) AS sx, CAST(unnest(range(CAST(floor(y0 / 3000) AS BIGINT), CAST(ceil(y1 / 3000) AS BIGINT))) AS BIGINT) AS sy FROM (SELECT *, unnest(range(CAST(floor(x0 / 3000) AS BIGINT), CAST(ceil(x1 / 3000) AS BIGINT))) AS sx FROM counties)",
)
def tiles_touching(spark, sf_dir):
    return p.squares_touching(derived(spark, sf_dir, "counties"), 3000.0)


@query(
    "peaks",
    f"""WITH s AS (SELECT a.id, a.score, a.county, max(b.score) AS area, max(CASE WHEN {_D2} <= 25000000 THEN b.score END) AS top FROM peaks a JOIN peaks b ON {_D2} <= 225000000 GROUP BY a.id, a.score, a.county),
    f AS (SELECT a.id, min(b.id) AS f FROM s a JOIN peaks pa ON pa.id = a.id JOIN peaks b ON b.score = a.top AND ((pa.e - b.e) * (pa.e - b.e) + (pa.n - b.n) * (pa.n - b.n)) <= 25000000 GROUP BY a.id),
    h AS (SELECT id, row_number() OVER (PARTITION BY county ORDER BY score DESC, id) AS o FROM peaks WHERE county >= 0),
    r AS (SELECT s.id, score, top, CASE WHEN coalesce(o, 0) = 1 AND score >= area THEN 2 WHEN f.f = s.id THEN 1 ELSE 0 END AS rank FROM s JOIN f USING (id) LEFT JOIN h USING (id))
    SELECT id, rank, CASE WHEN rank = 0 AND score >= top * 0.9 THEN 1 ELSE 0 END AS close FROM r""",
)
def rank_peaks(spark, sf_dir):
    return p.ranked_peaks(_peaks(spark, sf_dir))


@query("peaks", "WITH k AS (SELECT county, id, row_number() OVER (PARTITION BY county ORDER BY score DESC, id) AS place FROM peaks) SELECT county, id, place FROM k WHERE place <= 4")
def top4_kind(spark, sf_dir):
    return p.top_by(_peaks(spark, sf_dir), "county", "score", "id", 4).select("county", "id", "place")


@query("peaks", f"SELECT a.id, CAST(round(max(b.score) * 100) AS BIGINT) AS top_c FROM peaks a JOIN peaks b ON abs(a.e - b.e) <= 400 AND abs(a.n - b.n) <= 400 GROUP BY a.id")
def summit_snap(spark, sf_dir):
    peaks = _peaks(spark, sf_dir)
    met = p.pairs_within(peaks, peaks, 566.0, carry=("x", "y", "score"))
    box = (F.abs(F.col("a_x") - F.col("b_x")) <= 400) & (F.abs(F.col("a_y") - F.col("b_y")) <= 400)
    return met.where(box).groupBy(F.col("a").alias("id")).agg(F.round(F.max("b_score") * 100).cast("long").alias("top_c"))


@query(
    "peaks",
    f"""WITH d AS (SELECT a.id AS a, b.id AS b, sqrt({_D2}) AS d, a.score - b.score AS h FROM peaks a JOIN peaks b ON {_D2} <= 4000000 AND a.id <> b.id),
    s AS (SELECT a, b, h * h / greatest(sqrt(h * h + d * d), 1e-9) AS score FROM d WHERE h > 0), k AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS o FROM s)
    SELECT a, b, CAST(floor(score * 1000) AS BIGINT) AS score_k FROM k WHERE o = 1""",
)
def best_base(spark, sf_dir):
    peaks = _peaks(spark, sf_dir).withColumnRenamed("score", "z")
    found = p.best_base(peaks, peaks, 2000.0, m.jut_of)
    return found.select("a", "b", F.floor(F.col("score") * 1000).alias("score_k"))


@query(
    "heat_samples",
    """WITH c AS (SELECT way_id AS k, CAST(seq AS DOUBLE) AS x, heat AS rise, max(seq) OVER (PARTITION BY way_id) AS d, max(heat) OVER (PARTITION BY way_id) AS h FROM heat_samples),
    f AS (SELECT k, min(x) FILTER (rise >= h * (1.0 / 3)) AS a, min(x) FILTER (rise >= h * (2.0 / 3)) AS b, min(x) FILTER (rise >= h) AS c FROM c GROUP BY k)
    SELECT k, CAST(a AS BIGINT) AS first, CAST(b - a AS BIGINT) AS second, CAST(c - b AS BIGINT) AS third FROM f""",
)
def steepness_thirds(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("way_id")
    h = derived(spark, sf_dir, "heat_samples")
    climbs = h.select(F.col("way_id").alias("k"), F.col("seq").cast("double").alias("x"), F.col("heat").alias("rise"), F.max("seq").over(w).cast("double").alias("d"), F.max("heat").over(w).alias("h"))
    found = p.crossings(climbs)
    return found.select("k", *(F.col(c).cast("long").alias(c) for c in ("first", "second", "third")))


@query("", "SELECT o_orderkey AS way_id, l_suppkey AS route_id, count(*) AS members FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P' GROUP BY 1, 2")
def way_route_members(spark, sf_dir):
    o, line = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    return o.where("o_orderstatus <> 'P'").join(line, o.o_orderkey == line.l_orderkey).groupBy(F.col("o_orderkey").alias("way_id"), F.col("l_suppkey").alias("route_id")).agg(F.count(F.lit(1)).alias("members"))


@query("", "SELECT doc_id, quality AS path_m FROM documents LEFT JOIN labels USING (doc_id)")
def path_m_lookup(spark, sf_dir):
    d, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return d.select("doc_id").join(labels.select("doc_id", F.col("quality").alias("path_m")), "doc_id", "left")


@query("", "SELECT n_nationkey AS id, coalesce(c, 0) AS customers, coalesce(s, 0) AS suppliers, CAST(ceil(coalesce(m, 0) / 100) AS BIGINT) * 100 AS up FROM nation LEFT JOIN (SELECT c_nationkey k, count(*) c, max(c_acctbal) m FROM customer GROUP BY 1) a ON a.k = n_nationkey LEFT JOIN (SELECT s_nationkey k, count(*) s FROM supplier GROUP BY 1) b ON b.k = n_nationkey")
def walked_enrich(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"))
    a = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("id")).agg(F.count(F.lit(1)).alias("c"), F.max("c_acctbal").alias("m"))
    b = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("id")).agg(F.count(F.lit(1)).alias("s"))
    zero = F.lit(0).cast("long")
    return n.join(a, "id", "left").join(b, "id", "left").select("id", F.coalesce("c", zero).alias("customers"), F.coalesce("s", zero).alias("suppliers"), m.up_to(F.col("m"), 100).alias("up"))


@query("", "SELECT r_name AS parent, n_name AS name, row_number() OVER (PARTITION BY r_regionkey ORDER BY n_name) AS place FROM region JOIN nation ON n_regionkey = r_regionkey")
def region_children(spark, sf_dir):
    from pyspark.sql import Window

    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    rows = r.join(n, r.r_regionkey == n.n_regionkey)
    return rows.select(F.col("r_name").alias("parent"), F.col("n_name").alias("name"), F.row_number().over(Window.partitionBy("r_regionkey").orderBy("n_name")).alias("place"))


def _lines(spark, sf_dir):
    """Lines from each park to the peak of its number, with a bend between."""
    park, peak = _parks(spark, sf_dir).select("id", F.col("x").alias("x0"), F.col("y").alias("y0")), _peaks(spark, sf_dir).select("id", F.col("x").alias("x1"), F.col("y").alias("y1"))
    point = lambda x, y: F.struct(F.expr(x).alias("x"), F.expr(y).alias("y"))
    return park.join(peak, "id").select("id", F.array(point("x0", "y0"), point("x1", "y0"), point("x1", "y1")).alias("line"))


@query(
    "parks peaks counties",
    """WITH l AS (SELECT p.id, p.e AS x0, p.n AS y0, q.e AS x1, q.n AS y1 FROM parks p JOIN peaks q USING (id)),
    s AS (SELECT id, least(x0, x1) AS a, y0 AS b, greatest(x0, x1) AS c, y0 AS d FROM l UNION ALL SELECT id, x1, least(y0, y1), x1, greatest(y0, y1) FROM l)
    SELECT DISTINCT s.id, k.id AS polygon FROM s JOIN counties k ON power(greatest(0, k.x0 - c, a - k.x1), 2) + power(greatest(0, k.y0 - d, b - k.y1), 2) <= 1000000""",
)
def edges_in_regions(spark, sf_dir):
    c = derived(spark, sf_dir, "counties")
    return p.lines_near(_lines(spark, sf_dir), c.select(F.col("id").alias("polygon"), p.box_ring(c.x0, c.y0, c.x1, c.y1).alias("ring")), 1000.0, 4000.0)


@query("parks peaks", "SELECT p.id FROM parks p JOIN peaks q USING (id) WHERE (p.e BETWEEN 5000 AND 20000 AND p.n BETWEEN 5000 AND 20000) OR (q.e BETWEEN 5000 AND 20000 AND p.n BETWEEN 5000 AND 20000) OR (q.e BETWEEN 5000 AND 20000 AND q.n BETWEEN 5000 AND 20000)")
def vertex_in_box(spark, sf_dir):
    return p.with_vertex_in(_lines(spark, sf_dir), 5000.0, 5000.0, 20000.0, 20000.0).select("id")


@query("peaks", "SELECT id, CAST(-(2 * 200000 + (id % 2) * 100000 + least(CAST(floor(score) AS BIGINT), 99999)) AS BIGINT) AS sort_key FROM peaks WHERE score > 0")
def peak_sort_key(spark, sf_dir):
    c = F.col
    key = -(F.lit(2) * 200_000 + (c("id") % 2) * 100_000 + F.least(F.floor("score"), F.lit(99_999)))
    return _peaks(spark, sf_dir).where("score > 0").select("id", key.cast("long").alias("sort_key"))


@query(
    "counties",
    """WITH b AS (SELECT x0 / 4000 - 0.75 AS w, y0 / 4000 - 0.75 AS s, x1 / 4000 + 0.75 AS e, y1 / 4000 + 0.75 AS n FROM counties),
    q AS (SELECT DISTINCT CAST(lat AS INT) AS lat, CAST(lon AS INT) AS lon FROM (SELECT lat, unnest(range(CAST(floor(w) AS INT), CAST(ceil(e) AS INT))) AS lon FROM (SELECT *, unnest(range(CAST(floor(s) AS INT), CAST(ceil(n) AS INT))) AS lat FROM b)))
    SELECT lat, lon FROM q WHERE EXISTS (SELECT 1 FROM supplier WHERE s_suppkey % 14 - 1 = lat AND s_suppkey % 15 - 1 = lon)""",
)
def listed_squares(spark, sf_dir):
    degrees = derived(spark, sf_dir, "counties").select(*((F.col(c) / 4000).alias(c) for c in ("x0", "y0", "x1", "y1")))
    listed = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 14 - 1).cast("int").alias("lat"), (F.col("s_suppkey") % 15 - 1).cast("int").alias("lon"))
    return p.listed_squares(degrees, listed, 0.75)


@query(
    "parks peaks",
    f"""WITH k AS (SELECT a.id, b.id AS peak, b.e, b.n, row_number() OVER (PARTITION BY a.id ORDER BY sqrt({_D2}), b.id) AS o FROM parks a JOIN peaks b ON {_D2} <= 640000)
    SELECT parks.id, peak AS b, coalesce(k.e, parks.e) AS x, coalesce(k.n, parks.n) AS y FROM parks LEFT JOIN k ON k.id = parks.id AND o = 1""",
)
def joined_ends(spark, sf_dir):
    return p.joined_ends(_parks(spark, sf_dir), _peaks(spark, sf_dir), 800.0)
