"""Queries of operators along ways, and of numeric rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as m
from ..operators import sequences as s
from .base import derived, query, table

_LEVEL = "CASE WHEN heat > 0 THEN CAST(least(255, round_even(power(2.0, round_even(log2(greatest(heat, 1)) * 2, 0) / 2), 0)) AS INT) ELSE 0 END"


def _heat(spark, sf_dir):
    return derived(spark, sf_dir, "heat_samples")


@query("heat_samples", f"SELECT way_id, seq, {_LEVEL} AS level FROM heat_samples")
def heat_level(spark, sf_dir):
    return _heat(spark, sf_dir).select("way_id", "seq", m.heat_level(F.col("heat")).alias("level"))


@query("heat_samples", "SELECT way_id, seq, CASE WHEN heat > 0 THEN CAST(ceil(heat / 50) AS BIGINT) * 50 ELSE 0 END AS up FROM heat_samples")
def ceil_step(spark, sf_dir):
    return _heat(spark, sf_dir).select("way_id", "seq", m.up_to(F.when(F.col("heat") > 0, F.col("heat")), 50).alias("up"))


@query("parks", "SELECT id, CAST(floor(1500 / sqrt(coalesce(spaces, 10)) * 1000) AS BIGINT) AS extra_mm FROM parks")
def size_extra(spark, sf_dir):
    return derived(spark, sf_dir, "parks").select("id", F.floor(m.size_extra(F.col("spaces")) * 1000).alias("extra_mm"))


@query(
    "",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor(l_quantity * l_quantity / sqrt(l_quantity * l_quantity + l_tax * l_tax * 1e6) * 1e6) AS BIGINT) AS jut_um,
      CAST(floor((1 + 1.1 / (1 + exp(-0.45 * (l_quantity - 30)))) * 1e6) AS BIGINT) AS boost_um,
      CAST(floor(degrees(atan2(l_quantity / 3, (3 * (l_tax + 1) + 2 * (l_discount + 1) + 2) / 6)) * 1e6) AS BIGINT) AS steep_um FROM lineitem""",
)
def jut_score(spark, sf_dir):
    line, c = table(spark, sf_dir, "lineitem"), F.col
    micro = lambda x, name: F.floor(x * 1e6).cast("long").alias(name)
    steep = m.steepness(c("l_quantity"), c("l_tax") + 1, c("l_discount") + 1, F.lit(2.0))
    return line.select("l_orderkey", "l_linenumber", "l_partkey", micro(m.jut(c("l_quantity"), c("l_tax") * 1000), "jut_um"), micro(m.boost(c("l_quantity")), "boost_um"), micro(steep, "steep_um"))


@query(
    "heat_samples",
    f"""WITH l AS (SELECT way_id, seq, {_LEVEL} AS v FROM heat_samples), n AS (SELECT *, CASE WHEN lag(v) OVER w IS NOT DISTINCT FROM v THEN 0 ELSE 1 END AS new FROM l WINDOW w AS (PARTITION BY way_id ORDER BY seq)),
    i AS (SELECT *, sum(new) OVER (PARTITION BY way_id ORDER BY seq) AS i FROM n) SELECT way_id, min(seq) AS start, max(seq) + 1 AS "end", v AS value FROM i WHERE v <> 0 GROUP BY way_id, i, v""",
)
def runs_rle(spark, sf_dir):
    return s.runs(_heat(spark, sf_dir), m.heat_level(F.col("heat")))


@query(
    "heat_samples",
    f"""WITH l AS (SELECT way_id, seq, {_LEVEL} AS v, max(seq) OVER (PARTITION BY way_id) AS last FROM heat_samples), n AS (SELECT *, seq - row_number() OVER (PARTITION BY way_id, v ORDER BY seq) AS i FROM l),
    g AS (SELECT way_id, v AS value, min(seq) AS start, least(max(seq) + 2, max(last) + 1) AS "end" FROM n WHERE v <> 0 GROUP BY way_id, v, i) SELECT way_id, start, "end", value FROM g WHERE "end" - start >= 2""",
)
def runs_overlap(spark, sf_dir):
    return s.runs_sharing_ends(_heat(spark, sf_dir), m.heat_level(F.col("heat")))


@query(
    "heat_samples",
    """WITH h AS (SELECT *, max(heat) OVER (PARTITION BY way_id ORDER BY seq ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) AS hi FROM heat_samples)
    SELECT way_id, seq, min(hi) OVER (PARTITION BY way_id ORDER BY seq ROWS BETWEEN 2 PRECEDING AND 3 FOLLOWING) AS filled FROM h""",
)
def gap_fill(spark, sf_dir):
    return s.gaps_filled(_heat(spark, sf_dir), "heat", 6).select("way_id", "seq", "filled")


@query(
    "heat_samples",
    """WITH n AS (SELECT *, seq - row_number() OVER (PARTITION BY way_id, heat > 0 ORDER BY seq) AS i, count(*) OVER (PARTITION BY way_id) AS whole FROM heat_samples),
    g AS (SELECT *, count(*) OVER (PARTITION BY way_id, heat > 0, i) AS c FROM n) SELECT way_id, seq, CASE WHEN heat > 0 AND c < 4 AND c < 0.8 * whole THEN 0 ELSE heat END AS kept FROM g""",
)
def short_runs(spark, sf_dir):
    return s.short_runs_cleared(_heat(spark, sf_dir), "heat", 4, 0.8).select("way_id", "seq", "kept")


@query(
    "heat_samples",
    """WITH n AS (SELECT *, count(*) OVER (PARTITION BY way_id) AS n FROM heat_samples), o AS (SELECT way_id, seq, unnest(range(seq - 2, seq + 3)) AS p, n FROM n),
    m AS (SELECT way_id, seq, CASE WHEN p < 0 THEN -p WHEN p >= n THEN 2 * (n - 1) - p ELSE p END AS p FROM o)
    SELECT m.way_id, m.seq, median(h.heat) AS median FROM m JOIN heat_samples h ON h.way_id = m.way_id AND h.seq = m.p GROUP BY m.way_id, m.seq""",
)
def rolling_median(spark, sf_dir):
    return s.rolling_median(_heat(spark, sf_dir), "heat", 5)


@query(
    "heat_samples",
    """WITH n AS (SELECT *, count(*) OVER (PARTITION BY way_id) AS n FROM heat_samples), o AS (SELECT way_id, seq, n, heat, unnest(range(seq - 2, seq + 3)) AS p FROM n)
    SELECT o.way_id, o.seq, CAST(floor(CASE WHEN any_value(o.seq) = 0 OR any_value(o.seq) = any_value(n) - 1 THEN any_value(o.heat) ELSE sum(h.heat) / 5 END * 1000 + 0.01) AS BIGINT) AS mean_k
    FROM o JOIN heat_samples h ON h.way_id = o.way_id AND h.seq = greatest(0, least(n - 1, p)) GROUP BY o.way_id, o.seq""",
)
def rolling_mean(spark, sf_dir):
    return s.rolling_mean(_heat(spark, sf_dir), "heat", 2).select("way_id", "seq", F.floor(F.col("mean") * 1000 + 0.01).alias("mean_k"))


@query(
    "heat_samples",
    """WITH f AS (SELECT way_id, min(seq) FILTER (heat > 0) AS f, max(seq) FILTER (heat > 0) AS l, max(seq) AS n FROM heat_samples GROUP BY way_id)
    SELECT h.way_id, h.seq, CASE WHEN h.seq < f AND f <= 3 THEN a.heat WHEN h.seq > l AND n - l <= 3 THEN b.heat ELSE h.heat END AS extended FROM heat_samples h JOIN f USING (way_id)
    LEFT JOIN heat_samples a ON a.way_id = h.way_id AND a.seq = f LEFT JOIN heat_samples b ON b.way_id = h.way_id AND b.seq = l""",
)
def extend_ends(spark, sf_dir):
    return s.ends_extended(_heat(spark, sf_dir), "heat", 3).select("way_id", "seq", "extended")
