"""Queries of raster operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geo, numbers
from ..operators import rasters as x
from .base import derived, query

_RING = """g AS (SELECT m.r, m.c, count(*) AS k, sum(CASE WHEN n.c > m.c THEN 1 WHEN n.c < m.c THEN -1 ELSE 0 END * CASE WHEN n.r = m.r THEN 2 ELSE 1 END * n.v) / 160.0 AS gx,
  sum(CASE WHEN n.r > m.r THEN 1 WHEN n.r < m.r THEN -1 ELSE 0 END * CASE WHEN n.c = m.c THEN 2 ELSE 1 END * n.v) / 160.0 AS gy
  FROM raster m JOIN raster n ON abs(m.r - n.r) <= 1 AND abs(m.c - n.c) <= 1 AND (m.r <> n.r OR m.c <> n.c) GROUP BY m.r, m.c HAVING count(*) = 8)"""


def _raster(spark, sf_dir):
    return derived(spark, sf_dir, "raster")


@query("raster", f"WITH {_RING} SELECT r, c, CAST(round_even(degrees(atan(sqrt(gx * gx + gy * gy))) * 4, 0) AS INT) AS slope FROM g")
def horn_slope(spark, sf_dir):
    return x.slope(_raster(spark, sf_dir), 20.0)


@query("raster", f"WITH {_RING} SELECT r, c, CAST(round_even(((-gx * sin(radians(315)) * cos(radians(45)) - gy * cos(radians(315)) * cos(radians(45)) + sin(radians(45))) / sqrt(1 + gx * gx + gy * gy) - sin(radians(45))) * 127, 0) AS INT) AS shade FROM g")
def hillshade(spark, sf_dir):
    return x.hillshade(_raster(spark, sf_dir), 20.0)


def _fold(opacities):
    """SQL of the bands' blended opacity over column d (degrees)."""
    out = "0.0"
    for start, opacity in opacities:
        t = f"greatest(0, least(1, (d - {start} + 0.35) / 0.7))"
        out = f"(({out}) * (1 - {t}) + {t} * {opacity})"
    return out


@query("raster", f"WITH {_RING}, s AS (SELECT r, c, CAST(round_even(degrees(atan(sqrt(gx * gx + gy * gy))) * 4, 0) AS INT) / 4.0 AS d FROM g) SELECT r, c, CAST(round(1000 * {_fold((b, o) for b, _, o in x.BANDS)}) AS INT) AS alpha_k FROM s")
def slope_band(spark, sf_dir):
    return x.slope(_raster(spark, sf_dir), 20.0).select("r", "c", F.round(x.slope_colour(F.col("slope"))["a"] * 1000).cast("int").alias("alpha_k"))


@query("raster", "SELECT r, c, CAST(floor(1e6 * (light + dark * (1 - light)) + 0.5) AS BIGINT) AS a_u, CAST(floor(1e6 * (dark * 0.28 * (1 - light) + light) + 0.5) AS BIGINT) AS b_u FROM (SELECT r, c, greatest(0, least(1, (v - 250) / 127.0)) * 0.2 AS light, greatest(0, least(1, (250 - v) / 127.0)) * 0.3 AS dark FROM raster)")
def shade_colour(spark, sf_dir):
    rows = _raster(spark, sf_dir).select("r", "c", x.shade_colour(F.col("v") - 250).alias("k"))
    return rows.select("r", "c", F.floor(F.col("k.a") * 1e6 + 0.5).alias("a_u"), F.floor(F.col("k.b") * 1e6 + 0.5).alias("b_u"))


@query("raster", "SELECT a.r, a.c FROM raster a JOIN raster b ON abs(a.r - b.r) <= 2 AND abs(a.c - b.c) <= 2 GROUP BY a.r, a.c, a.v HAVING a.v >= 400 AND a.v >= 0.9 * max(b.v)")
def heat_core(spark, sf_dir):
    return x.core(_raster(spark, sf_dir), 2, 400, 0.9)


@query("raster", "SELECT r // 2 AS r, c // 2 AS c, CAST(floor(avg(v) * 12 + 0.5) AS BIGINT) AS mean_12 FROM raster GROUP BY r // 2, c // 2")
def block_mean(spark, sf_dir):
    return x.block_mean(_raster(spark, sf_dir)).select("r", "c", F.floor(F.col("v") * 12 + 0.5).alias("mean_12"))


@query(
    "raster",
    """WITH a AS (SELECT r // 2 AS r, c // 2 AS c, avg(v) AS v FROM raster GROUP BY 1, 2), b AS (SELECT r // 2 AS r, c // 2 AS c, avg(v) AS v FROM a GROUP BY 1, 2), d AS (SELECT r // 2 AS r, c // 2 AS c, avg(v) AS v FROM b GROUP BY 1, 2)
    SELECT 1 AS level, r, c, CAST(floor(v * 100 + 0.001) AS BIGINT) AS v_c FROM a UNION ALL SELECT 2, r, c, CAST(floor(v * 100 + 0.001) AS BIGINT) FROM b UNION ALL SELECT 3, r, c, CAST(floor(v * 100 + 0.001) AS BIGINT) FROM d""",
)
def pyramid_mean(spark, sf_dir):
    return x.pyramid(_raster(spark, sf_dir), 3).select("level", "r", "c", F.floor(F.col("v") * 100 + 0.001).alias("v_c"))


@query("raster", "SELECT r // 2 AS r, c // 2 AS c, max(v) AS v FROM raster GROUP BY 1, 2 HAVING max(v) > 0")
def pyramid_steepest(spark, sf_dir):
    return x.steepest(_raster(spark, sf_dir))


@query("raster", "WITH m AS (SELECT r, c FROM raster WHERE v >= 300) SELECT r, c FROM m WHERE (SELECT count(*) FROM m n WHERE abs(n.r - m.r) + abs(n.c - m.c) = 1) < 4")
def mask_edge(spark, sf_dir):
    return x.mask_edge(_raster(spark, sf_dir).where("v >= 300"))


@query("raster", "SELECT a.r, a.c, min(b.v) AS v FROM raster a JOIN raster b ON abs(a.r - b.r) <= 1 AND abs(a.c - b.c) <= 1 GROUP BY a.r, a.c")
def min_filter(spark, sf_dir):
    return x.lowest_around(_raster(spark, sf_dir))


@query("raster", "SELECT a.r, a.c, CAST(floor(avg(b.v) * 1000 + 0.01) AS BIGINT) AS mean_k FROM raster a JOIN raster b ON abs(a.r - b.r) <= 2 AND abs(a.c - b.c) <= 2 GROUP BY a.r, a.c")
def box_blend(spark, sf_dir):
    return x.box_smooth(_raster(spark, sf_dir), 2).select("r", "c", F.floor(F.col("v") * 1000 + 0.01).alias("mean_k"))


@query(
    "raster peaks",
    """WITH p AS (SELECT id, e / 640 AS x, n / 640 AS y FROM peaks), k AS (SELECT id, x, y, CAST(floor(x) AS INT) AS c0, CAST(floor(y) AS INT) AS r0 FROM p),
    s AS (SELECT k.id, count(*) AS n, sum((CASE WHEN r = r0 THEN 1 - (y - r0) ELSE y - r0 END) * (CASE WHEN c = c0 THEN 1 - (x - c0) ELSE x - c0 END) * v) AS v FROM k JOIN raster ON r IN (r0, r0 + 1) AND c IN (c0, c0 + 1) GROUP BY k.id)
    SELECT p.id, CASE WHEN n = 4 THEN CAST(floor(v * 1000 + 0.01) AS BIGINT) END AS v_k FROM p LEFT JOIN s USING (id)""",
)
def bilinear(spark, sf_dir):
    at = derived(spark, sf_dir, "peaks").select("id", (F.col("e") / 640).alias("x"), (F.col("n") / 640).alias("y"))
    return x.bilinear(at, _raster(spark, sf_dir)).select("id", F.floor(F.col("v") * 1000 + 0.01).alias("v_k"))


@query(
    "peaks parks",
    """WITH l AS (SELECT p.e / 640 AS x0, p.n / 640 AS y0, q.e / 640 AS x1, q.n / 640 AS y1 FROM parks p JOIN peaks q ON q.id = p.id), n AS (SELECT *, CAST(greatest(1, ceil(sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) / 0.5)) AS INT) AS n FROM l)
    SELECT DISTINCT CAST(floor(y0 + (y1 - y0) * i / n) AS INT) AS r, CAST(floor(x0 + (x1 - x0) * i / n) AS INT) AS c FROM (SELECT *, unnest(range(0, n + 1)) AS i FROM n)""",
)
def rasterize_lines(spark, sf_dir):
    p, q = (derived(spark, sf_dir, t) for t in ("parks", "peaks"))
    lines = p.join(q, p.id == q.id).select((p.e / 640).alias("x0"), (p.n / 640).alias("y0"), (q.e / 640).alias("x1"), (q.n / 640).alias("y1"))
    return x.line_cells(lines, 0.5)


@query("raster peaks", "SELECT p.id, v FROM peaks p LEFT JOIN raster ON r = CAST(floor(n / 640) AS INT) AND c = CAST(floor(e / 640) AS INT)")
def raster_lookup(spark, sf_dir):
    at = derived(spark, sf_dir, "peaks").select("id", F.floor(F.col("n") / 640).cast("int").alias("r"), F.floor(F.col("e") / 640).cast("int").alias("c"))
    return at.join(_raster(spark, sf_dir), ["r", "c"], "left").select("id", "v")


@query("raster", "SELECT r, c, CAST(greatest(-32767, least(32767, round_even(v * 100.0, 0))) AS INT) AS dm, CAST(round_even(v / 4.0, 0) AS INT) * 2 AS opacity, CASE WHEN v >= 500 THEN 3 WHEN v >= 100 THEN 2 WHEN v >= 10 THEN 1 ELSE 0 END AS size FROM raster")
def quantise(spark, sf_dir):
    v = F.col("v").cast("double")
    return _raster(spark, sf_dir).select("r", "c", numbers.decimetres(v * 10).cast("int").alias("dm"), numbers.even_opacity(v / 2).alias("opacity"), numbers.lake_class(v / 10).alias("size"))


@query("counties", "SELECT id, CAST((x1 - x0) * (y1 - y0) AS BIGINT) AS area, CAST((x0 + x1) / 2 AS BIGINT) AS cx, CAST((y0 + y1) / 2 AS BIGINT) AS cy FROM counties")
def ring_measures(spark, sf_dir):
    from ..operators.places import box_ring

    c = derived(spark, sf_dir, "counties")
    ring = box_ring(c.x0, c.y0, c.x1, c.y1)
    cx, cy = geo.ring_centroid(ring)
    return c.select("id", geo.ring_area(ring).cast("long").alias("area"), cx.cast("long").alias("cx"), cy.cast("long").alias("cy"))


def contours(spark, sf_dir):
    return x.contour_segments(_raster(spark, sf_dir), 50.0)


query("", None)(contours)


def gaussian_smooth(spark, sf_dir):
    return x.smoothed(_raster(spark, sf_dir), 1.5)


query("", None)(gaussian_smooth)


def grid_projection(spark, sf_dir):
    """Nodes in metres of a transverse Mercator grid."""
    rows = derived(spark, sf_dir, "nodes")
    east, north = geo.to_grid(F.col("lat_e7") * 1e-7, F.col("lon_e7") * 1e-7, -2.0)
    return rows.select("ref", F.round(east, 3).alias("east"), F.round(north, 3).alias("north"))


query("", None)(grid_projection)


@query(
    "counties",
    """WITH p AS (SELECT id, CASE WHEN id % 2 = 0 THEN 1 ELSE 2 END AS val, CASE WHEN id % 2 = 0 THEN id ELSE 100 + id END AS place, x0 / 500 AS a, y0 / 500 AS b, x1 / 500 AS c, y1 / 500 AS d FROM counties),
    g AS (SELECT *, unnest(range(CAST(floor(b) AS INT), CAST(floor(d) AS INT) + 1)) AS r FROM p), h AS (SELECT *, unnest(range(CAST(floor(a) AS INT), CAST(floor(c) AS INT) + 1)) AS col FROM g),
    i AS (SELECT r, col, place, CASE WHEN col + 0.5 > a + 4 AND col + 0.5 < c - 4 AND r + 0.5 > b + 4 AND r + 0.5 < d - 4 THEN 0 ELSE val END AS v FROM h WHERE col + 0.5 > a AND col + 0.5 < c AND r + 0.5 > b AND r + 0.5 < d)
    SELECT CAST(r AS INT) AS r, CAST(col AS INT) AS c, arg_max(v, place) AS v FROM i GROUP BY r, col HAVING arg_max(v, place) <> 0""",
)
def paint_polygons(spark, sf_dir):
    from ..operators.places import box_ring

    k = derived(spark, sf_dir, "counties")
    x0, y0, x1, y1 = (k[c] / 500 for c in ("x0", "y0", "x1", "y1"))
    even = k.id % 2 == 0
    rows = k.select(F.when(even, F.col("id")).otherwise(F.col("id") + 100).alias("place"), F.when(even, 1).otherwise(2).alias("value"), F.array(box_ring(x0, y0, x1, y1), box_ring(x0 + 4, y0 + 4, x1 - 4, y1 - 4)).alias("rings"))
    return x.painted(rows)


@query(
    "raster",
    """WITH f AS (SELECT r, c, v * 2 AS f FROM raster WHERE c BETWEEN 20 AND 40), w AS (SELECT a.r, a.c, avg(CASE WHEN b.c BETWEEN 20 AND 40 THEN 1.0 ELSE 0.0 END) AS w FROM raster a JOIN raster b ON abs(a.r - b.r) <= 2 AND abs(a.c - b.c) <= 2 GROUP BY a.r, a.c)
    SELECT r, c, CAST(floor((CASE WHEN f IS NULL THEN v ELSE w * f + (1 - w) * v END) * 1000 + 0.01) AS BIGINT) AS v_k FROM raster JOIN w USING (r, c) LEFT JOIN f USING (r, c)""",
)
def blend(spark, sf_dir):
    grid = _raster(spark, sf_dir)
    fine = grid.where("c BETWEEN 20 AND 40").select("r", "c", (F.col("v") * 2).alias("v"))
    return x.blended(grid, fine, 2).select("r", "c", F.floor(F.col("v") * 1000 + 0.01).alias("v_k"))


@query(
    "raster",
    """WITH m AS (SELECT r, c FROM raster WHERE v >= 470), n AS (SELECT a.r, a.c, b.r AS r2, b.c AS c2 FROM m a JOIN m b ON (b.r = a.r AND b.c = a.c + 1) OR (b.r = a.r + 1 AND abs(b.c - a.c) <= 1))
    SELECT * FROM n WHERE r = r2 OR c = c2 OR (NOT EXISTS (SELECT 1 FROM m WHERE m.r = n.r AND m.c = n.c2) AND NOT EXISTS (SELECT 1 FROM m WHERE m.r = n.r2 AND m.c = n.c))""",
)
def cell_links(spark, sf_dir):
    return x.cell_links(_raster(spark, sf_dir).where("v >= 470"))


def skeleton(spark, sf_dir):
    mask = _raster(spark, sf_dir).where("v >= 400").select(F.floor(F.col("r") / 32).cast("int").alias("tile"), "r", "c")
    return x.skeletons(mask, 1)


query("", None)(skeleton)
