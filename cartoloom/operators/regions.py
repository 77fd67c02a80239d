"""Which regions there are, what outlines make them up, and which of them a place lies in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo

# Regions beside those of Great Britain, as (id, name, parent, area, outline that bounds it or none, outlines
# that make it up, whether it can be downloaded).
REGIONS = (
    ("alps", "The Alps", None, "alps", None, ("alps", "slovenia"), False),
    ("alps-austria", "Austrian Alps", "alps", "alps", "alps", ("austria",), True),
    ("alps-france", "French Alps", "alps", "alps", "alps", ("france", "monaco"), True),
    ("alps-germany", "German Alps", "alps", "alps", "alps", ("germany",), True),
    ("alps-italy", "Italian Alps", "alps", "alps", "alps", ("italy",), True),
    ("alps-switzerland", "Swiss Alps", "alps", "alps", "alps", ("switzerland", "liechtenstein"), True),
    ("slovenia", "Slovenia", "alps", "slovenia", None, ("slovenia",), True),
    ("italy", "Italy", None, "italy", None, ("italy",), False),
    ("italy-nord-ovest", "North-West Italy", "italy", "italy", None, ("nord-ovest",), True),
    ("italy-nord-est", "North-East Italy", "italy", "italy", None, ("nord-est",), True),
    ("italy-centro", "Central Italy", "italy", "italy", None, ("centro",), True),
    ("italy-sud", "Southern Italy", "italy", "italy", None, ("sud",), True),
    ("italy-isole", "Sicily and Sardinia", "italy", "italy", None, ("isole",), True),
    ("norway", "Norway", None, "norway", None, ("nord-norge", "trondelag", "vestlandet", "ostlandet", "sorlandet"), False),
    ("norway-nord-norge", "Northern Norway", "norway", "norway", None, ("nord-norge",), True),
    ("norway-trondelag", "Trøndelag", "norway", "norway", None, ("trondelag",), True),
    ("norway-vestlandet", "Western Norway", "norway", "norway", None, ("vestlandet",), True),
    ("norway-ostlandet", "Eastern Norway", "norway", "norway", None, ("ostlandet",), True),
    ("norway-sorlandet", "Southern Norway", "norway", "norway", None, ("sorlandet",), True),
)


def defined(spark: SparkSession, areas: list[str] | None = None) -> DataFrame:
    """id, name, parent, area, within, outlines, download of the regions of some areas, or of all."""
    rows = [r for r in REGIONS if areas is None or r[3] in areas]
    return spark.createDataFrame(rows, "id string, name string, parent string, area string, within string, outlines array<string>, download boolean")


def regions_of(points: DataFrame, regions: DataFrame, features: DataFrame, cell: float = 1.0) -> DataFrame:
    """(id, region): every region that each point (id, x, y) lies in.

    A region is the union of its outlines, cut by the outline ``within`` where it has one: a point is in it if any of
    its outlines holds the point, and that one too. features: id, rings (outer rings and holes alike, a point is inside
    by the count of rings round it). Outlines go to the cells of their boxes by number and meet points by an equi-join;
    rings join the pairs found.
    """
    needed = regions.select(F.explode(F.concat(F.col("outlines"), F.when(F.col("within").isNotNull(), F.array("within")).otherwise(F.array().cast("array<string>")))).alias("outline")).distinct()
    shapes = features.select(F.col("id").alias("outline"), "rings").join(needed, "outline")
    span = lambda c: F.sequence(*(F.floor(f(F.flatten(F.transform("rings", lambda r: F.transform(r, lambda p: p[c])))) / cell) for f in (F.array_min, F.array_max)))
    cells = shapes.select("outline", F.explode(span("x")).alias("cx"), span("y").alias("rows")).select("outline", "cx", F.explode("rows").alias("cy"))
    at = points.select("id", "x", "y", F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy"))
    met = at.join(cells, ["cx", "cy"]).join(shapes, "outline")
    odd = F.aggregate(F.transform("rings", lambda r: geo.in_ring(F.col("x"), F.col("y"), r).cast("int")), F.lit(0), lambda s, n: s + n) % 2 == 1
    inside = met.where(odd).groupBy("id").agg(F.collect_set("outline").alias("held"))
    # a point lies in few outlines, and regions are few rows: each point's outlines meet the regions that they make up
    made = regions.select(F.col("id").alias("region"), "within", F.explode("outlines").alias("outline"))
    found = inside.select("id", "held", F.explode("held").alias("outline")).join(made, "outline")
    return found.where("within IS NULL OR array_contains(held, within)").select("id", "region").distinct()
