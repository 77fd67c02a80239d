"""Catalogues of files, pieces, releases, cache keys and the texts that report on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def catalogued(files: DataFrame) -> DataFrame:
    """region, name, size, sha256 of files (region, name, content)."""
    return files.select("region", "name", F.octet_length("content").cast("long").alias("size"), F.sha2("content", 256).alias("sha256"))


def catalogue_json(files: DataFrame, version: str) -> DataFrame:
    """One JSON text for each region of catalogued files, its files by name."""
    own = files.groupBy("region").agg(F.array_sort(F.collect_list(F.struct("name", "size", "sha256"))).alias("files"))
    return own.select("region", F.to_json(F.struct(F.lit(1).alias("format"), F.lit(version).alias("version"), F.col("region").alias("id"), "files")).alias("json"))


def pieces(files: DataFrame, most: int) -> DataFrame:
    """files (with size) cut into as few near-equal pieces of at most ``most`` bytes as will do: piece, start, stop."""
    rows = files.where("size > 0").withColumn("n", F.ceil(F.col("size") / most)).withColumn("piece", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return rows.withColumn("start", F.expr("size * (piece - 1) div n")).withColumn("stop", F.expr("size * piece div n"))


def outdated(rows: DataFrame, group: str, newest: list[str], keep: int) -> DataFrame:
    """What is left of each group after its ``keep`` newest rows."""
    order = Window.partitionBy(group).orderBy(*(F.col(c).desc() for c in newest))
    return rows.withColumn("place", F.row_number().over(order)).where(F.col("place") > keep)


def todo(wanted: DataFrame, there: DataFrame, key: list[str]) -> DataFrame:
    return wanted.join(there.select(*key), key, "left_anti")


def decided(state: DataFrame) -> DataFrame:
    """area, version, todo of areas (newest as yymmdd, published as a date, draft)."""
    version = F.regexp_replace("newest", r"^(\d\d)(\d\d)(\d\d)$", "20$1-$2-$3")
    action = F.when(F.col("draft"), "finish draft").when(F.col("published").isNull() | (F.col("version") > F.col("published")), "build").otherwise("nothing")
    return state.withColumn("version", version).select("area", "version", action.alias("todo"))


def cache_keys(tiles: DataFrame, stamp: str) -> DataFrame:
    """x, y, key: a hash of a stamp and of the contents (x, y, hash) of a tile and those round it; it changes if they do.

    A place with several contents meets each content round it as often as it has contents, and those of one place stand
    in the order of their hashes. Null hashes are left out; where there are no others, the key is null.
    """
    steps = F.sequence(F.lit(-1), F.lit(1))
    sent = tiles.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps))
    entry = F.when(F.col("hash").isNotNull(), F.struct("dx", "dy", F.concat_ws(":", "dx", "dy", "hash").alias("t")))
    near = sent.select((F.col("x") - F.col("dx")).alias("x"), (F.col("y") - F.col("dy")).alias("y"), entry.alias("e")).groupBy("x", "y").agg(F.array_sort(F.collect_list("e")).alias("e"))
    rows = tiles.groupBy("x", "y").agg(F.count(F.lit(1)).cast("int").alias("times")).join(near, ["x", "y"])
    text = F.array_join(F.transform("e", lambda v: F.repeat(F.concat(F.lit(","), v["t"]), F.col("times"))), "")
    return rows.select("x", "y", F.when(F.size("e") > 0, F.sha1(F.concat(F.lit(f"{stamp}|"), F.substr(text, F.lit(2))))).alias("key"))


def usually(seconds: Column) -> Column:
    """How long a step takes, in words."""
    minutes = F.rint(seconds / 60).cast("int")
    return (
        F.when(seconds < 60, F.lit("seconds")).when(minutes < 3, F.lit("a minute or two")).when(minutes < 100, F.concat(F.lit("about "), minutes.cast("string"), F.lit(" minutes")))
        .otherwise(F.concat(F.lit("about "), F.rint(seconds / 3600).cast("int").cast("string"), F.lit(" hours")))
    )


def elapsed(seconds: Column) -> Column:
    return F.format_string("%dh%02dm", F.floor(seconds / 3600), F.floor(seconds % 3600 / 60))


def degree_tile(lat: Column, lon: Column) -> Column:
    """Name of the square of one degree that a point is in."""
    name = lambda v, plus, minus, width: F.concat(F.when(v >= 0, F.lit(plus)).otherwise(F.lit(minus)), F.lpad(F.abs(F.floor(v)).cast("string"), width, "0"))
    return F.concat(name(lat, "N", "S", 2), name(lon, "E", "W", 3))


def area_version(date: Column, revision: Column) -> Column:
    return F.concat_ws(".", date, F.substring(revision, 1, 7))


def source_revision(files: DataFrame) -> DataFrame:
    """revision: seven digits of the hash of all sources (name, content), by name."""
    own = files.select("name", F.sha2("content", 256).alias("h"))
    return own.agg(F.substring(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("name", "h"))), lambda s: s["h"]), ""), 256), 1, 7).alias("revision"))


# Credits that the sources of heights ask for, and GB of disk that a build needs with and without a first one.
OS_CREDIT = "contains OS data © Crown copyright and database right"
DEM_CREDIT = "heights from the Copernicus DEM, © DLR e.V. 2010-2014 and © Airbus Defence and Space GmbH 2014-2018 provided under COPERNICUS by the European Union and ESA"
FIRST_BUILD_GB, LATER_BUILD_GB = 100, 40


def credit(heights: Column, sentence: bool = False) -> Column:
    """The credit of an area by where its heights are from; as a sentence it begins with a capital letter."""
    text = F.when(heights == "gb", F.lit(OS_CREDIT)).otherwise(F.lit(DEM_CREDIT))
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 1000)) if sentence else text


def room(areas: DataFrame, free_gb: float) -> DataFrame:
    """need, enough: GB that building areas (built) takes, more while one has not been built, and whether they are free."""
    first = F.coalesce(F.bool_or(~F.coalesce("built", F.lit(False))), F.lit(False))
    return areas.agg(F.when(first, FIRST_BUILD_GB).otherwise(LATER_BUILD_GB).alias("need")).select("need", (F.lit(float(free_gb)) >= F.col("need")).alias("enough"))
