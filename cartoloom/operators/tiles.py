"""Tile tables (z, x, y, data): merging, cutting, content deduplication and the overview."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vector_tiles as vt

KEY = ["z", "x", "y"]


def merged(a: DataFrame, b: DataFrame) -> DataFrame:
    """z, x, y, data: every tile of a, followed by the tile of b at its place; tiles of b alone are dropped."""
    return a.join(b.withColumnRenamed("data", "more"), KEY, "left").select(*KEY, F.concat("data", F.coalesce("more", F.lit(""))).alias("data"))


def dropped(a: DataFrame, b: DataFrame) -> DataFrame:
    return b.join(a, KEY, "left_anti")


def cut(tiles: DataFrame, want: DataFrame) -> DataFrame:
    """Tiles whose place is wanted."""
    return tiles.join(want.select(*KEY).distinct(), KEY, "left_semi")


def stored(tiles: DataFrame, width: int = 64) -> tuple[DataFrame, DataFrame]:
    """(z, x, y, data_id, place_id) and (data_id, data): each content once, numbered in the order of its first place.

    Contents that stand first at one place, which only a table with several tiles at a place has, are numbered in the
    order of their hashes; place_id numbers first places, and is the same for them. A null is a content too.
    Contents meet by hash. Only hashes and places are numbered, within columns of ``width`` tiles of a zoom, and the
    counts of columns give the numbers their base; each content then comes from the tile at its first place.
    """
    digest = F.coalesce(F.sha1(F.col("data").cast("binary")), F.lit(""))
    hashed = tiles.select(*KEY, digest.alias("hash"))
    column = [F.col("at.z").alias("zoom"), F.floor(F.col("at.x") / width).alias("column")]
    first = hashed.groupBy("hash").agg(F.min(F.struct(*KEY)).alias("at")).select("hash", "at", *column)
    own = Window.partitionBy("zoom", "column")
    first = first.withColumn("own", F.row_number().over(own.orderBy("at", "hash"))).withColumn("own_place", F.dense_rank().over(own.orderBy("at")))
    counts = first.groupBy("zoom", "column").agg(F.count(F.lit(1)).alias("c"), F.max("own_place").cast("long").alias("p"))
    before = lambda c: F.sum(c).over(Window.orderBy("zoom", "column")) - F.col(c)
    base = counts.select("zoom", "column", before("c").alias("base"), before("p").alias("base_place"))
    ids = [(F.col("base") + F.col("own")).alias("data_id"), (F.col("base_place") + F.col("own_place")).alias("place_id")]
    numbered = first.join(base, ["zoom", "column"]).select("hash", "at.*", *ids)
    contents = tiles.select(*KEY, "data").join(numbered.select(*KEY, "hash", "data_id"), KEY).where(digest == F.col("hash"))
    return hashed.join(numbered.select("hash", "data_id", "place_id"), "hash").select(*KEY, "data_id", "place_id"), contents.groupBy("data_id").agg(F.min("data").alias("data"))


def joined_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """z, x, y, data of two tables of gzipped tiles (z, x, y, data_id, data): each pair of contents is joined once."""
    left = a.select(*KEY, F.col("data_id").alias("ia")).join(b.select(*KEY, F.col("data_id").alias("ib")), KEY, "left")
    da, db = a.select(F.col("data_id").alias("ia"), F.col("data").alias("xa")).distinct(), b.select(F.col("data_id").alias("ib"), F.col("data").alias("xb")).distinct()
    pairs = left.select("ia", "ib").distinct().join(da, "ia").join(db, "ib", "left")

    @F.pandas_udf("binary")
    def join(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([p if q is None else vt.end_to_end(p, q) for p, q in zip(x, y, strict=True)])

    done = pairs.select("ia", "ib", join("xa", "xb").alias("data"))
    return left.join(done, left.ia.eqNullSafe(done.ia) & left.ib.eqNullSafe(done.ib)).select(*KEY, "data")


def combined(tiles: DataFrame) -> DataFrame:
    """z, x, y, data: gzipped tiles of several areas at one place as one tile, without repeated features.

    tiles: z, x, y, part (their order), data. As many tiles meet at a place as there are areas.
    """

    def one(table: pd.DataFrame) -> pd.DataFrame:
        found = [gzip.decompress(d) for d in table.sort_values("part")["data"]]
        return table[KEY].iloc[:1].assign(data=gzip.compress(vt.together(found), 6, mtime=0))

    return tiles.groupBy(*KEY).applyInPandas(one, "z int, x int, y int, data binary")


def distinct_features(rows: DataFrame, same: list[str], order: list[str]) -> DataFrame:
    """rows without those that equal an earlier one (by ``order``) in the columns ``same``."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*same).orderBy(*order))).where("_n = 1").drop("_n")


def merged_metadata(a: DataFrame, b: DataFrame, own: dict[str, str]) -> DataFrame:
    """name, value of two tables of metadata (name, value): a's bounds and centre, both lists of layers, and ``own``."""
    layers = "array<map<string,string>>"
    lists = [t.where("name = 'json'").select(F.lit(i).alias("part"), F.from_json(F.get_json_object("value", "$.vector_layers"), layers).alias("own")) for i, t in enumerate((a, b))]
    both = lists[0].unionByName(lists[1]).where("own IS NOT NULL").agg(F.array_sort(F.collect_list(F.struct("part", F.to_json("own").alias("own")))).alias("all"))
    joined = F.flatten(F.transform("all", lambda x: F.from_json(x["own"], layers)))  # a row a table: maps cannot be sorted
    json = both.select(F.lit("json").alias("name"), F.to_json(F.struct(joined.alias("vector_layers"))).alias("value"))
    kept = a.where(F.col("name").isin("bounds", "center")).select("name", "value")
    return kept.unionByName(json).unionByName(a.sparkSession.createDataFrame(list(own.items()), "name string, value string"))
