"""Incremental rebuilding: only what has changed since the last run is made again.

Nothing here needs a stream that runs on; the same functions serve ``foreachBatch`` as they serve a nightly job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.publishing import cache_keys


def changed(tiles: DataFrame, known: DataFrame, stamp: str) -> DataFrame:
    """x, y, key of tiles (x, y, hash) whose contents, own or round them, are not those of ``known`` (x, y, key)."""
    return cache_keys(tiles, stamp).join(known.select("x", "y", "key"), ["x", "y", "key"], "left_anti")


def stale(built: DataFrame, inputs: DataFrame) -> DataFrame:
    """name of outputs (name, version) that are missing an input (name, version), or older than one."""
    newest = inputs.groupBy("name").agg(F.max("version").alias("needed"))
    return newest.join(built, "name", "left").where("version IS NULL OR version < needed").select("name")


def updates_to(path: str, stamp: str):
    """A function for ``foreachBatch``: appends the keys of a batch's changed tiles to the table at ``path``."""

    def run(batch: DataFrame, _epoch: int) -> None:
        spark = batch.sparkSession
        try:
            known = spark.read.parquet(path)
        except Exception as e:  # the first batch finds no table yet
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER" not in str(e):
                raise
            known = spark.createDataFrame([], "x int, y int, key string")
        changed(batch, known, stamp).write.mode("append").parquet(path)

    return run
