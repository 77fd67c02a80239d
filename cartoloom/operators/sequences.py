"""Operators over samples in order along a way: runs, gaps, medians. All are windows within a way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _along(key: str, order: str):
    return Window.partitionBy(key).orderBy(order)


def with_islands(rows: DataFrame, value: Column, key: str = "way_id", order: str = "seq") -> DataFrame:
    """rows with ``value`` and ``island``, a number that grows wherever the value changes."""
    w = _along(key, order)
    new = F.when(F.lag("value").over(w).eqNullSafe(F.col("value")), 0).otherwise(1)
    return rows.withColumn("value", value).withColumn("new", new).withColumn("island", F.sum("new").over(w)).drop("new")


def runs(rows: DataFrame, value: Column, key: str = "way_id", order: str = "seq") -> DataFrame:
    """(key, start, end, value): maximal runs of equal values other than 0, end exclusive."""
    found = with_islands(rows, value, key, order).where("value <> 0").groupBy(key, "island", "value")
    return found.agg(F.min(order).alias("start"), (F.max(order) + 1).alias("end")).select(key, "start", "end", "value")


def runs_sharing_ends(rows: DataFrame, value: Column, key: str = "way_id", order: str = "seq") -> DataFrame:
    """As runs, but each goes on to the first sample of the next run of any value, so that lines meet; two samples at least."""
    last = rows.groupBy(key).agg(F.max(order).alias("last"))
    joined = runs(rows, value, key, order).join(last, key)
    return joined.withColumn("end", F.least(F.col("end") + 1, F.col("last") + 1)).where(F.col("end") - F.col("start") >= 2).drop("last")


def gaps_filled(rows: DataFrame, value: str, size: int, key: str = "way_id", order: str = "seq") -> DataFrame:
    """rows with ``filled``: a closing (moving maximum, then moving minimum) of ``size`` samples.

    Dips of fewer than ``size`` samples between higher ones rise to the lower side. Ends repeat the last sample,
    so frames that reach past them are those that are left.
    """
    before, after = size // 2, size - size // 2 - 1
    w = _along(key, order)
    high = rows.withColumn("high", F.max(value).over(w.rowsBetween(-before, after)))
    return high.withColumn("filled", F.min("high").over(w.rowsBetween(-after, before))).drop("high")


def short_runs_cleared(rows: DataFrame, value: str, least: int, share: float, key: str = "way_id", order: str = "seq") -> DataFrame:
    """rows with ``kept``: the value, or 0 in runs above 0 of under ``least`` samples that are under ``share`` of the way."""
    found = with_islands(rows, (F.col(value) > 0).cast("int"), key, order)
    size, whole = F.count(F.lit(1)).over(Window.partitionBy(key, "island")), F.count(F.lit(1)).over(Window.partitionBy(key))
    short = (F.col("value") == 1) & (size < least) & (size < share * whole)
    return found.withColumn("kept", F.when(short, F.lit(0.0)).otherwise(F.col(value))).drop("value", "island")


def _mirrored(rows: DataFrame, value: str, half: int, key: str, order: str) -> DataFrame:
    """rows and, past both ends, their reflections about the end samples, ``half`` of them."""
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    base = rows.select(key, F.col(order).cast("long").alias("at"), F.col(value).alias("v"), F.lit(True).alias("own")).withColumn("n", n)
    left = base.where((F.col("at") >= 1) & (F.col("at") <= half)).withColumn("at", -F.col("at"))
    right = base.where((F.col("at") <= F.col("n") - 2) & (F.col("at") >= F.col("n") - 1 - half)).withColumn("at", 2 * (F.col("n") - 1) - F.col("at"))
    return base.unionByName(left.withColumn("own", F.lit(False))).unionByName(right.withColumn("own", F.lit(False)))


def rolling_median(rows: DataFrame, value: str, size: int, key: str = "way_id", order: str = "seq") -> DataFrame:
    """(key, order, median) over an odd window centred on each sample, ends mirrored; ways must be longer than half of it."""
    half = (size | 1) // 2
    w = _along(key, "at").rowsBetween(-half, half)
    return _mirrored(rows, value, half, key, order).withColumn("median", F.expr("percentile(v, 0.5)").over(w)).where("own").select(key, F.col("at").cast("int").alias(order), "median")


def rolling_mean(rows: DataFrame, value: str, half: int, key: str = "way_id", order: str = "seq") -> DataFrame:
    """rows with ``mean`` over 2 * half + 1 samples, ends repeating the last one; the end samples themselves stay."""
    w, whole = _along(key, order), _along(key, order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    frame = w.rowsBetween(-half, half)
    total, n = F.sum(value).over(frame), F.count(F.lit(1)).over(whole)
    head, tail = F.first(value).over(whole), F.last(value).over(whole)
    at = F.row_number().over(w) - 1
    missing_head, missing_tail = F.greatest(F.lit(half) - at, F.lit(0)), F.greatest(at + half - (n - 1), F.lit(0))
    mean = (total + missing_head * head + missing_tail * tail) / (2 * half + 1)
    return rows.withColumn("mean", F.when((at == 0) | (at == n - 1), F.col(value)).otherwise(mean))


def ends_extended(rows: DataFrame, value: str, reach: int, key: str = "way_id", order: str = "seq") -> DataFrame:
    """rows with ``extended``: zeros before the first (after the last) value above 0 take it, if it is within reach of the end."""
    w = Window.partitionBy(key)
    positive = F.when(F.col(value) > 0, F.col(order))
    first, last, n = F.min(positive).over(w), F.max(positive).over(w), F.max(order).over(w)
    pick = lambda at: F.max(F.when(F.col(order) == at, F.col(value))).over(w)
    marked = rows.withColumns({"_f": first, "_l": last, "_n": n})
    marked = marked.withColumns({"_fv": pick(F.col("_f")), "_lv": pick(F.col("_l"))})
    out = F.when((F.col(order) < F.col("_f")) & (F.col("_f") <= reach), F.col("_fv")).when((F.col(order) > F.col("_l")) & (F.col("_n") - F.col("_l") <= reach), F.col("_lv")).otherwise(F.col(value))
    return marked.withColumn("extended", out).drop("_f", "_l", "_n", "_fv", "_lv")
