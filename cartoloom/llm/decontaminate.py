"""Benchmark decontamination by winnowing, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Staging, one_per_id, table

#: Words of a k-gram, and k-grams of a winnowing window: any shared run of GRAM + WINDOW - 1 words shares a fingerprint.
GRAM, WINDOW = 5, 9
SPAN = GRAM + WINDOW - 1
#: Words of a run, besides the SPAN - 1 that the next begins with; a place in one needs so many bits.
RUN, PLACE_BITS = 2000, 12
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BETWEEN), "")


def _folded(rows: DataFrame, key: str) -> DataFrame:
    """key, all: the words, folded A-Z exactly (``lower`` depends on context, as with Greek sigma)."""
    return rows.select(key, _words(F.translate("text", _UPPER, _LOWER)).alias("all"))


def runs(rows: DataFrame, key: str) -> DataFrame:
    """key, run, w: each text's words in runs of RUN words and SPAN - 1 more, so that each window lies in one run."""
    number = F.greatest(F.ceil((F.size("all") - (SPAN - 1)) / RUN), F.lit(1)).cast("int")
    each = F.transform(F.sequence(F.lit(0), number - 1), lambda i: F.struct(i.alias("run"), F.slice("all", i * RUN + 1, RUN + SPAN - 1).alias("w")))
    # explode_outer here and below: explode lets the optimizer copy the arrays into a filter
    return _folded(rows, key).select(key, F.explode_outer(each).alias("r")).select(key, "r.run", "r.w").where("w IS NOT NULL")


def _grams(cut: DataFrame, key: str, k: int) -> DataFrame:
    """key, run, g: for each place of a run the hash of the k words from there, its low PLACE_BITS the place itself."""
    hashed = lambda x, i: F.xxhash64(x, *(F.get("w", i + j) for j in range(1, k)))
    own = F.transform("w", lambda x, i: hashed(x, i).bitwiseAND(F.lit(-1 << PLACE_BITS)).bitwiseOR(i.cast("long")))
    return cut.where(F.size("w") >= k).select(key, "run", F.slice(own, F.lit(1), F.size("w") - (k - 1)).alias("g"))


def _placed(grams: DataFrame, key: str, column: str) -> DataFrame:
    """key, run, pos, print of an array of hashes that hold their places."""
    each = grams.select(key, "run", F.explode_outer(column).alias("x")).where("x IS NOT NULL")
    return each.select(key, "run", F.col("x").bitwiseAND((1 << PLACE_BITS) - 1).cast("int").alias("pos"), F.shiftright("x", PLACE_BITS).alias("print"))


def fingerprints(rows: DataFrame, key: str) -> DataFrame:
    """key, run, pos, print: the smallest gram hash of every window of WINDOW grams, the first of equal ones.

    A hash ends in its place, so one minimum gives both; the hash proper has 64 - PLACE_BITS bits.
    """
    grams = _grams(runs(rows, key), key, GRAM)
    least = F.array_distinct(F.transform("g", lambda x, i: F.array_min(F.slice("g", i + 1, WINDOW))))
    return _placed(grams.select(key, "run", least.alias("p")), key, "p")


def _windows(rows: DataFrame) -> DataFrame:
    """item_id, size, win: every run of ``size`` words of the items (item_id, text, size)."""
    words = rows.select("item_id", "size", _words(F.translate("text", _UPPER, _LOWER)).alias("w"))
    places = words.select("item_id", "size", "w", F.explode_outer(F.sequence(F.lit(1), F.size("w") - F.col("size") + 1)).alias("pos"))
    return places.select("item_id", "size", F.concat_ws(" ", F.slice("w", F.col("pos"), F.col("size"))).alias("win")).distinct()


def _extended(docs: DataFrame, found: DataFrame, sizes: list[int]) -> DataFrame:
    """doc_id, pos, size, win: the windows that the grams found (doc_id, run, k, pos) lie in, spelled out.

    A gram of a long item is the least of its window, and so within WINDOW places of the window's start; a gram of a
    short item is its first. Windows of short items that lie where two runs overlap come twice, which counts as once.
    """
    spots = found.groupBy("doc_id", "run").agg(F.collect_set(F.struct("k", "pos")).alias("at")).groupBy("doc_id").agg(F.collect_list(F.struct("run", "at")).alias("runs"))
    texts = docs.join(spots, "doc_id").select("doc_id", "runs", _words(F.translate("text", _UPPER, _LOWER)).alias("all"))
    each = F.transform("runs", lambda r: F.struct(r["run"].alias("run"), r["at"].alias("at"), F.slice("all", r["run"] * RUN + 1, RUN + SPAN - 1).alias("w")))
    rows = texts.select("doc_id", F.explode_outer(each).alias("r")).select("doc_id", "r.run", "r.at", "r.w").where("w IS NOT NULL")
    starts = None
    for size in sizes:
        k, reach = (SPAN, WINDOW - 1) if size == SPAN else (min(size, GRAM), 0)
        spread = F.transform(F.filter("at", lambda x: x["k"] == k), lambda x: F.filter(F.sequence(x["pos"] - reach, x["pos"]), lambda p: (p >= 0) & (p + size <= F.size("w"))))
        own = F.transform(F.array_distinct(F.flatten(spread)), lambda p: F.struct(p.alias("p"), F.lit(size).alias("size")))
        starts = own if starts is None else F.concat(starts, own)
    each = rows.select("doc_id", "run", "w", F.explode_outer(starts).alias("s")).where("s IS NOT NULL")
    return each.select("doc_id", (F.col("run") * RUN + F.col("s.p")).alias("pos"), "s.size", F.concat_ws(" ", F.slice("w", F.col("s.p") + 1, F.col("s.size"))).alias("win"))


def contamination(docs: DataFrame, benchmark: DataFrame, staging: Staging) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of documents (doc_id, text) against items.

    An item's windows are its runs of 13 words, or the whole item where it has fewer; a word of a document is hit if
    it lies in an occurrence of a window. Texts are taken in runs of words, so a text of any length needs no more
    memory than its words. Winnowed fingerprints of both sides, with their places, are joined: with 5-word grams and
    windows of 9 grams no shared run of 13 words escapes. Items of fewer words have no such guarantee, so for those,
    where there are any, all grams of the documents are joined with the first gram of the item. From the places found
    the windows around are spelled out and joined, word for word, with those of the items. Windows that the same items
    hold are one class, so that a passage which many items share costs its documents one row a window.

    Null, empty or wordless texts have no words and no hits. Items without words take no part. Repeated item_ids
    count once as items, all their texts taking part; repeated doc_ids count once, with their smallest text; other
    columns are ignored. An empty table of items leaves every document without hits. Spark broadcasts the benchmark's
    fingerprints and windows only if its own size check allows it.
    """
    docs = one_per_id(docs, "doc_id", "text")
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    items = items.withColumn("words", F.size(_words(F.col("text")))).where("words > 0").distinct()
    items = staging.save(items.withColumn("size", F.least("words", F.lit(SPAN))), "items")
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())  # 13 values at most
    counts = docs.select("doc_id", F.size(_words(F.col("text"))).cast("long").alias("n_words"))
    none, zero = F.sha2(F.lit(""), 256), F.lit(0).cast("long")
    if not sizes:
        out = counts.withColumns({"n_hit": zero, "n_items": zero, "items_sha256": none})
        return out.withColumn("contaminated", F.lit(False))
    prints = staging.save(fingerprints(items.where(F.col("words") >= SPAN), "item_id").select("print").distinct(), "prints")
    found = fingerprints(docs, "doc_id").join(prints, "print").select("doc_id", "run", F.lit(SPAN).alias("k"), "pos")
    for k in sorted({min(n, GRAM) for n in sizes if n < SPAN}):
        short = items.where((F.col("words") < SPAN) & (F.least("words", F.lit(GRAM)) == k))
        first = staging.save(_placed(_grams(runs(short, "item_id"), "item_id", k), "item_id", "g").where("pos = 0").select("print").distinct(), f"short{k}")
        grams = _placed(_grams(runs(docs, "doc_id"), "doc_id", k), "doc_id", "g")
        found = found.union(grams.join(first, "print").select("doc_id", "run", F.lit(k).alias("k"), "pos"))
    found = staging.save(found, "found")
    classes = _windows(items).groupBy("win").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    classes = staging.save(classes.withColumn("class", F.sha2(F.to_json("items"), 256)), "classes")
    hits = staging.save(_extended(docs, found, sizes).join(classes.select("win", "class"), "win").select("doc_id", "pos", "size", "class"), "hits")
    before = F.max(F.col("pos") + F.col("size")).over(Window.partitionBy("doc_id").orderBy("pos", "size").rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("pos") + F.col("size")
    covered = hits.select("doc_id", "pos", "size").withColumn("new", F.greatest(F.lit(0), end - F.greatest(F.col("pos"), F.coalesce(before, F.lit(0)))))
    covered = covered.groupBy("doc_id").agg(F.sum("new").alias("n_hit"))
    lists = classes.groupBy("class").agg(F.first("items").alias("items"))
    named = hits.select("doc_id", "class").distinct().join(lists, "class").select("doc_id", F.explode("items").alias("item")).distinct().groupBy("doc_id")
    named = named.agg(F.count(F.lit(1)).alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("item"))), 256).alias("items_sha256"))
    out = counts.join(covered.join(named, "doc_id"), "doc_id", "left")
    out = out.select("doc_id", "n_words", F.coalesce("n_hit", zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"), F.coalesce("items_sha256", none).alias("items_sha256"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that lie in passages of the benchmark."""
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Staging(spark, "op9"))


SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS p FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, p, n, item_id FROM dw JOIN iw USING (n, win)),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hit) GROUP BY doc_id),
nam AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',')) AS items_sha256 FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN cov USING (doc_id) LEFT JOIN nam USING (doc_id)
"""
