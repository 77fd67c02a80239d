"""The training-data pipeline: documents through five stages, each written and read again before the next.

Each stage is judged on its own input and returns the columns of documents; the last adds the piece ids. Stages take
texts whole, however long, nulls in any column, tables without rows and columns of any name besides doc_id and text (lang
too for the first); only a column ``ids`` is replaced by the last. Rows that repeat a doc_id are one document.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartoloom.llm.common import Staging, one_per_id, table
from cartoloom.llm.decontaminate import contamination
from cartoloom.llm.langid import predicted, trained
from cartoloom.llm.near_dedup import near_duplicates
from cartoloom.llm.pii import personal_data, redacted
from cartoloom.llm.sentencepiece import recoded

#: A document whose language is more uncertain than this is rejected, as is one without letters.
LEAST_LANGUAGE_SCORE = 0.5


def unique_rows(docs: DataFrame) -> DataFrame:
    """Documents with one row for each doc_id; of differing rows of an id the smallest stays (see null_ids_kept for null)."""
    if docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
        return docs
    rest = [c for c in docs.columns if c != "doc_id"]
    return docs.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row")).select("doc_id", "row.*").select(*docs.columns)


def null_ids_kept(stage):
    """A stage that takes each document without a doc_id as one of its own, after all others; its id stays null.

    Rows without an id that are alike in every column are one document.
    """

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if docs.where("doc_id IS NULL").isEmpty():
            return stage(spark, docs, sf_dir)
        own = F.lit(1 << 62) + F.xxhash64(*(F.col(c) for c in docs.columns if c != "doc_id")).bitwiseAND((1 << 62) - 1)
        named = docs.withColumn("_no_id", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), own))
        out = stage(spark, named, sf_dir)
        return out.withColumn("doc_id", F.when(~F.col("_no_id"), F.col("doc_id")).cast(docs.schema["doc_id"].dataType)).drop("_no_id")

    return run


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that language identification rejects; the model learns from the labelled ones.

    Columns other than doc_id, text and lang may have any name: they go by their places meanwhile.
    """
    model = trained(docs)
    own = {c: c if c == "text" else f"column{i}" for i, c in enumerate(docs.columns)}
    named = predicted(docs.select(*(F.col(f"`{c}`").alias(a) for c, a in own.items())), model, *own.values())
    kept = named.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(*(F.col(a).alias(c) for c, a in own.items()))


@null_ids_kept
def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near duplicates (five words, 0.8)."""
    docs = unique_rows(docs)
    found = near_duplicates(docs, Staging(spark, "stage-dedup"))
    return docs.join(found.where("kept").select("doc_id"), "doc_id", "left_semi").select(*docs.columns)


@null_ids_kept
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that are contaminated with passages of the benchmark."""
    docs = unique_rows(docs)
    found = contamination(docs, table(spark, sf_dir, "benchmark"), Staging(spark, "stage-bench"))
    return docs.join(found.where("contaminated").select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


@null_ids_kept
def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by the names of their kinds; n_chars follows the text. No document goes."""
    docs = unique_rows(docs)
    spans = personal_data(one_per_id(docs, "doc_id", "text"), Staging(spark, "stage-private"))
    out = redacted(docs, spans)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ids, the text's pieces; text is what decoding them gives."""
    return recoded(docs).select(*docs.columns, "ids")


STAGES = [
    ("language identification", language),
    ("near-duplicate removal", near_duplicate),
    ("benchmark decontamination", decontamination),
    ("personal data", private),
    ("piece encoding", pieces),
]

#: Bootstrapped contexts, language models and piece searches are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` after all stages."""
    staging = Staging(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = staging.save(stage(spark, docs, sf_dir), f"stage{i}")
        if i:
            staging.drop(f"stage{i - 1}")
    return docs
