"""Exact top-k inner products by exhaustive term-at-a-time accumulation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Staging, table

#: Queries and vectors of a block, about, and how many of each are scored at once: they bound a task's memory, not the
#: rows that take part.
QUERY_BLOCK, VECTOR_BLOCK = 2048, 8192
QUERIES_AT_ONCE, VECTORS_AT_ONCE = 256, 2048


def postings(vectors: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each term (component) with any weight, the places of the vectors that have it, and their weights."""
    lengths = np.array([len(v) for v in vectors], np.int64)
    flat = np.concatenate(vectors) if len(vectors) else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(vectors)), lengths)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    some = flat != 0
    flat, row, term = flat[some], row[some], term[some]
    order = np.argsort(term, kind="stable")
    cuts = np.flatnonzero(np.diff(term[order])) + 1
    return {int(term[at[0]]): (row[at], flat[at]) for at in np.split(order, cuts) if len(at)}


def score_block(queries: dict[int, tuple[np.ndarray, np.ndarray]], n_queries: int, vectors: dict[int, tuple[np.ndarray, np.ndarray]], n_vectors: int) -> np.ndarray:
    """Dense scores (query, vector): term by term, query weights times the term's postings are added in."""
    scores = np.zeros((n_queries, n_vectors), np.int64)
    for term, (rows, weights) in queries.items():
        if term in vectors:
            at, values = vectors[term]
            part = weights[:, None] * values[None, :]
            if len(rows) == n_queries and len(at) == n_vectors:
                scores += part
            else:
                scores[rows[:, None], at[None, :]] += part
    return scores


def partition_top(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of each row's k best without those of its own id; ties at the k-th score are kept."""
    least = np.iinfo(np.int64).min
    scores[ids[None, :] == own[:, None]] = least
    if scores.shape[1] > k:
        floor = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
    else:
        floor = np.full(len(scores), least)
    row, col = np.nonzero((scores >= floor[:, None]) & (scores > least))
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    row, col = row[place < k], col[place < k]
    return row, ids[col], scores[row, col]


def _rows(column: pa.Array) -> list[np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, offs = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(offs[:-1], offs[1:], strict=True)]


def integer_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, q array<long>: floor(256 * x) of each component; vectors with null or non-finite ones are left out."""
    good = F.col("embedding").isNotNull() & ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & good)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("q"))
    if rows.groupBy("vec_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
        return rows
    return rows.groupBy("vec_id").agg(F.min("q").alias("q"))


def best_of_cell(own: np.ndarray, asked: list[np.ndarray], ids: np.ndarray, vectors: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vec_id, score): the k best of the vectors for each query, a part of each at a time."""
    parts = [(ids[lo : lo + VECTORS_AT_ONCE], postings(vectors[lo : lo + VECTORS_AT_ONCE])) for lo in range(0, len(ids), VECTORS_AT_ONCE)]
    out = []
    for lo in range(0, len(own), QUERIES_AT_ONCE):
        some = own[lo : lo + QUERIES_AT_ONCE]
        weights = postings(asked[lo : lo + QUERIES_AT_ONCE])
        found = [partition_top(score_block(weights, len(some), held, len(part)), part, some, k) for part, held in parts]
        row, vec, score = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((vec, -score, row))
        row, vec, score = row[order], vec[order], score[order]
        best = np.arange(len(row)) - np.searchsorted(row, row) < k
        out.append((some[row[best]], vec[best], score[best]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def top_k(vectors: DataFrame, is_query: str, staging: Staging, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best integer inner products of each query with all other vectors.

    Queries are dealt to blocks of about QUERY_BLOCK rows and vectors to blocks of about VECTOR_BLOCK; each pair of
    blocks is one task's cell, which holds the postings of its vectors and keeps k rows a query. A window merges the
    cells' rows. The driver holds two counts and nothing else, and the plan is the same for any number of blocks. Ties
    go to the smaller vec_id. A query is never its own candidate, by vec_id. Repeated vec_ids count once, with their
    smallest vector. Vectors that are null, or hold null or non-finite components, take no part; shorter vectors end
    in zeros, and empty ones score 0. No queries, or no vectors: no rows. Other columns are ignored.
    """
    rows = staging.save(integer_vectors(vectors), "vectors")
    n_queries, n_vectors = rows.agg(F.count(F.when(F.expr(is_query), 1)), F.count(F.lit(1))).first()
    if not n_queries:
        return staging.spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    ni, nj = -(-n_queries // QUERY_BLOCK), -(-n_vectors // VECTOR_BLOCK)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    of = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    asked = rows.where(is_query).select("vec_id", "q", F.lit(True).alias("asks"), of(ni).alias("i"), every(nj).alias("j"))
    cells = asked.union(rows.select("vec_id", "q", F.lit(False).alias("asks"), every(ni).alias("i"), of(nj).alias("j")))
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def cell(table: pa.Table) -> pa.Table:
        two = [table.filter(table.column("asks")), table.filter(pc.invert(table.column("asks")))]
        if not all(t.num_rows for t in two):
            return schema.empty_table()
        own, ids = (t.column("vec_id").to_numpy() for t in two)
        asked, held = (_rows(t.column("q")) for t in two)
        return pa.table([pa.array(x, pa.int64()) for x in best_of_cell(own, asked, ids, held, k)], schema=schema)

    best = cells.repartition("i", "j").groupBy("i", "j").applyInArrow(cell, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth vector, among all."""
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0", Staging(spark, "op6"), k=5)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
e AS (SELECT vec_id, unnest(q) AS x, unnest(range(len(q))) AS t FROM v),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score FROM e a JOIN e b ON a.t = b.t AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0 GROUP BY a.vec_id, b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
