"""Exact answers against brute force, with ties, odd vectors and repeated rows."""

import math

import numpy as np

from cartoloom.llm import topk
from cartoloom.llm.common import Staging


def brute(rows, k):
    good = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    first = {i: min(v for j, v in good if j == i) for i in {i for i, _ in good}}
    good, out = first.items(), set()
    for i, q in good:
        if i % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(found)}
    return out


def answers(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rank int, q int").repartition(5)
    return {tuple(r) for r in topk.top_k(df, "vec_id % 50 = 0", Staging(spark, "t"), **kw).select("query_id", "rank", "vec_id", "score").collect()}


def test_ties_and_odd_vectors(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 4]) for i in range(400)]
    rows += [(500, None), (550, [1.0, None]), (600, [float("nan")] * 6), (650, [float("inf")] * 6), (700, []), (750, [1.0]), (7, rows[7][1]), (8, [0.5] * 6), (50, [-0.25] * 6)]
    want = brute(rows, 5)
    assert answers(spark, rows) == want
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "VECTOR_BLOCK", 50)
    assert answers(spark, rows) == want


def test_cells_in_parts(monkeypatch):
    rng = np.random.default_rng(4)
    vectors = [rng.integers(-3, 4, 5) for _ in range(100)]
    ids = np.arange(100)
    monkeypatch.setattr(topk, "QUERIES_AT_ONCE", 2)
    monkeypatch.setattr(topk, "VECTORS_AT_ONCE", 7)
    got = topk.best_of_cell(ids[::9], vectors[::9], ids, vectors, 4)
    want = [(q, v, s) for q in ids[::9] for s, v in sorted((-int(vectors[q] @ vectors[v]), v) for v in ids if v != q)[:4]]
    assert [(q, v, -s) for q, v, s in zip(*(x.tolist() for x in got), strict=True)] == want


def test_few_rows(spark):
    rows = [(0, [1.0, 0.5]), (50, [0.25, -0.5]), (3, [0.0, 0.0])]
    assert answers(spark, rows) == brute(rows, 5)
    assert answers(spark, rows[2:]) == set()
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id % 50 = 0", Staging(spark, "t")).count() == 0
