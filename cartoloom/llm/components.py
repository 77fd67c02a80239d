"""Connected components of a link table by local union-find and distributed contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Staging


def union_find(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids of the links (a, b), and the smallest id that each is joined to by them."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(ids)))
    for x, y in zip(at[: len(a)].tolist(), at[len(a) :].tolist(), strict=True):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x < y:
            parent[y] = x
        elif y < x:
            parent[x] = y
    for i, p in enumerate(parent):  # parents are smaller: one pass in order settles all
        parent[i] = parent[p]
    return ids, ids[np.array(parent, np.int64)] if len(ids) else ids


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each batch as a forest of stars: at most one row for an id."""
    for batch in batches:
        if batch.num_rows:
            ids, roots = union_find(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            moved = ids != roots
            yield pa.RecordBatch.from_arrays([pa.array(roots[moved]), pa.array(ids[moved])], names=["a", "b"])


def components(links: DataFrame, staging: Staging, label: str) -> DataFrame:
    """(node, root) for every node of ``links`` (a long, b long): root is the smallest node it can reach.

    Each task first joins its own links by union-find. Then rounds of contraction follow: every node hooks to its
    smallest neighbour, two pointer jumps shorten the chains, and links between the new roots go on to the next
    round, so that links at least halve. Rounds are written to the shared folder. No link goes to the driver. Links
    of a node to itself say only that the node exists. No links: no rows.
    """
    nodes = staging.save(links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct(), f"{label}-nodes")
    rest = staging.save(links.where("a <> b").mapInArrow(_forest, "a long, b long").distinct(), f"{label}-links0")
    label_of = nodes.select("node", F.col("node").alias("root"))
    turn = 0
    while not rest.isEmpty():
        both = rest.union(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("up"))
        hook = staging.save(hook, f"{label}-hook{turn}")
        for _ in range(2):
            over = hook.select(F.col("node").alias("up"), F.col("up").alias("top"))
            hook = hook.join(over, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
        hook = staging.save(hook, f"{label}-jump{turn}")
        ha, hb = (hook.select(F.col("node").alias(x), F.col("up").alias(f"p{x}")) for x in "ab")
        left = rest.join(ha, "a", "left").join(hb, "b", "left").select(F.coalesce("pa", "a").alias("x"), F.coalesce("pb", "b").alias("y"))
        left = left.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
        rest = staging.save(left, f"{label}-links{turn + 1}")
        label_of = label_of.join(hook.select(F.col("node").alias("root"), "up"), "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        label_of = staging.save(label_of, f"{label}-root{turn}")
        turn += 1
    return label_of
