"""Removed bytes against a plain dictionary of all windows."""

import hashlib
import random

import numpy as np

from cartoloom.llm import substring_dedup as sd


def brute(texts):
    seen, out = set(), {}
    for i in sorted(texts):
        raw = (texts[i] or "").encode()
        cover = np.zeros(len(raw), bool)
        for p in range(len(raw) - 99):
            w = raw[p : p + 100]
            if w in seen:
                cover[p : p + 100] = True
            seen.add(w)
        spans = int((cover & ~np.concatenate([[False], cover[:-1]])).sum()) if len(raw) else 0
        out[i] = (len(raw), int(cover.sum()), spans, hashlib.sha256(bytes(np.frombuffer(raw, np.uint8)[~cover])).hexdigest())
    return out


def rows(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.text)).hexdigest()) for r in df.collect()}


def test_same_as_all_windows(spark, odd_documents):
    rng = random.Random(4)
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(90, 400))) for _ in range(6)]
    texts = {}
    for i in range(120):
        parts = [rng.choice(passages)[rng.randrange(0, 60) :] if rng.random() < 0.5 else "".join(rng.choice("xyz w") for _ in range(rng.randrange(150))) for _ in range(4)]
        texts[i] = "".join(parts)
    texts |= {200: "a" * 1000, 201: "ab" * 300, 202: "a" * 99, 203: "a" * 100, 204: None, 205: "", 206: passages[0] * 5, 207: "-" * 150 + passages[1] + "-" * 150}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, part int").repartition(9)
    assert rows(sd.without_repeats(docs)) == brute(texts)
    odd = {r.doc_id: r.text for r in odd_documents.collect()}
    assert rows(sd.without_repeats(odd_documents)) == brute(odd)
    assert sd.without_repeats(docs.limit(0)).count() == 0


def test_suffix_order_is_that_of_the_bytes():
    rng = np.random.default_rng(1)
    data = rng.choice(np.frombuffer(b"ab", np.uint8), 4000)
    count = rng.integers(1, 40, 30)
    start = rng.integers(0, 3800, 30)
    at = start + rng.integers(0, 60, 30)
    ctx = sd.Contexts(data, start, at, count, rng.integers(0, 3, 30).astype(np.uint64))
    want = sorted(range(30), key=lambda i: (ctx.key[i], data[at[i] : start[i] + count[i] + 99].tobytes()))
    assert [(ctx.key[i], data[at[i] : start[i] + count[i] + 99].tobytes()) for i in ctx.suffix_order()] == [(ctx.key[i], data[at[i] : start[i] + count[i] + 99].tobytes()) for i in want]


def test_parts_are_the_same_in_sql(spark):
    ids = [0, 1, -1, 7, 2**62, -(2**63), 2**63 - 1, 123456789]
    got = {r.id: r.p for r in spark.createDataFrame([(i,) for i in ids], "id long").select("id", sd._part_column(sd.F.col("id"), 97).alias("p")).collect()}
    assert got == dict(zip(ids, sd._part(np.array(ids, np.int64), 97).tolist()))
