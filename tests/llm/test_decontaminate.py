"""Hits against a plain search for every window; shared spans never escape winnowing."""

import hashlib
import random
import re

from cartoloom.llm import decontaminate as d
from cartoloom.llm.common import Staging

FOLD = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def brute(texts, items):
    out = {}
    for i, t in texts.items():
        w, hit, named = words(t), set(), set()
        for item, text in items:
            own = words(text)
            size = min(13, len(own))
            windows = {tuple(own[j : j + size]) for j in range(len(own) - size + 1)} if own else set()
            for p in range(len(w) - size + 1 if own else 0):
                if tuple(w[p : p + size]) in windows:
                    hit.update(range(p, p + size))
                    named.add(str(item))
        out[i] = (len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


def rows(df):
    return {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in df.collect()}


def test_planted_passages(spark, odd_documents):
    rng = random.Random(8)
    some = lambda n: [f"w{rng.randrange(300)}" for _ in range(n)]
    items = [(i, " ".join(some(n))) for i, n in enumerate([40, 13, 20, 14, 12, 7, 4, 1, 0, 60])] + [(3, "ÉCOLE É K one two three four five six seven eight nine ten eleven"), (20, None), (21, "...")]
    texts = {}
    for i in range(60):
        item = words(items[rng.randrange(len(items))][1])
        at, n = rng.randrange(max(1, len(item))), rng.randrange(1, 30)
        texts[i] = " ".join([*some(rng.randrange(40)), *item[at : at + n], *some(rng.randrange(200))]).upper() if i % 3 else "; ".join([*item, *some(60)])
    texts |= {100: None, 101: "", 102: "École é K one two three four five six seven eight nine ten eleven", 103: "ÉCOLE É K ONE TWO three four five six seven eight nine ten eleven"}
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in texts.items()], "doc_id long, text string, win string, pos int")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    assert rows(d.contamination(docs, bench, Staging(spark, "t"))) == brute(texts, items)
    long = [x for x in items if len(words(x[1])) >= 13]
    assert rows(d.contamination(docs, bench.where("item_id IN (0, 1, 2, 9)"), Staging(spark, "t"))) == brute(texts, [x for x in long if x[0] in (0, 1, 2, 9)])
    odd = {r.doc_id: r.text for r in odd_documents.collect()}
    assert rows(d.contamination(odd_documents, bench, Staging(spark, "t"))) == brute(odd, items)
    assert rows(d.contamination(docs, bench.limit(0), Staging(spark, "t"))) == brute(texts, [])
    assert d.contamination(docs.limit(0), bench, Staging(spark, "t")).count() == 0


def test_equal_words_hash_equally_whatever_follows(spark):
    rows = spark.createDataFrame([(1, "ΟΔΟΣ.α Beta"), (2, "ΟΔΟΣ α bETA")], "doc_id long, text string")
    a, b = (r.g for r in d._grams(d.runs(rows, "doc_id"), "doc_id", 1).orderBy("doc_id").collect())
    assert a == b and len(a) == 3


def test_passages_across_the_ends_of_runs(spark):
    rng = random.Random(3)
    some = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    items = [(1, " ".join(some(13))), (2, " ".join(some(40))), (3, " ".join(some(6))), (4, " ".join(some(2)))]
    texts = {}
    for i, at in enumerate((d.RUN - 40, d.RUN - 13, d.RUN - 12, d.RUN - 1, d.RUN, 2 * d.RUN - 7, 5 * d.RUN - 3, 0)):
        for item, text in items:
            own = text.split()
            texts[10 * i + item] = " ".join([*some(at), *own, *some((i * 700) % 2100)])
    texts[99] = " ".join(some(d.RUN + 12))
    for i, n in enumerate((0, 3, 7, 11)):  # short items in the words that end the only run
        texts[200 + i] = " ".join([*some(d.RUN + 12 - 6 - n), *items[2][1].split(), *some(n)])
        texts[210 + i] = " ".join([*some(d.RUN + n), *items[3][1].split()])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows(d.contamination(docs, bench, Staging(spark, "t"))) == brute(texts, items)


def test_a_passage_that_many_items_and_documents_share(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    items = [(i, passage if i % 2 else f"{passage} end{i}") for i in range(40)]
    texts = {i: f"a b {passage} c{i} " * 3 for i in range(50)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert rows(d.contamination(docs, bench, Staging(spark, "t"))) == brute(texts, items)
