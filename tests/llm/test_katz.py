"""Scores against a plain dictionary model; every context's probabilities add up to 1."""

import math
import re
from collections import Counter, defaultdict
from zlib import crc32

from cartoloom.llm import katz
from cartoloom.llm.common import Staging

FOLD = {i: i + 32 for i in range(65, 91)}


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD)), None]


class Plain:
    def __init__(self, texts):
        self.one, self.two, self.after = Counter(), Counter(), defaultdict(set)
        for t in texts:
            h = None
            for w in tokens(t):
                self.one[w] += 1
                self.two[h, w] += 1
                self.after[h].add(w)
                h = w
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.k1, self.k2 = (katz.discounts([sum(c == r for c in x.values()) for r in range(1, 7)]) for x in (self.one, self.two))
        self.unknown = 1 - sum(self.keep(c, self.k1) for c in self.one.values()) / self.n if self.n else 1.0

    @staticmethod
    def keep(c, k):
        return c * k[c] if c <= katz.LOW else c - katz.TAIL

    def single(self, w):
        return self.keep(self.one[w], self.k1) / self.n if w in self.one else self.unknown

    def p(self, h, w):
        if (h, w) in self.two:
            return self.keep(self.two[h, w], self.k2) / self.one[h]
        if h not in self.one:
            return self.single(w)
        left = 1 - sum(self.keep(self.two[h, x], self.k2) for x in self.after[h]) / self.one[h]
        return left / (1 - sum(self.single(x) for x in self.after[h])) * self.single(w)

    def score(self, text):
        h, total = None, 0.0
        for w in tokens(text):
            total += math.log10(self.p(h, w))
            h = w
        return total

    def base(self, text):
        return sum(math.log10((self.one[w] + 1) / (self.n + self.v + 1)) for w in tokens(text))


def test_query_matches_plain_model(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    model = Plain([t for i, t in texts.items() if crc32(str(i).encode()) % 7 != 2])
    got = katz.op4_katz_scores(spark, small).collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        t = texts[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc32(str(r.doc_id).encode()) % 7 == 2, len(tokens(t)), sum(w in model.one for w in tokens(t)), model.n)
        assert math.isclose(r.base_score, model.base(t), rel_tol=1e-9)
        assert math.isclose(r.score, model.score(t), rel_tol=1e-10), r.doc_id
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_contexts_add_up(spark, small):
    texts = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").limit(12).collect()]
    model = Plain(texts)
    for h in [None, *list(model.one)[:40], "unseen word"]:
        assert math.isclose(sum(model.p(h, w) for w in [*model.one, "another unseen"]), 1, rel_tol=1e-9)


def test_odd_rows(spark, odd_documents):
    docs = odd_documents.dropDuplicates(["doc_id"]).select("doc_id", "text", (odd_documents.doc_id % 2 == 0).alias("held"))
    docs = docs.withColumns({c: docs.doc_id for c in ("src", "part", "tokens", "totals", "score", "counts")})
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = Plain([t for i, t in texts.items() if i % 2])
    got = {r.doc_id: r for r in katz.scored(docs, Staging(spark, "t")).collect()}
    assert set(got) == set(texts)
    for i, t in texts.items():
        assert math.isclose(got[i].score, model.score(t), rel_tol=1e-10), i
    from pyspark.sql import functions as F

    assert {r.score for r in katz.scored(docs.withColumn("held", F.lit(True)), Staging(spark, "t")).collect()} == {0.0}
    assert katz.scored(docs.limit(0), Staging(spark, "t")).count() == 0
