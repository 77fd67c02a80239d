"""Held-out accuracy; predictions against a plain model; odd rows."""

import math
from collections import Counter
from zlib import crc32

from pyspark.sql import functions as F

from cartoloom.llm import langid


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = langid.op8_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = got.where("held_out").select((F.col("lang") == F.col("lang_pred")).cast("int").alias("ok"), "score").collect()
    assert len(rows) > 200 and sum(r.ok for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark, odd_documents):
    train = spark.createDataFrame([(i, "the cat sat on the mat and the dog", "en") for i in range(8)] + [(50 + i, "le chat est sur la table avec un chien", "fr") for i in range(8)], "doc_id long, text string, lang string")
    model = langid.trained(train)
    got = [(r.doc_id, r.lang_pred) for r in langid.predicted(odd_documents, model, "doc_id", "n").collect()]
    assert len(got) == 13
    assert {i for i, x in got if x == "und"} == {1, 2, 3, 10}
    texts = spark.createDataFrame([(1, "the dog"), (2, "LE CHIEN"), (3, "chattable")], "doc_id long, text string")
    assert {r.doc_id: r.lang_pred for r in langid.predicted(texts, model, "doc_id").collect()} == {1: "en", 2: "fr", 3: "fr"}
    empty = langid.trained(train.limit(0))
    assert {r.lang_pred for r in langid.predicted(texts, empty, "doc_id").collect()} == {"und"}
    assert langid.predicted(texts.limit(0), model, "doc_id").count() == 0


class Plain:
    """The model with dictionaries, a word at a time."""

    def __init__(self, labelled):
        self.langs = sorted({x for x, _ in labelled})
        words = Counter((w, x) for x, t in labelled for w in self.words(t))
        self.tables = {0: self.table(words, langid.KNOWN)}
        for n in langid.ORDERS:
            grams = Counter()
            for w, x in words:
                for g in self.grams(w, n):
                    grams[g, x] += 1
            self.tables[n] = self.table(grams, 2)

    @staticmethod
    def words(text):
        return "".join(c if c.isalpha() else " " for c in (text or "").lower()).split(" ")

    @staticmethod
    def grams(word, n):
        edged = ("#", *word, "#")
        return [edged[i : i + n] for i in range(len(edged) - n + 1)] if word else []

    def table(self, counts, least):
        counts = Counter({k: c for k, c in counts.items() if k[0]})
        keys = {k for k, _ in counts}
        totals = {x: sum(c for (_, y), c in counts.items() if y == x) + langid.SMOOTH * max(1, len(keys)) for x in self.langs}
        return {k: [math.log((counts[k, x] + langid.SMOOTH) / totals[x]) for x in self.langs] for k in keys if sum(counts[k, x] for x in self.langs) >= least}

    def score(self, word):
        if word in self.tables[0]:
            return self.tables[0][word]
        for n in langid.ORDERS:
            known = [self.tables[n][g] for g in self.grams(word, n) if g in self.tables[n]]
            if known:
                return [sum(x) / len(known) for x in zip(*known)]
        return [0.0] * len(self.langs)

    def predict(self, text):
        words = [w for w in self.words(text) if w]
        if not words:
            return "und", 0.0
        total = [sum(x) for x in zip(*map(self.score, words))]
        share = [math.exp(t - max(total)) for t in total]
        best = max(range(len(total)), key=total.__getitem__)
        return self.langs[best], share[best] / sum(share)


def test_query_matches_plain_model(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    learned = [(r.lang, r.text) for r in rows if r.lang and r.text and crc32(str(r.doc_id).encode()) % 4 != 2]
    model = Plain(learned)
    got = {r.doc_id: r for r in langid.op8_language_id(spark, small).collect()}
    assert len(got) == len({r.doc_id for r in rows})
    for r in rows:
        lang, score = model.predict(r.text)
        assert got[r.doc_id].lang_pred == lang and math.isclose(got[r.doc_id].score, score, rel_tol=1e-6, abs_tol=1e-9), (r.doc_id, got[r.doc_id], lang, score)


def test_odd_rows(spark, odd_documents):
    docs = odd_documents.withColumns({c: odd_documents.doc_id for c in ("score", "lang_pred", "held_out")})
    model = langid.trained(docs)
    got = langid.predicted(docs, model, "doc_id", "n").collect()
    assert len(got) == docs.count()
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3, 10)} == {"und"} and {r.score for r in got if r.doc_id in (1, 2, 3, 10)} == {0.0}
    assert langid.predicted(docs.limit(0), model, "doc_id").count() == 0
    nothing = langid.trained(docs.limit(0))
    assert {r.lang_pred for r in langid.predicted(docs, nothing, "doc_id").collect()} == {"und"}
