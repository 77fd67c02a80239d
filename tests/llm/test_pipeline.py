"""The pipeline's rows against a plain run of its rules over a small table."""

import corpus_pipeline
from cartoloom.llm import sentencepiece
from tests.llm.test_near_dedup import brute as classes
from tests.llm.test_pii import base
import re


def words13(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def contaminated(text, items):
    words, hit = words13(text), set()
    for item in items:
        own = words13(item)
        size = min(13, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for p in range(len(words) - size + 1 if own else 0):
            if tuple(words[p : p + size]) in windows:
                hit.update(range(p, p + size))
    return bool(hit) and 20 * len(hit) >= len(words)


def redact(text):
    spans, out, at = sorted((s, e, k) for k, s, e in base(text)), "", 0
    for s, e, k in spans:
        if s >= at:
            out += text[at:s] + f"<{k}>"
        at = max(at, e)
    return out + text[at:]


def test_rows(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, small).collect()}
    lettered = {i: t for i, t in docs.items() if any(c.isalpha() for c in t or "")}
    found = classes(lettered, 5, 80)
    want = {i: redact(t) for i, t in lettered.items() if found[i][1] == i and not contaminated(t, items)}
    assert {i: r.text for i, r in got.items()} == want
    library = sentencepiece.Pieces.load()
    for r in got.values():
        assert r.n_chars == len(r.text) and bytes(sentencepiece.decode(library, sentencepiece.np.array(r.ids), sentencepiece.np.array([len(r.ids)]))[0]).decode() == r.text


def test_odd_rows(spark, odd_documents, small):
    docs = odd_documents.drop("ids")
    for _, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, small)
        assert set(docs.columns) <= set(done.columns)
        done.collect()
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicate(spark, docs, small).collect()) == [1, 2, 3, 4, 6, 8, 10, 11, 12]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), small).count() == 0


def without_ids(spark, odd_documents):
    texts = ["quiet rivers carry cold water to the wide sea", "call me at a@b.co when seven lanterns burn", "alpha beta gamma delta"]
    return texts, odd_documents.where("doc_id < 8").unionByName(spark.createDataFrame([(None, t, "en", 0, 1, "k", 0) for t in texts], odd_documents.schema))


def test_private_without_id(spark, odd_documents, small):
    texts, docs = without_ids(spark, odd_documents)
    out = corpus_pipeline.private(spark, docs, small)
    assert out.columns == docs.columns
    assert sorted(r.text for r in out.collect() if r.doc_id is None) == sorted([texts[0], "call me at <email> when seven lanterns burn", texts[2]])


def test_near_duplicates_without_id(spark, odd_documents, small):
    texts, docs = without_ids(spark, odd_documents)
    kept = corpus_pipeline.near_duplicate(spark, docs, small).collect()
    assert sorted(r.text for r in kept if r.doc_id is None) == sorted(texts[:2])
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 2, 3, 4, 6]


def test_clashing_names(spark, small):
    names = ["score", "lang_pred", "cut", "row", "column0", "run", "pos", "kept", "component_id", "contaminated", "words"]
    docs = spark.createDataFrame([(1, "en", "write to a@b.co when quiet rivers carry cold water", *names), (2, "en", None, *names)], "doc_id long, lang string, text string, " + ", ".join(f"{n} string" for n in names))
    for _, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, small)
        assert set(docs.columns) <= set(done.columns)
        assert all(r[n] == n for r in done.collect() for n in names)
