"""Segmentations against the library's own unigram search over the same pieces; exact round trips."""

import random

import numpy as np
import sentencepiece

from cartoloom.llm import sentencepiece as sp


def number(data, at):
    end = next(i for i in range(at, len(data)) if data[i] < 128)
    return sum((b & 127) << 7 * i for i, b in enumerate(data[at : end + 1])), end + 1


def as_unigram(path):
    """The model file with its kind changed to unigram, nothing else."""
    data, out, at = open(path, "rb").read(), bytearray(), 0
    while at < len(data):
        begin = at
        tag, at = number(data, at)
        size, body = number(data, at)
        at = body + size
        if tag >> 3 == 2:  # the trainer's settings: the kind is field 3
            own, i = bytearray(), body
            while i < at:
                j = i
                t, i = number(data, i)
                if t & 7 == 0:
                    _, i = number(data, i)
                elif t & 7 == 2:
                    n, i = number(data, i)
                    i += n
                else:
                    i += 4 if t & 7 == 5 else 8
                if t >> 3 != 3:
                    own += data[j:i]
            own += bytes([3 << 3, 1])
            n, head = len(own), bytearray([tag])
            while n >= 128:
                head.append(n & 127 | 128)
                n >>= 7
            out += head + bytes([n]) + own
        else:
            out += data[begin:at]
    return bytes(out)


def encode(pieces, texts):
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    encoder = sp.Encoder(pieces)
    ids, counts = encoder.encode(data, offs)
    again, _ = encoder.encode(data, offs)  # from memory
    assert (ids == again).all()
    back, ends = sp.decode(pieces, ids, counts)
    assert [bytes(back[a:b]) for a, b in zip(ends[:-1], ends[1:])] == raw
    cuts = np.cumsum(counts)[:-1]
    return [x.tolist() for x in np.split(ids, cuts)]


def score(pieces, ids):
    lone = set(pieces.byte_ids.tolist())
    return sum(pieces.scores[i] for i in ids if i not in lone)


def test_same_as_the_library_over_the_same_pieces(spark, tmp_path):
    with open(tmp_path / "unigram.model", "wb") as f:
        f.write(as_unigram(sp.MODEL_FILE))
    pieces = sp.Pieces.load(str(tmp_path / "unigram.model"))
    assert not pieces.merges
    library = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "unigram.model"))
    whole = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    encode(pieces, whole)
    texts = sorted({w for t in whole for w in t.split()})[::5]  # the library sums in single precision: words, not texts
    texts += ["", " ", "  two  spaces ", "a\nb\t\tc", "naïve café 日本語 \U0001f600", "x" * 500, "-" * 400 + "é" * 200]
    got = encode(pieces, texts)
    same = [g == w for g, w in zip(got, library.encode(texts))]
    for g, w, s, t in zip(got, library.encode(texts), same, texts):
        assert s or score(pieces, g) >= score(pieces, w) - 1e-3, t[:80]
    assert sum(same) >= 0.99 * len(same), [x for x in zip(texts, got, library.encode(texts), same) if not x[3]][:5]


def test_merges_are_those_of_the_library(spark):
    pieces = sp.Pieces.load()
    library = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL_FILE)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["", " ", "  two  spaces ", "a\nb\t\tc", "naïve café 日本語 \U0001f600", "x" * 500, "-" * 400 + "é" * 200, "the" * 300]
    assert pieces.merges and encode(pieces, texts) == library.encode(texts)


def test_random_texts_come_back(spark):
    rng = random.Random(2)
    pieces = sp.Pieces.load()
    alphabet = "ab the  ing\n\t.é▁ß\x00あ\U0001f680İ"
    encode(pieces, ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(500)])


def test_columns_and_odd_rows(spark, odd_documents):
    there = sp.encoded(odd_documents.withColumn("ids2", sp.F.lit(1)))
    back = sp.decoded(there)
    key = lambda r: (r.doc_id, r.text or "")
    want = sorted(((r.doc_id, r.text, r.a, r.band) for r in odd_documents.collect()), key=lambda r: (r[0], r[1] or ""))
    assert [(r.doc_id, r.text, r.a, r.band) for r in sorted(back.collect(), key=key)] == want
    assert all(r.round_trip for r in sp.encoded_and_decoded(odd_documents).collect())
    assert sp.encoded(odd_documents.limit(0)).count() == 0


def test_words_that_hash_alike(monkeypatch):
    texts = ["one two three", "", "two one ▁ caf\u00e9", "x" * 300 + " one", "three"]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    offs = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    pieces = sp.Pieces.load(sp.MODEL_FILE)
    want = sp.recoded_texts(sp.Encoder(pieces), data, offs)
    assert bytes(want[2]) == data.tobytes()
    monkeypatch.setattr(sp, "word_hashes", lambda data, starts, lengths: (lengths % 2).astype(np.uint64))
    encoder = sp.Encoder(pieces)
    for x, y in zip(sp.recoded_texts(encoder, data, offs), want, strict=True):
        assert (x == y).all()
