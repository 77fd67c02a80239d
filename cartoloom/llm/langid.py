"""Language identification: known words first, character n-grams of falling length for the rest."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, chunks, mix, powers, table

#: About so many documents of each language are learned from (those with the smallest hashes of their ids).
SAMPLE_PER_LANG = 600
#: A word is known if the sample has it so often; n-grams go from the first length to the last.
KNOWN, ORDERS = 3, (5, 4, 3, 2, 1)
#: Bytes of text whose words are scored at once; bounds a worker's memory.
TEXT_BYTES = 1 << 20
#: Pseudo-count of what a language has not shown.
SMOOTH = 0.3
_letters: np.ndarray | None = None


def is_letter() -> np.ndarray:
    """For every code point whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letters


def _spans(points: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of runs of letters, and how many each text has."""
    inside = np.concatenate([is_letter()[points], [False]])
    cut = np.zeros(len(points) + 1, bool)
    cut[offs] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:]
    last = inside[:-1] & (~inside[1:] | cut[1:])
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1 - starts, np.diff(np.searchsorted(starts, offs))


def _span_hashes(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, U64)
    before = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(before, lengths)
    terms = values[inside + np.repeat(starts, lengths)] * powers(int(lengths.max()))[inside]
    return mix(np.add.reduceat(mix(terms), before) + lengths.astype(U64))


def _points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, and offsets."""
    low = [(t or "").lower() for t in texts]
    return np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32), np.concatenate([[0], np.cumsum([len(t) for t in low])]).astype(np.int64)


def _values(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(U64) + U64(0x51ED27))


def _grams(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams within words, each word with a mark at both ends; and the word that each is of."""
    edged = lengths + 2
    before = np.cumsum(edged) - edged
    flat = np.full(int(edged.sum()), mix(np.array([7], U64))[0], U64)
    inside = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    flat[inside + np.repeat(before + 1, lengths)] = values[inside + np.repeat(starts, lengths)]
    counts = np.maximum(edged - n + 1, 0)
    word = np.repeat(np.arange(len(starts)), counts)
    at = np.arange(int(counts.sum()), dtype=np.int64) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(before, counts)
    out = np.zeros(len(at), U64)
    for j in range(n):
        out += flat[at + j] * powers(n)[j]
    return mix(out + U64(n)), word


@dataclass
class Model:
    """Languages, and for words and for each n-gram length sorted hashes with a row of log frequencies by language."""

    langs: list[str]
    words: tuple[np.ndarray, np.ndarray]
    grams: dict[int, tuple[np.ndarray, np.ndarray]]

    def word_scores(self, values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Log frequency by language of each word; unseen words have the mean of their longest known n-grams."""
        out = np.zeros((len(starts), len(self.langs)))
        hit, at = _find(self.words[0], hashes)
        out[hit] = self.words[1][at[hit]]
        left = np.flatnonzero(~hit)
        for n in ORDERS:
            if not len(left):
                break
            keys, scores = self.grams[n]
            grams, word = _grams(values, starts[left], lengths[left], n)
            known, at = _find(keys, grams)
            word, at = word[known], at[known]
            found = np.bincount(word, minlength=len(left))
            some = found > 0
            if some.any():
                for j in range(len(self.langs)):
                    out[left[some], j] = (np.bincount(word, scores[at, j], minlength=len(left)) / np.maximum(found, 1))[some]
                left = left[~some]
        return out

    def predict(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language (-1: no letter, or nothing learned) and its share of the likelihood."""
        points, offs = _points(texts)
        starts, lengths, counts = _spans(points, offs)
        pick, score = np.full(len(texts), -1), np.zeros(len(texts))
        if not len(starts) or not self.langs:
            return pick, score
        values = _values(points)
        hashes = _span_hashes(values, starts, lengths)
        _, one, every = np.unique(hashes, return_index=True, return_inverse=True)
        scores = self.word_scores(values, starts[one], lengths[one], hashes[one])
        some = counts > 0
        first = (np.cumsum(counts) - counts)[some]
        total = np.column_stack([np.add.reduceat(scores[every, j], first) for j in range(len(self.langs))])
        best = total.argmax(axis=1)
        share = np.exp(total - total.max(axis=1, keepdims=True))
        pick[some], score[some] = best, share[np.arange(len(best)), best] / share.sum(axis=1)
        return pick, score


def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(asked), bool), np.zeros(len(asked), np.int64)
    at = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    return keys[at] == asked, at


def _table(keys: np.ndarray, lang: np.ndarray, langs: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys seen ``least`` times, and log((count + SMOOTH) / total) by language."""
    own, at = np.unique(keys, return_inverse=True)
    counts = np.zeros((len(own), langs))
    np.add.at(counts, (at, lang), 1)
    totals = counts.sum(axis=0) + SMOOTH * max(1, len(own))
    keep = counts.sum(axis=1) >= least
    return own[keep], np.log((counts[keep] + SMOOTH) / totals)


def fit(labelled: list[tuple[str, str]]) -> Model:
    """Learns from (lang, text) pairs; n-grams are counted over the distinct words of each language."""
    langs = sorted({lang for lang, _ in labelled})
    points, offs = _points([text for _, text in labelled])
    starts, lengths, counts = _spans(points, offs)
    values = _values(points)
    lang = np.repeat(np.array([langs.index(x) for x, _ in labelled], np.int64), counts)
    hashes = _span_hashes(values, starts, lengths)
    words = _table(hashes, lang, len(langs), KNOWN)
    _, one = np.unique(mix(hashes + lang.astype(U64)), return_index=True)
    grams = {}
    for n in ORDERS:
        keys, word = _grams(values, starts[one], lengths[one], n)
        grams[n] = _table(keys, lang[one][word], len(langs), 2)
    return Model(langs, words, grams)


def training_sample(docs: DataFrame, per_lang: int) -> DataFrame:
    """lang, text of about ``per_lang`` documents of each language: those whose id's hash lies below a share."""
    counts = {r["lang"]: r["c"] for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("c")).collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit(8)), F.lit(1 << 30))
    within = F.lit(False)
    for lang, c in counts.items():
        within = within | ((F.col("lang") == lang) & (place <= int(min(1.0, per_lang / c) * (1 << 30))))
    return docs.where(within).select("lang", "text")


def trained(labelled: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """The model of documents (doc_id, lang, text); null languages and texts are not learned from.

    The sample holds per_lang documents a language, so that the driver can fit it and every task can hold the model;
    all texts are taken whole. Predictions cover every document.
    """
    sample = training_sample(labelled.where("lang IS NOT NULL AND text IS NOT NULL"), per_lang).toArrow()
    return fit(list(zip(sample.column("lang").to_pylist(), sample.column("text").to_pylist(), strict=True)))


def predicted(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns ``keep`` of documents, lang_pred and score, from ``text`` alone.

    lang_pred is ``und`` and score 0 where the text is null, or has no letter, or nothing was learned. Equal scores
    go to the language that sorts first. Every row stays, repeated ids too; texts are taken whole, however long.
    ``keep`` must not hold the names lang_pred, score or own_text; other columns of documents may have any name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = "text" if "text" in keep else "own_text"  # a text that is kept crosses to Python once
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = np.array([*own.langs, "und"], object)
        for batch in batches:
            for lo, hi, _, _ in chunks(batch, text, TEXT_BYTES):
                pick, score = own.predict(batch.column(text).slice(lo, hi - lo).to_pylist())
                kept = [batch.column(c).slice(lo, hi - lo) for c in keep]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(names[pick], pa.string()), pa.array(score)], names=[*keep, "lang_pred", "score"])

    return (docs.select(*keep) if text == "text" else docs.select(*keep, F.col("text").alias(text))).mapInArrow(run, schema)


def is_held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % 4 == 2


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(is_held_out(), F.lit(False)))
    model = trained(docs.where(~F.col("held_out")))
    return predicted(docs, model, "doc_id", "held_out")
