"""Language-model scores: a Katz backoff model over partitioned count tables."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FOLDED_VALUES, SPACED, U64, Staging, chunks, mix, one_per_id, release, table, word_hashes, word_spans

#: Counts up to this are discounted by Good-Turing; larger ones lose TAIL, so that every context keeps mass to back off.
LOW, TAIL = 5, 0.01
#: Bytes of text that share one block of the corpus (one row of the token table, one sender of counts), and bytes of
#: text for one part of the count tables, so that a part's size stays the same.
BLOCK_BYTES, PART_BYTES = 12 << 20, 8 << 20
#: Stands for the end of a text, and as a context for its start.
END = U64(0xE4D0F7E87A11C0DE)
#: Bits of a pair's key besides its part.
_KEY = U64((1 << 56) - 1)


def discounts(counts_of_counts: np.ndarray) -> np.ndarray:
    """Share of a count r that is kept, for r = 0 .. LOW, from how many n-grams occur 1 .. LOW + 1 times.

    Good-Turing with Katz's correction; where the counts of counts do not fall as it needs (small or odd corpora),
    every low count loses the same absolute part instead.
    """
    n = np.concatenate([[0], np.asarray(counts_of_counts, float)])
    keep = np.ones(LOW + 1)
    r = np.arange(1, LOW + 1)
    if (n[1:] > 0).all():
        tail = (LOW + 1) * n[LOW + 1] / n[1]
        turned = (r + 1) * n[r + 1] / n[r] / r
        keep[1:] = (turned - tail) / (1 - tail) if tail < 1 else 1
        if ((keep[1:] > 0) & (keep[1:] < 1)).all():
            return keep
    part = n[1] / (n[1] + 2 * n[2]) if n[1] + n[2] > 0 else 0.5
    keep[1:] = 1 - min(max(part, 0.1), 0.9) / r
    return keep


@dataclass(frozen=True)
class Levels:
    """Totals of the training text: tokens, distinct tokens, and discounts of single tokens and of pairs."""

    tokens: int
    distinct: int
    keep1: np.ndarray
    keep2: np.ndarray
    unknown: float

    @classmethod
    def of(cls, one: dict, two: dict) -> Levels:
        keep1, keep2 = discounts(one["n"][1:]), discounts(two["n"][1:])
        lost = sum((1 - keep1[r]) * r * one["n"][r] for r in range(1, LOW + 1)) + TAIL * (one["distinct"] - sum(one["n"][1 : LOW + 1]))
        return cls(one["total"], one["distinct"], keep1, keep2, lost / one["total"] if one["total"] else 1.0)

    @staticmethod
    def kept(count: np.ndarray, keep: np.ndarray) -> np.ndarray:
        """Discounted counts."""
        return np.where(count <= LOW, count * keep[np.minimum(count, LOW)], count - TAIL)

    def single(self, count: np.ndarray) -> np.ndarray:
        """Probability of a token that occurs so often in training; all unknown words together are one event."""
        return np.where(count > 0, self.kept(count, self.keep1) / max(1, self.tokens), self.unknown)


@dataclass
class Block:
    """A block's texts as places in its sorted distinct token hashes, and its distinct pairs in the order sent."""

    # places take 32 bits: a block has about BLOCK_BYTES of text, and a longer text no more than Arrow's 2 GB

    ids: np.ndarray
    held: np.ndarray
    counts: np.ndarray
    words: np.ndarray
    tokens: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Block:
        get = lambda c, t: np.frombuffer(row[c], t)
        size = int(get("counts", np.int64).sum())
        tokens = np.frombuffer(pa.decompress(row["tokens"], 4 * size, codec="zstd"), np.int32) if size else np.zeros(0, np.int32)
        return cls(get("ids", np.int64), get("held", bool), get("counts", np.int64), get("words", U64), tokens)

    def pairs(self, parts: int) -> None:
        """Sets of each token its context, of the distinct pairs their words, keys and parts, and the pair of each token."""
        n, end = len(self.words), int(np.searchsorted(self.words, END))
        context = np.empty_like(self.tokens)
        context[1:] = self.tokens[:-1]
        context[np.cumsum(self.counts) - self.counts] = end
        own, at = np.unique(context.astype(np.int64) * n + self.tokens, return_inverse=True)
        at = at.astype(np.int32)
        first, second = (own // n).astype(np.int32), (own % n).astype(np.int32)
        key = mix(self.words[first] * U64(0x9E3779B97F4A7C15) + mix(self.words[second] + U64(1)))
        part = (mix(key + U64(2)) % U64(parts)).astype(np.int32)
        key &= _KEY
        order = np.lexsort((key, part)).astype(np.int32)
        rank = np.empty(len(order), np.int32)
        rank[order] = np.arange(len(order), dtype=np.int32)
        self.first, self.second, self.key, self.part, self.pair = first[order], second[order], key[order], part[order], rank[at]

    @property
    def trained(self) -> np.ndarray:
        return np.repeat(~self.held, self.counts)


def token_blocks(docs: DataFrame) -> DataFrame:
    """One row for about BLOCK_BYTES of documents (doc_id, text, held): src (its first doc_id) and packed tokens."""
    columns = {"src": pa.int64(), "ids": pa.binary(), "held": pa.binary(), "counts": pa.binary(), "words": pa.binary(), "tokens": pa.binary()}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held = batch.column("doc_id").to_numpy(), batch.column("held").to_numpy(zero_copy_only=False)
            for lo, hi, data, offs in chunks(batch, "text", BLOCK_BYTES):
                starts, lengths, per_text = word_spans(data, offs, SPACED)
                counts = per_text + 1
                tokens = np.full(int(counts.sum()), END, U64)
                inside = np.ones(len(tokens), bool)
                inside[np.cumsum(counts) - 1] = False
                tokens[inside] = word_hashes(data, starts, lengths, FOLDED_VALUES)
                words, at = np.unique(tokens, return_inverse=True)
                row = (int(ids[lo]), ids[lo:hi].tobytes(), held[lo:hi].astype(bool).tobytes(), counts.astype(np.int64).tobytes(), words.tobytes(), pa.compress(at.astype(np.int32).tobytes(), codec="zstd", asbytes=True))
                del starts, lengths, tokens, inside, at
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, columns.values(), strict=True)], names=list(columns))
            release()

    return docs.select("doc_id", "text", "held").mapInArrow(pack, "src long, ids binary, held binary, counts binary, words binary, tokens binary")


def _cut(part: np.ndarray) -> Iterator[tuple[int, slice]]:
    """(part, slice) of runs of equal parts."""
    if len(part):
        edges = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield int(part[a]), slice(a, b)


def _pack(values: np.ndarray) -> bytes:
    return values.dtype.char.encode() + len(values).to_bytes(8, "little") + pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _unpack(blob: bytes) -> np.ndarray:
    kind, n = np.dtype(blob[:1].decode()), int.from_bytes(blob[1:9], "little")
    return np.frombuffer(pa.decompress(blob[9:], n * kind.itemsize, codec="zstd"), kind) if n else np.zeros(0, kind)


def _narrow(values: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 in the least bytes."""
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32 if top < 1 << 32 else np.uint64)


def counted(blocks: DataFrame, parts: int) -> DataFrame:
    """Replies to blocks (src, part, totals) with the training counts of what each sent; and rows of totals (src null).

    Blocks send every distinct token (parts 0 ..) and pair (parts ``parts`` ..) with its count in training texts to
    the part of its key: a key, however frequent, is one entry for a block. totals hold 2 * count, plus 1 for the one
    block that a pair is assigned to, in the order sent. A pair's key has 56 bits besides its part.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.read(row)
                block.pairs(parts)
                weights = block.trained
                ones = np.bincount(block.tokens[weights], minlength=len(block.words))
                twos = np.bincount(block.pair[weights], minlength=len(block.key))
                part = (block.words >> U64(33)).astype(np.int64) * parts >> 31  # in order of the hash
                rows = [(p, _pack(block.words[s]), None, _pack(_narrow(ones[s]))) for p, s in _cut(part)]
                for p, s in _cut(block.part):
                    high = (block.key[s] >> U64(32)).astype(np.int64)
                    rows.append((parts + p, block.key[s].astype(np.uint32).tobytes(), _pack(_narrow(np.diff(high, prepend=0))), _pack(_narrow(twos[s]))))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([row["src"]] * len(rows), pa.int64()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3))], names=["part", "src", "low", "high", "own"])

    kind = pa.schema([("src", pa.int64()), ("part", pa.int32()), ("totals", pa.binary()), *((f"n{r}", pa.int64()) for r in range(1, LOW + 2)), ("tokens", pa.int64()), ("items", pa.int64())])

    def add(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        part = rows[0]["part"]
        keys = [_unpack(r["low"]) if part < parts else np.frombuffer(r["low"], np.uint32).astype(U64) | np.cumsum(_unpack(r["high"]).astype(np.int64)).astype(U64) << U64(32) for r in rows]
        own = np.concatenate([_unpack(r["own"]) for r in rows]).astype(np.int64)
        _, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        total = np.bincount(at, own, minlength=len(first)).astype(np.int64)
        reply = 2 * total[at]
        reply[first] += 1
        ends = np.cumsum([len(k) for k in keys])
        found = total[total > 0]
        low = np.bincount(np.minimum(found, LOW + 2), minlength=LOW + 3)[1 : LOW + 2]
        out = [(r["src"], part, _pack(_narrow(reply[e - len(k) : e])), *[None] * (LOW + 3)) for r, k, e in zip(rows, keys, ends.tolist(), strict=True)]
        out.append((None, part, None, *map(int, low), int(found.sum()), len(found)))
        del keys, own, first, at, total
        release()
        return pa.table([pa.array([o[i] for o in out], f.type) for i, f in enumerate(kind)], schema=kind)

    sent = blocks.mapInArrow(send, "part int, src long, low binary, high binary, own binary")
    names = ", ".join(f"n{r} long" for r in range(1, LOW + 2))
    return sent.groupBy("part").applyInArrow(add, f"src long, part int, totals binary, {names}, tokens long, items long")


def _replies(table: pa.Table, low: int, high: int) -> np.ndarray:
    """What parts low .. high - 1 have replied to a block, in the order sent."""
    rows = sorted(((r["part"], r["totals"]) for r in table.select(["part", "totals"]).to_pylist() if low <= r["part"] < high), key=lambda r: r[0])
    return np.concatenate([_unpack(t) for _, t in rows]) if rows else np.zeros(0, np.int64)


def _known(block: Block, replies: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Training counts of the block's tokens and pairs, and which pairs are assigned to it."""
    ones = _replies(replies, 0, parts).astype(np.int64) >> 1
    reply = _replies(replies, parts, 2 * parts).astype(np.int64)
    return ones, reply >> 1, (reply & 1 == 1) & (reply > 1)


def scored(docs: DataFrame, staging: Staging) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of documents (doc_id, text, held).

    Tokens are words (A-Z folded, between white space) and an end. The model of pairs learns from documents that are
    not held: P(w | h) = kept(c(h, w)) / c(h) for pairs seen; else a(h) P(w), and P(w) where h is unknown; unknown
    words together have the mass that discounting single tokens leaves. a(h) makes the probabilities of each context
    add up to 1: (mass that discounting h's pairs leaves) / (1 - sum of P(w) over h's pairs). A text's first context
    is the end. base_score is the add-one score of single tokens.

    Counts stay in parts by key, in the shared folder; blocks of documents ask for the keys they hold. No table of
    the vocabulary goes to the driver or to all tasks: only the totals, LOW + 3 numbers a level, do. Null or empty
    texts are one end, texts of any length are taken whole; with nothing to learn from, scores are 0. Repeated doc_ids
    must have been dropped; other columns are ignored, whatever their names. Tokens are known by 64-bit hashes and pairs
    by 56 bits of one within their part of PART_BYTES of text: two pairs of a part of a million are expected to be
    counted as one in fewer than one part of 100,000.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(16, -(-size // PART_BYTES))
    blocks = staging.save(token_blocks(docs), "blocks")
    replies = staging.save(counted(blocks, parts), "replies")
    level = (F.col("part") >= parts).cast("int")
    sums = replies.where("src IS NULL").groupBy(level.alias("level")).agg(*(F.sum(c).alias(c) for c in (*(f"n{r}" for r in range(1, LOW + 2)), "tokens", "items"))).collect()
    found = {r["level"]: {"n": [0, *(r[f"n{i}"] for i in range(1, LOW + 2))], "total": r["tokens"], "distinct": r["items"]} for r in sums}
    nothing = {"n": [0] * (LOW + 2), "total": 0, "distinct": 0}
    levels = Levels.of(found.get(0, nothing), found.get(1, nothing))
    replies = replies.where("src IS NOT NULL").select("src", "part", "totals")
    asked = pa.schema([("part", pa.int32()), ("src", pa.int64()), ("keys", pa.binary()), ("lost", pa.binary()), ("seen", pa.binary()), ("want", pa.binary())])

    def weigh(key, table: pa.Table, said: pa.Table) -> pa.Table:
        rows = []
        for row in table.to_pylist():
            block = Block.read(row)
            block.pairs(parts)
            ones, twos, own = _known(block, said, parts)
            left, right, count = block.first[own], block.second[own], twos[own]
            n = len(block.words)
            lost = np.bincount(left, count - levels.kept(count, levels.keep2), minlength=n)
            seen = np.bincount(left, levels.single(ones[right]), minlength=n)
            want = np.zeros(n, bool)
            want[block.first[twos == 0]] = True
            want &= ones > 0
            some = np.flatnonzero((lost > 0) | want)
            part = (block.words[some] >> U64(33)).astype(np.int64) * parts >> 31
            for p, s in _cut(part):
                at = some[s]
                rows.append((p, row["src"], block.words[at].tobytes(), lost[at].tobytes(), seen[at].tobytes(), _pack(want[at].astype(np.uint8))))
        release()
        return pa.table([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(asked)], schema=asked)

    answered = pa.schema([("src", pa.int64()), ("part", pa.int32()), ("totals", pa.binary())])

    def settle(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        keys = [np.frombuffer(r["keys"], U64) for r in rows]
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        lost, seen = (np.bincount(at, np.concatenate([np.frombuffer(r[c], float) for r in rows])) for c in ("lost", "seen"))
        out, lo = [], 0
        for r, k in zip(rows, keys, strict=True):
            want = _unpack(r["want"]).astype(bool)
            which = at[lo : lo + len(k)][want]
            lo += len(k)
            if len(which):
                out.append((r["src"], 2 * parts + r["part"], _pack(np.column_stack([lost[which], seen[which]]).ravel())))
        return pa.table([pa.array([o[i] for o in out], f.type) for i, f in enumerate(answered)], schema=answered)

    final = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), *((c, pa.int64()) for c in ("n_tokens", "n_known", "train_tokens")), ("base_score", pa.float64()), ("score", pa.float64())])

    def score(key, table: pa.Table, said: pa.Table) -> pa.Table:
        out = []
        for row in table.to_pylist():
            block = Block.read(row)
            block.pairs(parts)
            ones, twos, _ = _known(block, said, parts)
            want = np.zeros(len(block.words), bool)
            want[block.first[twos == 0]] = True
            want &= ones > 0
            weight = np.zeros(len(block.words))  # log10 of a(h); 0 where the context is unknown
            lost, seen = _replies(said, 2 * parts, 3 * parts).astype(float).reshape(-1, 2).T
            weight[want] = np.log10(lost / ones[want]) - np.log10(1 - seen)
            single = levels.single(ones)
            of_pair = weight[block.first] + np.log10(single)[block.second]
            known = twos > 0
            of_pair[known] = np.log10(levels.kept(twos[known], levels.keep2) / ones[block.first[known]])
            base = np.log10((ones + 1) / (levels.tokens + levels.distinct + 1))
            begin = np.cumsum(block.counts) - block.counts
            add = lambda x: np.add.reduceat(x, begin)
            out.append(pa.table([pa.array(block.ids), pa.array(block.held), pa.array(block.counts), pa.array(add((ones > 0).astype(np.int64)[block.tokens])), pa.array(np.full(len(block.ids), levels.tokens)), pa.array(add(base[block.tokens])), pa.array(add(of_pair[block.pair]))], schema=final))
        release()
        return pa.concat_tables(out) if out else final.empty_table()

    by_block = blocks.groupBy("src")
    sums = by_block.cogroup(replies.groupBy("src")).applyInArrow(weigh, "part int, src long, keys binary, lost binary, seen binary, want binary")
    answers = sums.groupBy("part").applyInArrow(settle, "src long, part int, totals binary")
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return by_block.cogroup(replies.unionByName(answers).groupBy("src")).applyInArrow(score, schema)


def op4_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probabilities of every document under a model of six sevenths of them."""
    docs = one_per_id(table(spark, sf_dir, "documents"), "doc_id", "text")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    return scored(docs.withColumn("held", held), Staging(spark, "op4"))
