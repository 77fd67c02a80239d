"""SentencePiece encoding and decoding by the pieces of a model file, in batches of words of equal length.

Unigram files are searched by Viterbi. The scores of a merge (BPE) file are ranks of merges, whose best sum is not
the segmentation that the vocabulary was made with, so for those words of equal length are merged together instead,
with the same look-up of substring hashes and the same vectorised maxima; ids are then those of the library.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.wire import Message
from .common import BYTE_VALUES, U64, chunks, mix, powers, table, word_hashes

#: The vocabulary file; a parameter of every function that needs one.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: What the score of a character outside the vocabulary lies below the lowest score.
UNKNOWN_PENALTY = 10.0
#: Distinct words whose pieces a worker remembers; beyond it the memory starts anew.
REMEMBERED = 1 << 20
#: Words of more bytes are split one by one, with matches of all places found at once.
LONG = 192
_MARK = "▁"


def _polynomials(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Polynomial hashes of spans, which differences of prefix sums give too."""
    first = np.cumsum(lengths) - lengths
    inside = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    terms = BYTE_VALUES[data[inside + np.repeat(starts, lengths)]] * powers(int(lengths.max()))[inside]
    return mix(np.add.reduceat(terms, first) + lengths.astype(U64))


@dataclass
class Pieces:
    """A vocabulary: pieces as bytes (space for the word mark), scores, and the ids of the 256 byte pieces."""

    texts: list[bytes]
    usable: np.ndarray
    scores: np.ndarray
    byte_ids: np.ndarray
    prefix: bool
    merges: bool = False
    keys: np.ndarray = field(init=False)
    ids: np.ndarray = field(init=False)

    def __post_init__(self):
        lengths = np.array([len(t) for t in self.texts], np.int64)
        flat = np.frombuffer(b"".join(self.texts), np.uint8)
        own = np.flatnonzero(self.usable & (lengths > 0))
        starts = (np.cumsum(lengths) - lengths)[own]
        keys = _polynomials(flat, starts, lengths[own])
        order = np.argsort(keys, kind="stable")
        self.keys, self.ids = keys[order], own[order]
        assert len(np.unique(self.keys)) == len(self.keys), "pieces repeat"
        self.lengths, self.flat, self.starts = lengths, flat, np.cumsum(lengths) - lengths
        self.longest = int(lengths[own].max())
        self.unknown = float(self.scores[own].min()) - UNKNOWN_PENALTY
        #: Bytes that are parts of pieces of more than one byte; other bytes below 128 stand alone.
        joined = np.zeros(256, bool)
        for i in own[lengths[own] > 1]:
            joined[np.frombuffer(self.texts[i], np.uint8)] = True
        self.alone = ~joined
        self.alone[128:] = False
        #: No piece has a space after another character, so texts can be cut before the first of such spaces.
        self.cuts = not any(b" " in self.texts[i].lstrip(b" ") for i in own)

    @classmethod
    def load(cls, path: str = MODEL_FILE) -> Pieces:
        with open(path, "rb") as f:
            return cls.parse(f.read())

    @classmethod
    def parse(cls, data: bytes) -> Pieces:
        """From the bytes of a vocabulary file. Fields 1, 2 and 3 of a file are its pieces, the trainer's
        settings and the normaliser's; 1, 2 and 3 of a piece its text, score and kind."""
        whole = Message(data)
        own = [Message(piece) for piece in whole.all(1)]
        texts = [bytes(p.last(1, b"")).decode() for p in own]
        scores = [float(np.frombuffer(p.last(2), np.float32)[0]) if p.all(2) else 0.0 for p in own]
        kinds = [p.last(3, 1) for p in own]
        merges = any(Message(x).last(3, 1) == 2 for x in whole.all(2))
        prefix = all(Message(x).last(3, 1) for x in whole.all(3))
        kinds = np.array(kinds)
        byte_ids = np.full(256, -1, np.int32)
        for i in np.flatnonzero(kinds == 6):
            byte_ids[int(texts[i][3:5], 16)] = i
        if (byte_ids < 0).any():
            raise ValueError("the vocabulary has no piece for each byte, so texts would not come back whole")
        raw = [bytes([int(t[3:5], 16)]) if k == 6 else t.replace(_MARK, " ").encode() if k in (1, 4) else b"" for t, k in zip(texts, kinds.tolist(), strict=True)]
        return cls(raw, np.isin(kinds, (1, 4)), np.array(scores), byte_ids, prefix, merges)

    def find(self, asked: np.ndarray) -> np.ndarray:
        """Id of the piece with each hash, or -1."""
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.ids[at], -1)

    def _hash(self, sums: np.ndarray, start: int, end: int) -> np.ndarray:
        """Hashes of bytes start..end of each row, from prefix sums of byte values times powers."""
        inverse = U64(pow(int(powers(2)[1]), -start, 1 << 64))
        return mix((sums[:, end] - sums[:, start]) * inverse + U64(end - start))

    def split_words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best pieces of words of equal length (rows of bytes): ids, flat, and how many each word has.

        Words advance together, place by place. At each place the substrings that end there are looked up by hash,
        longest first, and a strictly better sum of scores replaces the backpointer, so ties go to the longer last
        piece. A byte of a character that no piece covers costs its part of the penalty.
        """
        n, size = words.shape
        sums = np.zeros((n, size + 1), U64)
        np.cumsum(BYTE_VALUES[words] * powers(size), axis=1, out=sums[:, 1:])
        width = np.where(words < 0x80, 1, np.where(words < 0xE0, 2, np.where(words < 0xF0, 3, 4)))
        inside = (words & 0xC0) == 0x80  # continuation bytes take the width of their first byte
        for j in range(1, size):
            width[:, j] = np.where(inside[:, j], width[:, j - 1], width[:, j])
        best = np.zeros((n, size + 1))
        back, came = np.zeros((n, size + 1), np.int32), np.zeros((n, size + 1), np.int32)
        for end in range(1, size + 1):
            top = np.full(n, -np.inf)
            for start in range(max(0, end - self.longest), end):
                piece = self.find(self._hash(sums, start, end))
                score = np.where(piece >= 0, best[:, start] + self.scores[piece], -np.inf)
                better = score > top
                top[better] = score[better]
                back[better, end], came[better, end] = start, piece[better]
            score = best[:, end - 1] + self.unknown / width[:, end - 1]
            better = score > top
            top[better] = score[better]
            back[better, end], came[better, end] = end - 1, self.byte_ids[words[better, end - 1]]
            best[:, end] = top
        out = np.full((n, size), -1, np.int32)
        at, row = np.full(n, size), np.arange(n)
        for place in range(size - 1, -1, -1):  # back to front, one piece of all words at a time
            going = at > 0
            if not going.any():
                break
            out[going, place] = came[row[going], at[going]]
            at = np.where(going, back[row, at], 0)
        kept = out >= 0
        return out[kept], kept.sum(axis=1)

    def split_long(self, word: np.ndarray) -> np.ndarray:
        """As split_words, for one long word: all matches of a length are found at once, then one pass joins them."""
        size = len(word)
        sums = np.concatenate([np.zeros(1, U64), np.cumsum(BYTE_VALUES[word] * powers(size))])
        inverse = np.ones(size + 1, U64)
        inverse[1:] = U64(pow(int(powers(2)[1]), -1, 1 << 64))
        inverse = np.multiply.accumulate(inverse)
        ends: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]
        for length in range(min(self.longest, size), 0, -1):
            piece = self.find(mix((sums[length:] - sums[:-length]) * inverse[: size - length + 1] + U64(length)))
            for start in np.flatnonzero(piece >= 0).tolist():
                ends[start + length].append((start, int(piece[start])))
        best, back, came = [0.0] * (size + 1), [0] * (size + 1), [0] * (size + 1)
        width = 1
        for end in range(1, size + 1):
            byte = int(word[end - 1])
            width = width if byte & 0xC0 == 0x80 else 1 if byte < 0x80 else 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
            top = -np.inf
            for start, piece in ends[end]:
                score = best[start] + self.scores[piece]
                if score > top:
                    top, back[end], came[end] = score, start, piece
            score = best[end - 1] + self.unknown / width
            if score > top:
                top, back[end], came[end] = score, end - 1, int(self.byte_ids[byte])
            best[end] = top
        out, at = [], size
        while at:
            out.append(came[at])
            at = back[at]
        return np.array(out[::-1], np.int32)

    def merge_words(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of words of equal length (rows of bytes) by merging, ids flat, and how many each word has.

        Symbols are characters at first. In each round all words look up their adjacent pairs, and each merges its
        pair of the highest score, the leftmost of equals, until no word has any. Characters that are no pieces
        become bytes.
        """
        n, size = words.shape
        sums = np.zeros((n, size + 1), U64)
        np.cumsum(BYTE_VALUES[words] * powers(size), axis=1, out=sums[:, 1:])
        inverse = np.multiply.accumulate(np.concatenate([np.ones(1, U64), np.full(size, pow(int(powers(2)[1]), -1, 1 << 64), U64)]))
        head = (words & 0xC0) != 0x80
        head[:, 0] = True
        count = head.sum(axis=1)
        begin = np.full((n, size + 2), size)
        row, col = np.nonzero(head)
        begin[row, (np.cumsum(head, axis=1) - 1)[row, col]] = col

        def look(of: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
            rows = of[:, None]
            return self.find(mix((sums[rows, b] - sums[rows, a]) * inverse[a] + (b - a).astype(U64)).ravel()).reshape(a.shape)

        live = np.flatnonzero(count > 1)
        while len(live):
            wide = int(count[live].max())
            own = begin[live, : wide + 1]
            piece = look(live, own[:, : wide - 1], own[:, 2 : wide + 1])
            score = np.where((piece >= 0) & (np.arange(wide - 1) < count[live, None] - 1), self.scores[piece], -np.inf)
            at = score.argmax(axis=1)
            good = score[np.arange(len(live)), at] > -np.inf
            live, at = live[good], at[good]
            place = np.arange(size + 1)
            begin[live, : size + 1] = np.take_along_axis(begin[live], place + (place > at[:, None]), axis=1)
            count[live] -= 1
            live = live[count[live] > 1]
        every = np.arange(n)
        piece = look(every, begin[:, :size], begin[:, 1 : size + 1])
        out = np.full((n, size), -1, np.int32)
        row, i = np.nonzero(np.arange(size) < count[:, None])
        a, b, found = begin[row, i], begin[row, i + 1], piece[row, i]
        known = found >= 0
        out[row[known], a[known]] = found[known]
        for r, x, y in zip(row[~known].tolist(), a[~known].tolist(), b[~known].tolist(), strict=True):
            out[r, x:y] = self.byte_ids[words[r, x:y]]
        kept = out >= 0
        return out[kept], kept.sum(axis=1)

    def merge_long(self, word: np.ndarray) -> np.ndarray:
        """As merge_words, for one long word, with a queue of pairs."""
        data = word.tobytes()
        ids = {self.texts[i]: int(i) for i in self.ids}
        start = [i for i, b in enumerate(data) if b & 0xC0 != 0x80 or not i]
        end = dict(zip(start, [*start[1:], len(data)], strict=True))
        back = dict(zip(start[1:], start[:-1], strict=True))
        queue: list[tuple[float, int, int, int]] = []

        def offer(a: int) -> None:
            b = end.get(a)
            if b is not None and b in end:
                piece = ids.get(data[a : end[b]])
                if piece is not None:
                    heapq.heappush(queue, (-self.scores[piece], a, b, end[b]))

        for a in start:
            offer(a)
        while queue:
            _, a, b, c = heapq.heappop(queue)
            if end.get(a) != b or end.get(b) != c:
                continue  # one of the two has been merged since
            end[a] = c
            del end[b]
            back.pop(b)
            if c in end:
                back[c] = a
                offer(a)
            if a in back:
                offer(back[a])
        out: list[int] = []
        for a in sorted(end):
            piece = ids.get(data[a : end[a]])
            out += [piece] if piece is not None else self.byte_ids[word[a : end[a]]].tolist()
        return np.array(out, np.int32)

    def words_of(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and lengths of the parts that no piece crosses: cut at texts, before spaces, around lone bytes."""
        first = np.zeros(len(data), bool)
        first[offs[:-1][offs[:-1] < len(data)]] = True
        if self.cuts:
            space = data == 0x20
            first[1:] |= space[1:] & ~space[:-1]
        alone = self.alone[data]
        first |= alone
        first[1:] |= alone[:-1]
        starts = np.flatnonzero(first)
        return starts, np.diff(np.append(starts, len(data)))


class Encoder:
    """Encodes Arrow texts; remembers the pieces of distinct words between batches."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self._forget()

    def _forget(self) -> None:
        self.known, self.place = np.zeros(0, U64), np.zeros(0, np.int64)
        self.first, self.count, self.flat, self.total = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], 0

    def _learn(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, hashes: np.ndarray) -> None:
        """Splits words that are not known yet, those of equal length together."""
        counts = np.zeros(len(starts), np.int64)
        order = np.argsort(lengths, kind="stable")
        flat: list[np.ndarray] = []
        placed: list[np.ndarray] = []
        for group in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
            size = int(lengths[group[0]]) if len(group) else 0
            if size > LONG:
                for w in group:
                    flat.append((self.pieces.merge_long if self.pieces.merges else self.pieces.split_long)(data[starts[w] : starts[w] + size]))
                    counts[w] = len(flat[-1])
                    placed.append(np.array([w]))
            else:
                step = max(1, (1 << 18) // max(size, 1))
                for lo in range(0, len(group), step):
                    own = group[lo : lo + step]
                    got, counts[own] = (self.pieces.merge_words if self.pieces.merges else self.pieces.split_words)(data[starts[own][:, None] + np.arange(size)])
                    flat.append(got)
                    placed.append(own)
        rank = np.concatenate(placed) if placed else np.zeros(0, np.int64)
        begin = np.zeros(len(starts), np.int64)
        begin[rank] = np.cumsum(counts[rank]) - counts[rank] + self.total
        self.flat = [np.concatenate([*self.flat, *flat])]
        self.total = len(self.flat[0])
        base = sum(map(len, self.first))
        self.first, self.count = [np.concatenate([*self.first, begin])], [np.concatenate([*self.count, counts])]
        keys, place = np.concatenate([self.known, hashes]), np.concatenate([self.place, base + np.arange(len(starts))])
        order = np.argsort(keys, kind="stable")
        self.known, self.place = keys[order], place[order]

    def encode_plainly(self, text: np.ndarray) -> np.ndarray:
        """Ids of one text, each word by itself."""
        if self.pieces.prefix and len(text):
            text = np.concatenate([[0x20], text]).astype(np.uint8)
        pieces, out = self.pieces, [np.zeros(0, np.int32)]
        for a, n in zip(*(x.tolist() for x in pieces.words_of(text, np.array([0, len(text)]))), strict=True) if len(text) else ():
            word = text[a : a + n]
            if n > LONG:
                out.append((pieces.merge_long if pieces.merges else pieces.split_long)(word))
            else:
                out.append((pieces.merge_words if pieces.merges else pieces.split_words)(word[None, :])[0])
        return np.concatenate(out).astype(np.int32)

    def encode(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and how many each text has."""
        texts = np.diff(offs)
        if self.pieces.prefix:  # a space before each text that is not empty
            some = texts > 0
            grown = np.concatenate([[0], np.cumsum(texts + some)])
            wide = np.full(int(grown[-1]), 0x20, np.uint8)
            at = np.arange(len(data), dtype=np.int64) + np.repeat(grown[:-1] + some - offs[:-1], texts)
            wide[at] = data
            data, offs = wide, grown
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        starts, lengths = self.pieces.words_of(data, offs)
        hashes = word_hashes(data, starts, lengths)
        own, one, every = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self._forget()
        new = np.ones(len(own), bool)
        if len(self.known):
            at = np.minimum(np.searchsorted(self.known, own), len(self.known) - 1)
            new = self.known[at] != own
        if new.any():
            self._learn(data, starts[one[new]], lengths[one[new]], own[new])
        place = self.place[np.searchsorted(self.known, own)][every]
        first, count = self.first[0][place], self.count[0][place]
        inside = np.arange(int(count.sum()), dtype=np.int64) - np.repeat(np.cumsum(count) - count, count)
        ids = self.flat[0][inside + np.repeat(first, count)]
        ends = np.concatenate([[0], np.cumsum(count)])
        return ids, np.diff(ends[np.searchsorted(starts, offs)])


def recoded_texts(state: Encoder, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all texts and how many each has, and the bytes and offsets of what decoding gives.

    Words are remembered by hashes. Should two differ and hash alike, a text decodes to another one: such texts are
    encoded again word by word, without hashes.
    """
    ids, counts = state.encode(data, offs)
    back, ends = decode(state.pieces, ids, counts)
    if len(back) == len(data) and (back == data).all() and (ends == offs).all():
        return ids, counts, back, ends
    cuts = np.concatenate([[0], np.cumsum(counts)])
    each = []
    for a, b, c, d, i, j in zip(ends[:-1], ends[1:], offs[:-1], offs[1:], cuts[:-1], cuts[1:], strict=True):
        own = data[c:d]
        each.append(ids[i:j] if b - a == d - c and (back[a:b] == own).all() else state.encode_plainly(own))
    ids, counts = np.concatenate(each).astype(np.int32), np.array([len(x) for x in each], np.int64)
    return ids, counts, *decode(state.pieces, ids, counts)


def decode(pieces: Pieces, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the texts whose ids these are, flat, and their offsets; the space put before a text is taken off."""
    sizes = pieces.lengths[ids]
    inside = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    data = pieces.flat[inside + np.repeat(pieces.starts[ids], sizes)]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    offs = ends[np.concatenate([[0], np.cumsum(counts)])]
    if pieces.prefix:
        some = np.flatnonzero(np.diff(offs) > 0)
        some = some[data[offs[some]] == 0x20]
        keep = np.ones(len(data), bool)
        keep[offs[some]] = False
        gone = np.zeros(len(counts), np.int64)
        gone[some] = 1
        data, offs = data[keep], offs - np.concatenate([[0], np.cumsum(gone)])
    return data, offs


def _list(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values, pa.int32()))


def encoded(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """documents with ``ids`` array<int> in place of the column ``text``; a null text has null ids, an empty one none.

    A unigram file's segmentation has the highest sum of piece scores, a merge file's comes from its merges;
    characters outside the vocabulary go to byte pieces.
    Texts are not normalised, and the word mark itself, where a text holds it, is encoded by its bytes, so decoding
    returns every text as it was. Other columns and repeated rows pass unchanged.
    """
    return _with_column(docs, "text", "ids", T.ArrayType(T.IntegerType()), lambda data: Encoder(_parsed(data)), _encode_batch, model_file)


def decoded(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """documents with ``text`` in place of the column ``ids``; the inverse of ``encoded``."""
    return _with_column(docs, "ids", "text", T.StringType(), _parsed, _decode_batch, model_file)


def _shipped(docs: DataFrame, model_file: str):
    """The vocabulary file's bytes (some hundred kB), read where the driver is and sent to every worker."""
    with open(model_file, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


@functools.lru_cache(maxsize=2)
def _parsed(data: bytes) -> Pieces:
    return Pieces.parse(data)


def _with_column(docs: DataFrame, old: str, new: str, kind: T.DataType, make, apply, model_file: str) -> DataFrame:
    shipped = _shipped(docs, model_file)
    rest = [c for c in docs.columns if c not in (old, new)]
    schema = docs.select(*rest).schema.add(new, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = make(shipped.value)
        for batch in batches:
            for lo, hi, made in apply(state, batch, old):
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in rest), made], names=[*rest, new])

    return docs.select(*rest, old).mapInArrow(run, schema)


def _encode_batch(state: Encoder, batch: pa.RecordBatch, name: str):
    for lo, hi, data, offs in chunks(batch, name):
        made = _list(*recoded_texts(state, data, offs)[:2])
        null = batch.column(name).slice(lo, hi - lo).is_null()
        yield lo, hi, pc.if_else(null, pa.scalar(None, made.type), made) if null.true_count else made


def _decode_batch(pieces: Pieces, batch: pa.RecordBatch, name: str):
    column = batch.column(name)
    for lo in range(0, len(column), 2048):
        part = column.slice(lo, 2048)
        counts = pc.fill_null(pc.list_value_length(part), 0).to_numpy().astype(np.int64)
        data, offs = decode(pieces, part.flatten().to_numpy(), counts)
        made = pa.Array.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(offs.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.string())
        yield lo, lo + len(part), pc.if_else(part.is_null(), pa.scalar(None, pa.string()), made) if part.null_count else made


def recoded(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """documents with ``ids`` added, and ``text`` as decoding the ids gives it; both in one pass over the rows.

    A null text has null ids and stays null. Other columns and repeated rows pass unchanged.
    """
    rest = [c for c in docs.columns if c not in ("text", "ids")]
    schema = docs.select(*rest).schema.add("text", "string").add("ids", T.ArrayType(T.IntegerType()))

    shipped = _shipped(docs, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Encoder(_parsed(shipped.value))
        for batch in batches:
            for lo, hi, data, offs in chunks(batch, "text", 1 << 20):
                ids, counts, back, ends = recoded_texts(state, data, offs)
                text = pa.Array.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(back))]).cast(pa.string())
                made, null = _list(ids, counts), batch.column("text").slice(lo, hi - lo).is_null()
                if null.true_count:
                    text, made = pc.if_else(null, pa.scalar(None, pa.string()), text), pc.if_else(null, pa.scalar(None, made.type), made)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in rest), text, made], names=[*rest, "text", "ids"])

    return docs.select(*rest, "text").mapInArrow(run, schema)


def encoded_and_decoded(docs: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """doc_id, n_bytes, n_tokens, ids, round_trip: encoding, decoding and whether the text came back, in one pass.

    Null and empty texts have no ids and come back; texts of any length are taken whole. Every row is one, repeated
    doc_ids too; a table without rows gives none. Other columns are ignored, whatever their names.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, ids array<int>, round_trip boolean"
    shipped = _shipped(docs, model_file)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Encoder(_parsed(shipped.value))
        for batch in batches:
            for lo, hi, data, offs in chunks(batch, "text"):
                ids, counts, back, ends = recoded_texts(state, data, offs)
                same = np.diff(ends) == np.diff(offs)
                if len(back) != len(data) or not (back == data).all():
                    same = np.array([bytes(back[a:b]) == bytes(data[c:d]) for a, b, c, d in zip(ends[:-1], ends[1:], offs[:-1], offs[1:], strict=True)])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(offs)), pa.array(counts), _list(ids, counts), pa.array(same)], names=["doc_id", "n_bytes", "n_tokens", "ids", "round_trip"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding them returns it."""
    return encoded_and_decoded(table(spark, sf_dir, "documents"))
