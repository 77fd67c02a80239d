"""Exact removal of repeated 100-byte strings: hash-compared suffix sorting around shared anchors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, BYTE_VALUES, U64, chunks, mix, one_per_id, powers, release, string_parts, table

#: Bytes of a window (a string that may repeat), of an anchor in it, and the places an anchor can have.
WINDOW, GRAM = 100, 32
PLACES = WINDOW - GRAM + 1
#: Bytes of text whose anchors are found at once, and bytes of text for one part: they bound a worker's memory.
TEXT_BYTES, PART_BYTES = 1 << 18, 2 << 20
#: Anchors that a task gathers before it sends them, packed by part.
PACKED = 200_000
_inverse = np.ones(1, U64)


def inverses(n: int) -> np.ndarray:
    """BASE**-0 .. BASE**-(n - 1) modulo 2**64."""
    global _inverse
    while len(_inverse) < n:
        step = U64(pow(pow(BASE, -1, 1 << 64), len(_inverse), 1 << 64))
        _inverse = np.concatenate([_inverse, _inverse * step])
    return _inverse[:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(BYTE_VALUES[data] * powers(len(data)), out=out[1:])
    return out


def _rolling_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


def anchors(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, first, last, hash) of anchors: each window of a text is in first..last of exactly one of them.

    A window's anchor is the leftmost of its 32-byte grams with the smallest hash. It depends on the window's bytes
    alone, so equal windows have equal anchors at equal places in them.
    """
    none = np.zeros(0, np.int64)
    if len(data) < WINDOW:
        return none, none, none, none.astype(U64)
    sums = prefix_sums(data)
    grams = mix((sums[GRAM:] - sums[:-GRAM]) * inverses(len(data) - GRAM + 1))
    least = _rolling_min(grams, PLACES)
    text = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(least)]
    own = np.flatnonzero(np.arange(len(least)) + WINDOW <= offs[1:][text])
    if not len(own):
        return none, none, none, none.astype(U64)
    new = np.ones(len(own), bool)
    new[1:] = (np.diff(own) != 1) | (least[own[1:]] != least[own[:-1]]) | (text[own[1:]] != text[own[:-1]])
    at = np.flatnonzero(new)
    first, last = own[at], own[np.append(at[1:], len(own)) - 1]
    out: list[tuple[np.ndarray, ...]] = []
    while len(first):  # again only where an equal gram follows in the same run
        place = np.empty(len(first), np.int64)
        for lo in range(0, len(first), 1 << 15):
            part = first[lo : lo + (1 << 15)]
            place[lo : lo + (1 << 15)] = part + (grams[part[:, None] + np.arange(PLACES)] == least[part][:, None]).argmax(axis=1)
        out.append((place, first, np.minimum(last, place), least[first]))
        more = place < last
        first, last = place[more] + 1, last[more]
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


class Contexts:
    """Anchors with the bytes of their windows, in order of (document, place); equal windows are told by sorting.

    data: bytes of all contexts; start, at, count: of each context its first byte, its anchor and how many windows
    it has; key: hash of the anchor.
    """

    def __init__(self, data: np.ndarray, start: np.ndarray, at: np.ndarray, count: np.ndarray, key: np.ndarray):
        self.data, self.start, self.at, self.count, self.key = data, start, at, count, key
        self.room = start + count + WINDOW - 1 - at  # bytes from the anchor to the context's end
        self.sums = prefix_sums(data)
        self.inverse = inverses(len(data) + 1)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Lengths of the common extensions of the suffixes at anchors x and y, by binary search over prefix hashes."""
        low, high = np.zeros(len(x), np.int64), np.minimum(self.room[x], self.room[y])
        ax, ay = self.at[x], self.at[y]
        for _ in range(WINDOW.bit_length()):
            middle = (low + high + 1) >> 1
            same = (self.sums[ax + middle] - self.sums[ax]) * self.inverse[ax] == (self.sums[ay + middle] - self.sums[ay]) * self.inverse[ay]
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def before(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix x sorts before suffix y (a prefix before what it is a prefix of)."""
        n = self.common(x, y)
        rx, ry = self.room[x], self.room[y]
        ended = n == np.minimum(rx, ry)
        last = len(self.data) - 1
        bx, by = self.data[np.minimum(self.at[x] + n, last)], self.data[np.minimum(self.at[y] + n, last)]
        return np.where(ended, (rx < ry) | (or_equal & (rx == ry)), bx < by)

    def suffix_order(self) -> np.ndarray:
        """Contexts by key, and those of a key by the suffix at the anchor: a mergesort of all keys at once."""
        order = np.argsort(self.key, kind="stable")
        _, begin, size = np.unique(self.key[order], return_index=True, return_counts=True)
        begin_of, size_of = np.repeat(begin, size), np.repeat(size, size)
        width = 1
        while size.size and width < size.max():
            slot = np.flatnonzero(size_of > width)
            inside = slot - begin_of[slot]
            run = inside // width
            base = begin_of[slot] + (run & ~1) * width
            other = begin_of[slot] + (run ^ 1) * width
            low = np.minimum(other, begin_of[slot] + size_of[slot])
            high = np.minimum(other + width, begin_of[slot] + size_of[slot])
            first, item, right = low.copy(), order[slot], (run & 1) == 1
            while (going := np.flatnonzero(low < high)).size:
                middle = (low[going] + high[going]) >> 1
                less = self.before(order[middle], item[going], right[going])
                low[going], high[going] = np.where(less, middle + 1, low[going]), np.where(less, high[going], middle)
            moved = order.copy()
            moved[base + inside % width + (low - first)] = item
            order = moved
            width *= 2
        return order

    def repeats(self) -> tuple[np.ndarray, np.ndarray]:
        """(context, window) pairs, flat, of windows that equal one of an earlier context."""
        n = len(self.start)
        order = self.suffix_order()
        same = np.zeros(n, np.int64)
        if n > 1:
            together = np.flatnonzero(self.key[order[1:]] == self.key[order[:-1]]) + 1
            same[together] = self.common(order[together - 1], order[together])
        context, place, source = [], [], []
        for left in range(PLACES):  # windows that start so many bytes before their anchors
            run = np.empty(n, np.int64)
            run[order] = np.cumsum(same < WINDOW - left)
            window = self.at - left - self.start
            own = np.flatnonzero((window >= 0) & (window < self.count))
            if len(own) < 2:
                continue
            begin = self.at[own] - left
            key = mix((self.sums[self.at[own]] - self.sums[begin]) * self.inverse[begin] + run[own].astype(U64) * U64(0x9E3779B97F4A7C15))
            _, one, every = np.unique(key, return_index=True, return_inverse=True)  # own is in order: one is the first
            later = np.flatnonzero(one[every] != np.arange(len(own)))
            context.append(own[later].astype(np.int32))
            place.append(window[own[later]].astype(np.int32))
            source.append(own[one[every[later]]].astype(np.int32))
        if not context:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        context, place, source = (np.concatenate(x) for x in (context, place, source))
        good = self._verified(context, place, source)
        return context[good], place[good]

    def _verified(self, context: np.ndarray, place: np.ndarray, source: np.ndarray) -> np.ndarray:
        """Whether the bytes are equal, not just their hashes; where not, every window of the key is compared."""
        pair, at = np.unique(context.astype(np.int64) * len(self.start) + source, return_inverse=True)
        left = self.at[context] - self.start[context] - place  # from the window to the anchor
        far, near = np.zeros(len(pair), np.int64), np.full(len(pair), PLACES, np.int64)
        np.maximum.at(far, at, left)
        np.minimum.at(near, at, left)
        a, b = pair // len(self.start), pair % len(self.start)
        sizes = far + WINDOW - near
        good = np.ones(len(pair), bool)
        for lo in range(0, len(pair), 1 << 13):
            part = slice(lo, lo + (1 << 13))
            size = sizes[part]
            inside = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(np.cumsum(size) - size, size)
            x, y = (self.data[inside + np.repeat(self.at[v[part]] - far[part], size)] for v in (a, b))
            good[part] = np.logical_and.reduceat(x == y, np.cumsum(size) - size)
        out = good[at]
        for i in np.flatnonzero(~out):  # a collision of hashes: compare with every earlier window of the same place
            c, begin = context[i], self.at[context[i]] - left[i]
            text = self.data[begin : begin + WINDOW].tobytes()
            for e in np.flatnonzero((self.key[:c] == self.key[c]) & (self.at[:c] - left[i] >= self.start[:c]) & (self.at[:c] - left[i] < self.start[:c] + self.count[:c])):
                if self.data[self.at[e] - left[i] : self.at[e] - left[i] + WINDOW].tobytes() == text:
                    out[i] = True
                    break
        return out


def _spans(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, begin, end) of the bytes that windows at these places cover, joined within a document."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + WINDOW)
    first = np.flatnonzero(new)
    return doc[first], place[first], place[np.append(first[1:], len(doc))[: len(first)] - 1] + WINDOW if len(doc) else place


#: Shifts that scatter an id or a hash over the parts, the same here and in SQL.
_SHIFTS, _SALT = (13, 7, 17), 0x5DEECE66D1CE4E5B


def _part(values: np.ndarray, parts: int) -> np.ndarray:
    x = values.view(U64) ^ U64(_SALT)
    x = x ^ x << U64(_SHIFTS[0])
    x = x ^ x >> U64(_SHIFTS[1])
    x = x ^ x << U64(_SHIFTS[2])
    return x.view(np.int64) % parts


def _part_column(column: Column, parts: int) -> Column:
    x = column.bitwiseXOR(F.lit(_SALT))
    x = x.bitwiseXOR(F.shiftleft(x, _SHIFTS[0]))
    x = x.bitwiseXOR(F.shiftrightunsigned(x, _SHIFTS[1]))
    x = x.bitwiseXOR(F.shiftleft(x, _SHIFTS[2]))
    return F.pmod(x, F.lit(parts)).cast("int")


def _dealer(parts: int):
    def deal(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        part = _part(keys, parts)
        order = np.argsort(part, kind="stable")
        for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            if len(own):
                yield int(part[own[0]]), own

    return deal


def _from_blobs(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(b, kind) for b in table.column(name).to_pylist()] or [np.zeros(0, kind)])


def repeated_spans(docs: DataFrame, parts: int) -> DataFrame:
    """(part, ids, begins, ends): packed spans of repeated bytes of documents (part, doc_id, text), part < parts.

    1. Tasks find the anchors of their texts, PACKED or so at a time. Of those with one hash the first goes to the part
       of the hash; the others are known to repeat and go to the parts of their documents, so that a hash that stands in
       many documents costs its part one entry for each run of anchors.
    2. Each part names the anchors whose hash occurs twice and sends them to the parts of their documents.
    3. There the contexts of those anchors are compared with each other, so that only the first of equal windows
       within a part go on: however often a passage repeats, a part sends its context once.
    4. These meet in the part of the anchor's hash, where suffix sorting finds the windows that start earlier.
    """
    deal = _dealer(parts)

    names = ["part", "keys", "ids", "places", "sure"]

    def send(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        key, doc, place = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(key, kind="stable")
        key, doc, place = key[order], doc[order], place[order]
        first, again = np.ones(len(key), bool), np.zeros(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        again[:-1] = first[:-1] & ~first[1:]
        rest = np.flatnonzero(~first)
        key, sure = key[first], again[first]
        rows = [(p, key[own].tobytes(), doc[first][own].tobytes(), place[first][own].tobytes(), sure[own].tobytes()) for p, own in deal(key)]
        rows += [(p, None, doc[rest[own]].tobytes(), place[rest[own]].tobytes(), None) for p, own in deal(doc[rest])]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.binary() if i else pa.int32()) for i in range(5)], names=names)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            ids = batch.column("doc_id").to_numpy()
            for lo, hi, data, offs in chunks(batch, "text", TEXT_BYTES):
                place, _, _, key = anchors(data, offs)
                text = np.searchsorted(offs, place, "right") - 1
                found.append((key, ids[lo:hi][text], (place - offs[text]).astype(np.int32)))
                if sum(len(f[0]) for f in found) > PACKED:
                    yield send(found)
                    found = []
        if found:
            yield send(found)
        release()

    packed = pa.schema([("part", pa.int32()), ("ids", pa.binary()), ("places", pa.binary())])

    def name(table: pa.Table) -> pa.Table:
        known = table.filter(pc.is_null(table.column("keys"))).select(["part", "ids", "places"])
        table = table.filter(pc.is_valid(table.column("keys")))
        key, doc, place, sure = (_from_blobs(table, c, t) for c, t in (("keys", U64), ("ids", np.int64), ("places", np.int32), ("sure", bool)))
        order = np.argsort(key, kind="stable")
        key = key[order]
        twice = np.zeros(len(key), bool)
        twice[1:] = key[1:] == key[:-1]
        twice[:-1] |= twice[1:]
        twice |= sure[order]
        doc, place = doc[order[twice]], place[order[twice]]
        rows = [tuple(r.values()) for r in known.to_pylist()]  # named where they were found
        rows += [(p, doc[own].tobytes(), place[own].tobytes()) for p, own in deal(doc)]
        return pa.table([pa.array([r[i] for r in rows], t.type) for i, t in enumerate(packed)], schema=packed)

    sent = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary()), ("places", pa.binary()), ("lefts", pa.binary()), ("counts", pa.binary()), ("data", pa.binary())])

    def compare(_key, texts: pa.Table, named: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        texts = texts.sort_by("doc_id")
        ids = texts.column("doc_id").to_numpy()
        want_doc, want_place = _from_blobs(named, "ids", np.int64), _from_blobs(named, "places", np.int32)
        found: list[tuple[np.ndarray, ...]] = []
        for batch in texts.combine_chunks().to_batches() if len(want_doc) else ():
            for lo, hi, data, offs in chunks(batch, "text", TEXT_BYTES):
                place, first, last, key = anchors(data, offs)
                text = np.searchsorted(offs, place, "right") - 1
                wanted = np.isin(want_doc, batch.column("doc_id").slice(lo, hi - lo).to_numpy())
                index = np.searchsorted(ids[lo:hi], want_doc[wanted])
                good = np.isin(place, offs[index] + want_place[wanted])
                place, first, last, key, text = (x[good] for x in (place, first, last, key, text))
                size = last - first + WINDOW
                inside = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(np.cumsum(size) - size, size)
                found.append((ids[lo:hi][text], first - offs[text], place - first, last - first + 1, key, data[inside + np.repeat(first, size)]))
        if found:
            doc, begin, left, count, key, data = (np.concatenate(x) for x in zip(*found, strict=True))
            doc, begin, left, count, key, data = _ordered(doc, begin, left, count, key, data)
            start = np.cumsum(count + WINDOW - 1) - (count + WINDOW - 1)
            context, window = Contexts(data, start, start + left, count, key).repeats()
            d, b, e = _spans(doc[context], begin[context] + window)
            if len(d):
                rows.append((_key[0].as_py(), None, d.tobytes(), b.tobytes(), e.tobytes(), None, None))
            known = np.zeros(int(count.sum()), bool)
            known[np.repeat(np.cumsum(count) - count, count)[np.cumsum(count)[context] - 1] + window if len(context) else context] = True
            rest = ~known
            owner = np.repeat(np.arange(len(count)), count)[rest]
            inside = (np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count))[rest]
            if len(owner):
                one = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
                own, low, high = owner[one], inside[one], inside[np.append(one[1:], len(owner)) - 1]
                for p, which in deal(key[own]):
                    o, a, z = own[which], low[which], high[which]
                    size = z - a + WINDOW
                    flat = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(np.cumsum(size) - size, size)
                    rows.append((p, key[o].tobytes(), doc[o].tobytes(), (begin[o] + a).tobytes(), (left[o] - a).astype(np.int64).tobytes(), (z - a + 1).tobytes(), data[flat + np.repeat(start[o] + a, size)].tobytes()))
        release()
        return pa.table([pa.array([r[i] for r in rows], t.type) for i, t in enumerate(sent)], schema=sent)

    spans = pa.schema([("part", pa.int32()), ("ids", pa.binary()), ("begins", pa.binary()), ("ends", pa.binary())])

    def resolve(table: pa.Table) -> pa.Table:
        local = table.filter(pc.is_null(table.column("keys")))
        table = table.filter(pc.is_valid(table.column("keys")))
        doc, begin, end = (_from_blobs(local, c, np.int64) for c in ("ids", "places", "lefts"))
        if table.num_rows:
            key, d, b, left, count, data = (_from_blobs(table, c, t) for c, t in (("keys", U64), ("ids", np.int64), ("places", np.int64), ("lefts", np.int64), ("counts", np.int64), ("data", np.uint8)))
            d, b, left, count, key, data = _ordered(d, b, left, count, key, data)
            start = np.cumsum(count + WINDOW - 1) - (count + WINDOW - 1)
            context, window = Contexts(data, start, start + left, count, key).repeats()
            more = _spans(d[context], b[context] + window)
            doc, begin, end = (np.concatenate(x) for x in zip((doc, begin, end), more, strict=True))
        rows = [(p, doc[own].tobytes(), begin[own].tobytes(), end[own].tobytes()) for p, own in deal(doc)]
        release()
        return pa.table([pa.array([r[i] for r in rows], t.type) for i, t in enumerate(spans)], schema=spans)

    found = docs.select("doc_id", "text").mapInArrow(find, "part int, keys binary, ids binary, places binary, sure binary")
    named = found.groupBy("part").applyInArrow(name, "part int, ids binary, places binary")
    texts = docs.select("part", "doc_id", "text")
    met = texts.groupBy("part").cogroup(named.groupBy("part")).applyInArrow(compare, "part int, keys binary, ids binary, places binary, lefts binary, counts binary, data binary")
    return met.groupBy("part").applyInArrow(resolve, "part int, ids binary, begins binary, ends binary")


def _ordered(doc, begin, left, count, key, data):
    """Contexts by (document, window place)."""
    size = count + WINDOW - 1
    start = np.cumsum(size) - size
    order = np.lexsort((begin, doc))
    size = size[order]
    inside = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(np.cumsum(size) - size, size)
    return doc[order], begin[order], left[order], count[order], key[order], data[inside + np.repeat(start[order], size)]


def parts_of(docs: DataFrame) -> int:
    """How many parts the texts are dealt to: one for PART_BYTES of text, so that a part's size stays the same."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(16, -(-size // PART_BYTES))


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text (bytes left), n_bytes, n_removed, n_spans of documents (doc_id, text).

    Texts are UTF-8 bytes. A byte goes if a 100-byte string over it also starts earlier: in a document of smaller
    doc_id, or before in the same one; strings are judged on the input, and never cross documents. What is left is
    binary, as a cut can fall within a character. Null or empty texts, and texts of under 100 bytes, stay as they
    are (null as empty). Repeated doc_ids count once, with their smallest text; other columns are ignored.
    """
    docs = one_per_id(docs, "doc_id", "text")
    parts = parts_of(docs)

    docs = docs.select(_part_column(F.col("doc_id"), parts).alias("part"), "doc_id", "text")
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64())])

    def cut(_key, texts: pa.Table, found: pa.Table) -> pa.Table:
        doc, begin, end = (_from_blobs(found, c, np.int64) for c in ("ids", "begins", "ends"))
        order = np.lexsort((end, begin, doc))
        doc, begin, end = doc[order], begin[order], end[order]
        out: list[list] = [[], [], [], [], []]
        ids = texts.column("doc_id").to_numpy()
        data, offs = string_parts(texts.column("text"))
        lows, highs = np.searchsorted(doc, ids), np.searchsorted(doc, ids, "right")
        for i, (lo, hi) in enumerate(zip(lows.tolist(), highs.tolist(), strict=True)):
            text = data[offs[i] : offs[i + 1]]
            keep, at, spans, removed = [], 0, 0, 0
            last = -1
            for b, e in zip(begin[lo:hi].tolist(), end[lo:hi].tolist(), strict=True):
                if b > last:
                    spans += 1
                    keep.append(text[at:b])
                if e > last:
                    removed += e - max(b, last)
                    last = at = e
            keep.append(text[at:])
            for x, v in zip(out, (int(ids[i]), np.concatenate(keep).tobytes(), len(text), removed, spans), strict=True):
                x.append(v)
        return pa.table([pa.array(x, f.type) for x, f in zip(out, schema, strict=True)], schema=schema)

    return docs.groupBy("part").cogroup(repeated_spans(docs, parts).groupBy("part")).applyInArrow(cut, "doc_id long, text binary, n_bytes long, n_removed long, n_spans long")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses if every later occurrence of a 100-byte string is removed."""
    left = without_repeats(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("text", 256).alias("kept_sha256"))


SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(n - 99)) AS p FROM d WHERE n >= 100)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS o FROM w) WHERE o > 1),
s AS (SELECT doc_id, p, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS new FROM r),
g AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM s),
b AS (SELECT doc_id, g, min(p) AS b, max(p) + 100 AS e FROM g GROUP BY doc_id, g),
l AS (SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS a FROM b),
t AS (
  SELECT doc_id, count(*) AS c, sum(e - b) AS m, string_agg(substr(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY b) || substr(any_value(h), 2 * max(e) + 1) AS kept
  FROM l JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(m, 0) AS BIGINT) AS n_removed, coalesce(c, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""
