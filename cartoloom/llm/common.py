"""What the operators of this package share: staged tables, byte kernels and Arrow chunks.

The byte kernels work on whole Arrow buffers, so that one numpy call handles all words of a few thousand documents.
"""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
#: Bytes of text that a kernel takes at once; bounds a worker's memory, never the text that is handled.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Staging:
    """Tables written to the shared folder of ``spark.checkpoint.dir`` to cut lineage.

    A lost executor then costs a re-read of files that every executor can open. Where the setting is missing (tests
    in local mode) a temporary folder serves, as driver and executors are one process there.
    """

    def __init__(self, spark: SparkSession, label: str):
        base = spark.conf.get("spark.checkpoint.dir", None) or f"{tempfile.gettempdir()}/cartoloom"
        self.spark, self.root = spark, f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: A random 64-bit value for each byte, and the odd base of the polynomial.
BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
BASE = 0x2545F4914F6CDD1B
_powers = np.ones(1, U64)


def powers(n: int) -> np.ndarray:
    """BASE**0 .. BASE**(n - 1) modulo 2**64."""
    global _powers
    while len(_powers) < n:
        step = U64(pow(BASE, len(_powers), 1 << 64))
        _powers = np.concatenate([_powers, _powers * step])
    return _powers[:n]


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = lower_table()
#: Bytes of words between white space, and of words of letters, digits and all that is not ASCII.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x41, 0x5B), *range(0x80, 0x100)]] = True


def string_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of an Arrow string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def chunks(batch: pa.RecordBatch, name: str, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and offsets of runs of whole texts of about ``size`` bytes."""
    data, offs = string_parts(batch.column(name))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        yield lo, hi, data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def word_spans(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and lengths of the words, and how many each text has; words never cross texts."""
    inside = is_word[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    before[offs[:-1]] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    after = np.zeros(len(data) + 1, bool)
    after[:-1] = inside
    cut = np.zeros(len(data) + 1, bool)
    cut[offs] = True
    ends = np.flatnonzero(inside & (~after[1:] | cut[1:])) + 1
    per_text = np.diff(np.searchsorted(starts, offs))
    return starts, ends - starts, per_text


#: Bytes whose terms a hash adds up at once; bounds a worker's memory, never the words that are hashed.
HASH_BYTES = 1 << 20


def word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    """A 64-bit hash of each span; ``values`` maps a byte to its value (fold case there)."""
    out = np.zeros(len(starts), U64)
    ends = np.cumsum(lengths)
    lo = 0
    while lo < len(starts):
        done = int(ends[lo - 1]) if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, done + HASH_BYTES, "right")))
        size, first = lengths[lo:hi], ends[lo:hi] - lengths[lo:hi] - done
        at = np.arange(int(size.sum()), dtype=np.int64)
        inside = at - np.repeat(first, size)
        terms = values[data[inside + np.repeat(starts[lo:hi], size)]]
        terms *= powers(int(size.max()))[inside]
        terms ^= terms >> U64(32)  # a plain polynomial modulo 2**64 is blind to some pairs of long words (Thue-Morse)
        terms *= U64(0x9E3779B97F4A7C15)
        terms ^= terms >> U64(29)
        out[lo:hi] = mix(np.add.reduceat(terms, first) + size.astype(U64))
        lo = hi
    return out


FOLDED_VALUES = BYTE_VALUES[LOWER]


def gram_hashes(words: np.ndarray, per_text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's k-word shingles, in order, and how many it has; a shorter text counts as one."""
    ends = np.cumsum(per_text)
    n = len(words)
    terms = np.zeros(max(n - k + 1, 0), U64)
    for j in range(k):
        terms += words[j : n - k + 1 + j] * powers(k)[j]
    terms = mix(terms + U64(k))
    counts = np.where(per_text >= k, per_text - k + 1, np.minimum(per_text, 1))
    out = np.zeros(int(counts.sum()), U64)
    to = np.cumsum(counts) - counts
    full = np.flatnonzero(per_text >= k)
    at = np.arange(int(counts[full].sum()), dtype=np.int64) - np.repeat(np.cumsum(counts[full]) - counts[full], counts[full])
    out[at + np.repeat(to[full], counts[full])] = terms[at + np.repeat(ends[full] - per_text[full], counts[full])]
    for i in np.flatnonzero((per_text > 0) & (per_text < k)):
        own = words[ends[i] - per_text[i] : ends[i]]
        out[to[i]] = mix(np.array([(own * powers(k)[: len(own)]).sum(dtype=U64) + U64(1000 + len(own))], U64))[0]
    return out, counts


def distinct_sets(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct grams, sorted, and how many."""
    out, sizes, lo = [], np.zeros(len(counts), np.int64), 0
    for i, c in enumerate(counts.tolist()):
        if c:
            own = np.sort(grams[lo : lo + c])
            if c > 1:
                keep = np.empty(c, bool)
                keep[0] = True
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                own = own[keep]
            out.append(own)
            sizes[i] = len(own)
            lo += c
    return np.concatenate(out) if out else np.zeros(0, U64), sizes


def shingle_sets(data: np.ndarray, offs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles (A-Z folded, words between white space), and set sizes."""
    starts, lengths, per_text = word_spans(data, offs, SPACED)
    return distinct_sets(*gram_hashes(word_hashes(data, starts, lengths, FOLDED_VALUES), per_text, k))


def release() -> None:
    """Gives memory that Arrow and the allocator hold but do not use back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def one_per_id(docs: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) with one row for each key: where a key repeats, its smallest non-null value.

    Only the key column is read to find out whether any repeats; if none does, rows pass unchanged and unshuffled.
    """
    docs = docs.select(F.col(key).cast("long").alias(key), F.col(value))
    if docs.groupBy(key).agg(F.count(F.lit(1)).alias("c")).where("c > 1").isEmpty():
        return docs
    return docs.groupBy(key).agg(F.min(value).alias(value))
