"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, union-find grouping."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import U64, Staging, chunks, mix, one_per_id, shingle_sets, string_parts, table
from .components import components, union_find

#: Positions of a signature; prime, so that every (start, step) walks all positions once.
POSITIONS = 127
_EMPTY = np.uint32(0xFFFFFFFF)
_CODES = ("s0", "s1", "s2", "s3")


def superminhash(sets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Signatures (one row of POSITIONS values for each set) of sets of 64-bit hashes.

    Each element visits the positions in an order of its own (a permutation start + i * step modulo a prime, both
    from its hash) and offers ``rank + fraction``; a position keeps the smallest offer. As ranks of one element
    differ between positions, signatures vary less than with independent hashes. All elements advance rank by rank,
    so a set is done as soon as every position has an offer: later ranks can only be larger. That is the early stop.
    """
    out = np.full((len(sizes), POSITIONS), _EMPTY, np.uint32)
    flat, row = out.reshape(-1), np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    x = sets
    base = mix(x)
    at = ((base >> U64(33)) % U64(POSITIONS)).astype(np.int64)
    step = (U64(1) + (mix(base) >> U64(33)) % U64(POSITIONS - 1)).astype(np.int64)
    for rank in range(POSITIONS):
        if not len(x):
            break
        fraction = (mix(x + U64(0x9E3779B97F4A7C15 * (rank + 1) % 2**64)) >> U64(40)).astype(np.uint32)
        np.minimum.at(flat, row * POSITIONS + at, np.uint32(rank << 24) | fraction)
        going = (out == _EMPTY).any(axis=1)[row]
        if not going.all():
            x, row, at, step = x[going], row[going], at[going], step[going]
        at = (at + step) % POSITIONS
    return out


def bands_for(percent: int) -> tuple[int, int]:
    """(bands, rows): the longest bands that miss a pair at the threshold in less than one case in a million."""
    t = percent / 100
    for rows in range(8, 0, -1):
        bands = POSITIONS // rows
        if (1 - t**rows) ** bands < 1e-6:
            return bands, rows
    return POSITIONS, 1


def _codes(signature: np.ndarray) -> list[np.ndarray]:
    """Two bits of each position as four 64-bit words, for the estimate of similarity within a join."""
    padded = np.zeros((len(signature), 128), np.uint32)
    padded[:, :POSITIONS] = signature
    return [np.packbits((padded[:, half : half + 64] >> np.uint32(bit)).astype(np.uint8) & 1, axis=1).copy().view(np.int64).ravel() for half in (0, 64) for bit in (0, 1)]


def least_equal(percent: int) -> int:
    """Of the POSITIONS two-bit codes, so many agree for a pair at the threshold but in one case in 10**9."""
    t = percent / 100
    p = t + (1 - t) / 4
    return max(0, math.floor(POSITIONS * p - 6 * math.sqrt(POSITIONS * p * (1 - p))))


def signatures(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n (set size), key (128-bit sum of the set, with its size), bands (hashes) and two-bit codes."""
    bands, rows = bands_for(percent)
    schema = "doc_id long, n long, k0 long, k1 long, bands array<long>, s0 long, s1 long, s2 long, s3 long"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offs in chunks(batch, "text"):
                sets, sizes = shingle_sets(data, offs, words)
                first, some = np.cumsum(sizes) - sizes, sizes > 0
                keys = [np.zeros(len(sizes), U64) for _ in "01"]
                for i, key in enumerate(keys):
                    key[some] = np.add.reduceat(mix(sets + U64(77 + i)), first[some]) if some.any() else 0
                signed = superminhash(sets, sizes)
                hashed = np.zeros((len(sizes), bands), U64)
                for b in range(bands):
                    for r in range(rows):
                        hashed[:, b] = mix(hashed[:, b] * U64(31) + signed[:, b * rows + r] + U64(b + 1))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * bands)]).astype(np.int32)), pa.array(hashed[some].ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo).cast(pa.int64()), pa.array(sizes), *(pa.array(k.view(np.int64)) for k in keys), lists, *map(pa.array, _codes(signed))], schema=_arrow_schema())

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(sign, schema)


def _arrow_schema() -> pa.Schema:
    long = pa.int64()
    return pa.schema([("doc_id", long), ("n", long), ("k0", long), ("k1", long), ("bands", pa.list_(long)), *((s, long) for s in _CODES)])


def verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """Of pairs (a, b) those whose full sets have ``100 * shared >= percent * union``.

    The texts come by two equi-joins, which Spark can split where one document has many pairs.
    """
    a, b = (docs.select(F.col("doc_id").cast("long").alias(x), F.col("text").alias(f"t{x}")) for x in "ab")
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("a").to_numpy(), batch.column("b").to_numpy()
            for lo, hi, data, offs in chunks(batch, "tb"):
                at, distinct = np.unique(left[lo:hi], return_inverse=True)
                firsts = [int(i) for i in np.unique(distinct, return_index=True)[1]]
                whole, ends = string_parts(batch.column("ta").slice(lo, hi - lo))
                pick = [whole[ends[i] : ends[i + 1]] for i in firsts]
                sa, na = shingle_sets(np.concatenate(pick), np.concatenate([[0], np.cumsum([len(p) for p in pick])]), words)
                sb, nb = shingle_sets(data, offs, words)
                ea, eb = np.concatenate([[0], np.cumsum(na)]), np.concatenate([[0], np.cumsum(nb)])
                keep = np.zeros(hi - lo, bool)
                for i in range(hi - lo):
                    x, y = sa[ea[distinct[i]] : ea[distinct[i] + 1]], sb[eb[i] : eb[i + 1]]
                    if len(x) and len(y):
                        pos = np.searchsorted(x, y)
                        shared = int((x[np.minimum(pos, len(x) - 1)] == y).sum())
                        keep[i] = 100 * shared >= percent * (len(x) + len(y) - shared)
                yield pa.RecordBatch.from_arrays([pa.array(left[lo:hi][keep]), pa.array(right[lo:hi][keep])], names=["a", "b"])

    return both.mapInArrow(confirm, "a long, b long")


def _alike(percent: int) -> str:
    """SQL for a pair x, y that can still reach the threshold: by set sizes, and by the codes' agreement."""
    differ = "bit_count((x.s0 ^ y.s0) | (x.s1 ^ y.s1)) + bit_count((x.s2 ^ y.s2) | (x.s3 ^ y.s3))"
    return f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) AND {POSITIONS} - ({differ}) >= {least_equal(percent)}"


#: Rows of a block, least; a group with more rows is dealt out over 64 blocks of each side, more with long texts.
BLOCK, BLOCKS, BLOCK_BYTES = 128, 64, 16 << 20


def _dealt(rows: DataFrame, key: str, stray: str, weight: str) -> DataFrame:
    """Rows of each group ``key`` dealt to tasks (key, i, j): strays to block i of all j, all rows to block j of all i.

    Any stray and any other row of its group meet in exactly one block (key, i, j) of two sides. Rows are dealt by the
    whole of that key: a dealing by the group alone, which the joins leave behind, would do for grouping by (key, i, j)
    too, and would put all blocks of a large group in one task.
    """
    size = rows.groupBy(key).agg(F.count(F.lit(1)).alias("m"), F.sum(F.expr(f"cast({stray} as long)")).alias("s"), F.sum(weight).alias("w"))
    each = F.greatest(F.lit(BLOCK), F.ceil(F.col("m") / BLOCKS))
    parts = F.greatest(F.ceil(F.col("m") / each), F.ceil(F.col("w") / BLOCK_BYTES))
    size = size.where("s > 0").select(key, parts.cast("int").alias("nj"), F.greatest(F.lit(1), F.ceil(parts * F.col("s") / F.col("m"))).cast("int").alias("ni"))
    both = rows.join(size, key)
    deal = F.xxhash64("doc_id")
    left = both.where(stray).withColumn("i", F.pmod(deal, F.col("ni")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nj") - 1)))
    right = both.withColumn("j", F.pmod(deal, F.col("nj")).cast("int")).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ni") - 1)))
    return left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1))).drop("ni", "nj").repartition(key, "i", "j")


def _forest(a: list[np.ndarray], b: list[np.ndarray]) -> pa.Table:
    a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
    ids, roots = union_find(a, b)
    moved = ids != roots
    return pa.table({"a": roots[moved], "b": ids[moved]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def families(named: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components that share a bucket and have members alike enough by size and codes.

    named: band, doc_id, root, n and codes. Only buckets of several components are read, and not those of two rows,
    which have been compared; strays are the members outside a bucket's largest component.
    """
    home = named.groupBy("band", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("band").agg(F.max(F.struct("c", "root")).alias("top"), F.count(F.lit(1)).alias("roots"), F.sum("c").alias("m"))
    rows = named.join(home.where("roots > 1 AND m > 2").select("band", F.col("top.root").alias("home")), "band").withColumn("one", F.lit(1))
    enough = least_equal(percent)

    def search(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        col = {c: table.column(c).to_numpy() for c in ("root", "n", *_CODES)}
        x, y = ({c: v[side == k] for c, v in col.items()} for k in (0, 1))
        a, b = [], []
        for lo in range(0, len(x["n"]), 64):
            own = {c: v[lo : lo + 64, None] for c, v in x.items()}
            differ = sum(np.bitwise_count(((own[p] ^ y[p]) | (own[q] ^ y[q])).view(np.uint64)).astype(np.int16) for p, q in (("s0", "s1"), ("s2", "s3")))
            like = (POSITIONS - differ >= enough) & (own["root"] != y["root"]) & (100 * np.minimum(own["n"], y["n"]) >= percent * np.maximum(own["n"], y["n"]))
            at, to = np.nonzero(like)
            a.append(x["root"][lo + at])
            b.append(y["root"][to])
        return _forest(a, b)

    dealt = _dealt(rows.withColumn("stray", F.col("root") != F.col("home")), "band", "stray", "one")
    return dealt.groupBy("band", "i", "j").applyInArrow(search, "a long, b long").distinct()


def cross_links(of: DataFrame, docs: DataFrame, staging: Staging, words: int, percent: int) -> DataFrame:
    """Links (a, b) between components of one family, by their members' full sets. of: doc_id, root, grp."""
    of = staging.save(of, "of")
    home = of.groupBy("grp", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("grp").agg(F.max(F.struct("c", "root")).alias("top"))
    rows = of.join(home.select("grp", F.col("top.root").alias("home")), "grp").join(docs.select("doc_id", "text", F.octet_length("text").alias("bytes")), "doc_id")
    rows = rows.withColumn("stray", F.col("root") != F.col("home"))

    def compare(table: pa.Table) -> pa.Table:
        side, root = table.column("side").to_numpy(), table.column("root").to_numpy()
        sets, sizes = shingle_sets(*string_parts(table.column("text")), words)
        universe, items = np.unique(sets, return_inverse=True)
        first = np.cumsum(sizes) - sizes
        right = np.flatnonzero((side == 1) & (sizes > 0))
        flat = np.concatenate([items[first[r] : first[r] + sizes[r]] for r in right]) if len(right) else items[:0]
        starts = np.cumsum(sizes[right]) - sizes[right]
        mark = np.zeros(len(universe), np.int32)
        a, b = [], []
        for x in np.flatnonzero((side == 0) & (sizes > 0)) if len(right) else ():
            own = items[first[x] : first[x] + sizes[x]]
            mark[own] = 1
            shared = np.add.reduceat(mark[flat], starts)
            mark[own] = 0
            hit = (100 * shared >= percent * (sizes[x] + sizes[right] - shared)) & (root[right] != root[x])
            b.append(root[right][hit])
            a.append(np.full(len(b[-1]), root[x]))
        return _forest(a, b)

    dealt = _dealt(rows.select("grp", "doc_id", "root", "stray", "bytes", "text"), "grp", "stray", "bytes").select("grp", "i", "j", "side", "root", "text")
    return dealt.groupBy("grp", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, staging: Staging, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of documents (doc_id, text).

    Documents are linked where the Jaccard similarity of their sets of distinct ``words``-word shingles is
    ``percent`` or more; component_id is the smallest doc_id that links reach. Null, empty or blank texts have an
    empty set, are linked with nothing and stay. Equal sets form one class, whose smallest doc_id stands for it, so a
    group of copies costs one row whatever its size. Representatives that share a band are candidates:

    1. each is compared with the smallest of its bucket, and links are grouped;
    2. buckets that still hold more than one component are searched, in blocks, for pairs of components whose codes
       agree enough to hide a link; these make families of components;
    3. within each family, again in blocks, the full sets of what its largest component lacks are compared with
       those of all members of other components, and links go to the grouping.

    So every candidate pair is either verified or already joined by verified links, and tasks hand on no more rows
    than they read: a forest of links, not the pairs of a group. Repeated doc_ids count once, with their smallest
    text; other columns are ignored.
    """
    docs = one_per_id(docs, "doc_id", "text")
    signed = staging.save(signatures(docs, words, percent), "signed")
    classes = staging.save(signed.where("n > 0").groupBy("k0", "k1", "n").agg(F.min("doc_id").alias("rep")), "classes")
    reps = signed.join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    member = reps.select("doc_id", F.explode("bands").alias("band"))
    shared = member.groupBy("band").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("other")).where("hub < other").select("band", "hub")
    member = staging.save(member.join(shared, "band"), "member")
    size = signed.select("doc_id", "n", *_CODES)
    stars = member.where("hub <> doc_id").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    stars = stars.join(size.alias("x"), F.expr("x.doc_id = a")).join(size.alias("y"), F.expr("y.doc_id = b")).where(_alike(percent)).select("a", "b")
    stars = staging.save(stars, "stars")
    links = staging.save(verified(stars, docs, words, percent), "links1")
    roots = components(links, staging, "first")
    named = member.join(roots, F.col("doc_id") == F.col("node"), "left").select("band", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    family = staging.save(families(named.join(size, "doc_id"), percent), "family")
    if family.isEmpty():
        more = links.limit(0)
    else:
        group = components(family, staging, "family").withColumnRenamed("root", "grp").withColumnRenamed("node", "root")
        of = signed.select("doc_id").join(classes, F.col("doc_id") == F.col("rep"), "left_semi").join(roots, F.col("doc_id") == F.col("node"), "left")
        of = of.select("doc_id", F.coalesce("root", "doc_id").alias("root")).join(group, "root")
        more = staging.save(cross_links(of, docs, staging, words, percent), "links2")
    stem = roots.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
    roots = components(stem.union(more), staging, "last") if not more.isEmpty() else roots
    found = signed.select("doc_id", "n", "k0", "k1").join(classes.withColumnRenamed("n", "cn"), (signed.k0 == classes.k0) & (signed.k1 == classes.k1) & (F.col("n") == F.col("cn")), "left")
    found = found.join(roots, F.col("rep") == F.col("node"), "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep", "doc_id").alias("component_id"))
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents whose 3-word shingle sets have a similarity of 85 % or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), Staging(spark, "op1"), words=3, percent=85)


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p : p + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node),
k AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM d JOIN k ON node = doc_id LEFT JOIN n USING (doc_id)
"""
