"""Classes against brute force over all pairs; signatures against their expected similarity."""

import itertools
import random
import re

import numpy as np

from cartoloom.llm import near_dedup
from cartoloom.llm.common import U64, Staging, mix
from cartoloom.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def brute(texts, k, percent):
    sets = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").translate(FOLD))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            p, q = sorted((find(a), find(b)))
            up[q] = p
    return {i: (len(sets[i]), find(i)) for i in sets}


def classes(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_query_matches_brute_force(spark, small):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    assert classes(near_dedup.op1_near_dedup(spark, small)) == brute(texts, 3, 85)


def test_family_whose_members_are_not_all_alike(spark):
    rng = random.Random(5)
    seed = [f"w{rng.randrange(5000)}" for _ in range(120)]
    texts = {}
    for i in range(260):  # edits of one text: some link to it, some only to each other, some to nothing
        words = list(seed)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 7, 9])):
            words[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        texts[i] = " ".join(words)
    for i in range(300, 420):
        texts[i] = " ".join(seed[:70] + [f"y{rng.randrange(10**6)}" for _ in range(50)])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert classes(near_dedup.near_duplicates(docs, Staging(spark, "t"), 3, 85)) == brute(texts, 3, 85)
    assert classes(near_dedup.near_duplicates(docs, Staging(spark, "t"))) == brute(texts, 5, 80)


def test_odd_rows(spark, odd_documents):
    texts = {r.doc_id: r.text for r in odd_documents.collect()}
    got = classes(near_dedup.near_duplicates(odd_documents, Staging(spark, "t"), 3, 85))
    assert got == brute(texts, 3, 85)
    assert got[5] == (1, 4) and got[7] == (2, 6) and got[1] == (0, 1)
    assert near_dedup.near_duplicates(odd_documents.limit(0), Staging(spark, "t")).count() == 0


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    errors = []
    for size, shared in ((40, 30), (400, 300), (400, 360), (6, 5)):
        union = 2 * size - shared
        got = []
        for _ in range(60):
            x = mix(rng.integers(0, 2**63, union).astype(U64))
            signed = near_dedup.superminhash(np.concatenate([np.sort(x[:size]), np.sort(x[size - shared :])]), np.array([size, size]))
            got.append((signed[0] == signed[1]).mean())
        errors.append(abs(np.mean(got) - shared / union))
    assert max(errors) < 0.02, errors


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1002), (5000, 5000)]
    random.Random(1).shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long").repartition(7), Staging(spark, "t"), "c").collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000, 1002: 1000, 5000: 5000}


def test_long_words_that_a_polynomial_cannot_tell_apart(spark):
    word = "A"
    for _ in range(11):
        word += word.translate(str.maketrans("AB", "BA"))
    other = word.translate(str.maketrans("AB", "BA"))
    texts = {1: f"{word} x y {other} x y", 2: f"{word} x y {word} x y"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert classes(near_dedup.near_duplicates(docs, Staging(spark, "t"), 3, 85)) == brute(texts, 3, 85)


def test_blocks_of_a_large_group_are_dealt_apart(spark):
    from pyspark.sql import functions as F

    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit(1).alias("grp"), (F.col("id") % 3 == 0).alias("stray"), F.lit(1).alias("one"))
    dealt = near_dedup._dealt(rows, "grp", "stray", "one")
    grouped = dealt.groupBy("grp", "i", "j").agg(F.count(F.lit(1)).alias("c"))
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(grp#" in plan and any("hashpartitioning(grp#" in x and ", i#" in x and ", j#" in x for x in plan.splitlines())
    met = dealt.groupBy("grp", "i", "j").agg(F.collect_set(F.when(F.col("side") == 0, F.col("doc_id"))).alias("a"), F.collect_set(F.when(F.col("side") == 1, F.col("doc_id"))).alias("b")).collect()
    pairs = [(x, y) for r in met for x in r.a for y in r.b]
    assert len(pairs) == len(set(pairs)) == 334 * 1000 and len(met) > 8
