"""Base spans against Python's own pattern matching; contexts on a made-up corpus."""

import hashlib
import re

from cartoloom.llm import pii
from cartoloom.llm.common import Staging

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": lambda: True, "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")), "card": lambda d=digits: 16 <= len(d) <= 19 and luhn(d), "phone": lambda d=digits: 8 <= len(d) <= 15}[kind]()
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        own = base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in own).encode()).hexdigest(), (r, own)
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(o[0] == k for o in own) for k in PATTERNS]
        assert {f"{k}:{s}:{e}" for k, s, e in own} <= set(r["spans"].split(",")) | {""}


def test_base_spans_are_those_of_the_patterns(spark, small):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    check(pii.op3_personal_data(spark, small).collect(), texts)


def test_awkward_texts(spark):
    texts = dict(
        enumerate(
            [
                None, "", "a@b.c_d@e.f x@y.z", "1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255 1.2.3.256", "4111 1111 1111 1111-1 4111111111111111",
                "+1 (988) 555-2485 +12 +1234567 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "é\U0001f600 me@x.orgé", "1" * 20_000, "a" * 20_000, "a." * 5_000 + "@b" + ".c" * 5_000,
                "1-" * 5_000, "x@y", "+" * 3_000, "a@b.c@d.e@f.g",
            ]
        )
    )
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, kind string")
    check(pii.digest(docs, pii.personal_data(docs, Staging(spark, "t"))).collect(), texts)


def test_contexts_find_what_no_pattern_knows(spark):
    words = "red blue green grey pink brown white black".split()
    rows = [(i, f"{words[i % 8]} {words[i // 8 % 8]} call phone: +1 (9{i:02d}) 555-{2000 + i} now") for i in range(40)]
    rows += [(100 + i, f"{words[i]} call phone: 555-77{i:02d} now and 2024 was {1000 + i} fine") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(docs, pii.personal_data(docs, Staging(spark, "t"))).collect()}
    for i in range(3):
        text = dict(rows)[100 + i]
        at = text.index("555-")
        assert got[100 + i] == f"phone:{at}:{at + 8}"


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co now", 5), (2, None, 6), (3, "none", 7)], "doc_id long, text string, extra int")
    spans = pii.personal_data(docs, Staging(spark, "t"))
    assert sorted((r.doc_id, r.text, r.extra) for r in pii.redacted(docs, spans).collect() if r.text) == [(1, "mail <email> now", 5), (3, "none", 7)]
    assert pii.redacted(docs, spans).columns == docs.columns
    assert pii.personal_data(docs.limit(0), Staging(spark, "t")).count() == 0


def test_contexts_where_half_is_unseen(spark):
    words = "red blue green grey pink brown white black".split()
    rows = [(i, f"{words[i % 8]} call phone: +1 (9{i:02d}) 555-{2000 + i} now") for i in range(40)]
    rows += [(100 + i, f"{words[i % 8]} call phone: 555-77{i:02d} now") for i in range(40)]
    rows += [(200 + i, f"{words[i % 8]} size was: +1 (8{i:02d}) 555-{3000 + i} or") for i in range(40)]
    rows += [(300 + i, f"{words[i % 8]} size was: {i + 10} or") for i in range(40)] + [(400, "red size was: 555-8899 or")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(docs, pii.personal_data(docs, Staging(spark, "t"))).collect()}
    for i in range(40):
        at = rows[40 + i][1].index("555-")
        assert got[100 + i] == f"phone:{at}:{at + 8}"
    assert all(got[i] == "" for i in (*range(300, 340), 400))


def test_addresses_without_digits(spark):
    words = "red blue green grey pink brown white black".split()
    rows = [(i, f"write mail: {words[i % 8]}{i}@example.org now") for i in range(40)]
    rows += [(100 + i, f"write mail: {w}.doe(at)example.org 555-1234 now") for i, w in enumerate(words)] + [(200, "write mail: root@localhost now"), (201, "meet @ noon (at) home @handle now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.digest(docs, pii.personal_data(docs, Staging(spark, "t"))).collect()}
    for i, w in enumerate(words):
        assert got[100 + i] == f"email:12:{12 + len(w) + 19}"
    assert got[200] == "email:12:26" and got[201] == ""


def test_sums_of_long_arrays(spark):
    from pyspark.sql import functions as F

    for n in (0, 1, 63, 64, 65, 4096, 10_000):
        row = spark.range(1).select(pii.running_sums(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda x: x.cast("long")) if n else F.array().cast("array<long>")).alias("s")).first()
        assert row.s == [i * (i + 1) // 2 for i in range(1, n + 1)]


def test_a_text_of_many_numbers(spark):
    text = " ".join(f"call {i} phone: +1 (988) 555-{1000 + i % 9000} x{i}@b.co" for i in range(30_000))
    docs = spark.createDataFrame([(1, text), (2, "\U0001f600" * 5000 + "a@b.co" + "é" * 4090 + " 1.2.3.4")], "doc_id long, text string")
    spans = pii.personal_data(docs, Staging(spark, "t"))
    check(pii.digest(docs, spans).collect(), {r.doc_id: r.text for r in docs.collect()})
    got = {r.doc_id: r.text for r in pii.redacted(docs, spans.where("base")).collect()}
    for r in docs.collect():
        want, at = [], 0
        for k, s, e in sorted(base(r.text), key=lambda x: x[1:]):
            if s >= at:
                want.append(r.text[at:s] + f"<{k}>")
            at = max(at, e)
        assert got[r.doc_id] == "".join(want) + r.text[at:]


def test_clashing_names(spark):
    names = ["cut", "cuts", "row", "run", "start", "end", "kind", "words", "left", "value"]
    docs = spark.createDataFrame([(1, "mail a@b.co now", *names), (None, "x", *names)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    out = pii.redacted(docs, pii.personal_data(docs, Staging(spark, "t")))
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} == {(1, "mail <email> now", *names), (None, "x", *names)}


def test_contexts_are_those_of_the_text(spark):
    docs = spark.createDataFrame([(1, "tel 12 id=+1 (988) 555-2485; and ref 7 x")], "doc_id long, text string")
    got = {r.value: (r.left, r.right) for r in pii.instances(docs).collect()}
    assert got["+1 (988) 555-2485"] == (["id=", "12"], ";")
    assert got["12"] == (["tel"], "id=+1")
    assert got["7"] == (["ref", "and"], "x")
