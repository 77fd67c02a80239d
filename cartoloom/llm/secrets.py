"""Secret scans: candidates by patterns, features of each, and votes of a random forest, in DataFrame functions only."""

from __future__ import annotations

import base64
import functools
import math
import random
import re
import uuid
from collections import Counter
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Staging, one_per_id, table
from .pii import FOUND, _let, _matches, split_words

_NAMES = r"passw(?:or)?d|passphrase|pwd|secret|token|credential|bearer|authorization|(?:api|access|private|auth|account|client)[_-]?key"
#: What may be a secret. In the rules before ``token`` group 1 is what stands before the value itself.
RULES = {
    "block": r"(-----BEGIN [A-Z0-9 ]*+PRIVATE KEY[A-Z ]*+-----\s*+)[A-Za-z0-9+/=,:\s]++(?:-[A-Za-z0-9+/=,:\s]++)*+",
    "url": r"(://[^\s/:@]++:)[^\s/@]++(?=@)",
    "named": rf"((?i:{_NAMES})[A-Za-z0-9_-]{{0,30}}[\"'`]?(?:\s{{0,4}}(?::=|=>|==?|:)\s{{0,4}}|\s{{1,4}})(?i:bearer\s{{1,4}}|basic\s{{1,4}})?[\"'`]?)[^\s\"'`<>]{{6,}}+",
    "token": r"(?<![A-Za-z0-9+/_=-])(?:eyJ[\w-]{8,}+\.[\w-]{4,}+\.[\w-]*+|(?:A[KS]IA|gh[pousr]_|github_pat_|glpat-|xox[abeoprs]-|AIza|[srp]k_(?:live|test)_|npm_)[A-Za-z0-9_-]{10,}+|(?=[A-Za-z+/_=-]*+[0-9])[A-Za-z0-9+/_=-]{16,}+)",
}
#: Forms that issuers give their keys.
_ISSUED = r"^(?:A[KS]IA[0-9A-Z]{16}|gh[pousr]_\w{20,}|github_pat_\w{20,}|glpat-[\w-]{16,}|xox[abeoprs]-[\w-]{10,}|AIza[\w-]{30,}|[srp]k_(?:live|test)_\w{16,}|SG\.[\w-]{16,}.*|npm_\w{30,}|eyJ[\w-]{8,}\.[\w-]{4,}\..*)$"
_HOLDERS = r"(?i)example|sample|change[_-]?me|placeholder|dummy|redacted|your[_-]|x{4,}|\*{3,}|\.{3,}|0{6,}|123456|abcdef|^\$|^%|\{\{|\$\{|^(?:required|optional|string|null|none|true|false)"
#: A value is a secret if more than half of the trees say so; the forest's size, and the seed of fit and labels.
TREES, DEPTH, SEED, EACH = 25, 8, 5, 100
#: Letters of a dictionary word, least, and how often a word must occur in all texts to be one.
WORD, COMMON = 4, 20
#: Words that the labelled findings are made of; part of every dictionary.
WORDS = "user name value field login form header access index page report module server client table import number street garden winter market signal".split()


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, path, rule, start, end, value, left, right: every candidate; of overlapping ones that of the first rule.

    docs: doc_id, text and, where there is one, path (of the file that the text comes from). left: what stands before
    the value in its word or as its name, and the word before, nearest first; right: what follows.
    """
    path = F.col("path").cast("string") if "path" in docs.columns else F.lit(None).cast("string")
    texts = docs.where("text IS NOT NULL").select("doc_id", path.alias("path"), "text", split_words(F.col("text")).alias("words"))
    gate = {"block": F.contains("text", F.lit("PRIVATE KEY")), "url": F.contains("text", F.lit("://"))}
    found = []
    for place, (rule, pattern) in enumerate(RULES.items()):
        own = _matches(F.col("text"), F.col("words"), str(place), pattern)
        found.append(F.when(gate.get(rule, F.lit(True)), F.transform(own, _value_of(pattern)) if rule != "token" else own).otherwise(F.array().cast(FOUND)))
    # explode_outer: explode lets the optimizer copy all this into a filter
    rows = texts.select("doc_id", "path", F.explode_outer(F.concat(*found)).alias("x")).where("x IS NOT NULL").select("doc_id", "path", "x.*").where("value <> ''")
    rows = rows.withColumn("kind", F.col("kind").cast("int"))
    for place in range(1, len(RULES)):  # those of a rule that overlap one of an earlier rule go
        before = F.col("kind") < place
        order = Window.partitionBy("doc_id").orderBy(F.when(before, F.col("start")).otherwise(F.col("end")), before).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumn("reach", F.max(F.when(before, F.col("end"))).over(order))
        rows = rows.where((F.col("kind") != place) | (F.coalesce("reach", F.lit(0)) <= F.col("start"))).drop("reach")
    return rows.withColumn("rule", F.get(F.array(*map(F.lit, RULES)), F.col("kind"))).drop("kind")


def _value_of(pattern: str):
    """A match without its group 1, which stands before the value and counts as the text on the left."""

    def cut(x: Column) -> Column:
        name = F.regexp_extract(x["value"], pattern.replace("(?=@)", ""), 1)
        start, value = x["start"] + F.length(name), F.substring(x["value"], F.length(name) + 1, F.length(x["value"]))
        value = F.rtrim(value, F.lit(" \n\r\t.,;:)]}"))
        left = F.slice(F.concat(F.array(name), x["left"]), 1, 2)
        return F.struct(x["kind"].alias("kind"), start.alias("start"), (start + F.length(value)).alias("end"), value.alias("value"), left.alias("left"), x["right"].alias("right"))

    return cut


#: A character's class in the table of transitions: 1 to 26 for letters (case ignored), 27 for digits, else 0.
CLASSES = 28


def _class(c: Column) -> Column:
    code = F.ascii(c)
    return F.when(code.between(97, 122), code - 96).when(code.between(65, 90), code - 64).when(code.between(48, 57), 27).otherwise(0)


def _plain_class(c: str) -> int:
    return ord(c.lower()) - 96 if c.isascii() and c.isalpha() else 27 if c.isascii() and c.isdigit() else 0


def _plain_words(*texts: str | None) -> list[str]:
    return [w for t in texts for w in re.findall("[a-z]+", (t or "").lower())]


@dataclass(frozen=True)
class Knowledge:
    """What the labelled findings say: log odds (secret or not) of two characters in a row, and of neighbouring words."""

    transitions: tuple[float, ...]
    words: dict[str, float]

    @classmethod
    def of(cls, found: list[tuple[str, list[str], str | None, float]]) -> Knowledge:
        """From (value, left, right, label); counts have one added."""
        pairs, words = [Counter(), Counter()], [Counter(), Counter()]
        for value, left, right, label in found:
            codes = [_plain_class(c) for c in value]
            pairs[int(label)].update(a * CLASSES + b for a, b in zip(codes, codes[1:], strict=False))
            words[int(label)].update(set(_plain_words(*left, right)))
        odds = lambda x, k, n: math.log((x[1][k] + 1) / (x[1].total() + n)) - math.log((x[0][k] + 1) / (x[0].total() + n))
        size = CLASSES * CLASSES
        return cls(tuple(odds(pairs, k, size) for k in range(size)), {w: odds(words, w, len(words[0] | words[1])) for w in sorted(words[0] | words[1])})


def covered(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """found with ``known``: letters of the value that lie in runs of letters that are words of the dictionary (word).

    A run ends at a change from small to capital letters too. Runs of under WORD letters are none; equal runs of a
    value count each time. Runs meet the dictionary by an equi-join on the word.
    """
    runs = F.filter(F.regexp_extract_all("value", F.lit("[A-Z]?[a-z]+|[A-Z]+"), F.lit(0)), lambda x: F.length(x) >= WORD)
    own = found.select("doc_id", "start", "end", F.explode(F.transform(runs, F.lower)).alias("word"))
    known = own.join(dictionary.select("word"), "word").groupBy("doc_id", "start", "end").agg(F.sum(F.length("word")).alias("known"))
    return found.join(known, ["doc_id", "start", "end"], "left").withColumn("known", F.coalesce("known", F.lit(0)))


def dictionary(docs: DataFrame) -> DataFrame:
    """word: words of small letters that occur COMMON times or more in all texts, and those of the labelled findings."""
    words = docs.select(F.explode(F.filter(F.split(F.coalesce("text", F.lit("")), r"[^A-Za-z]+"), lambda w: w.rlike("^[A-Z]?[a-z]{%d,23}$" % (WORD - 1)))).alias("word"))
    common = words.select(F.lower("word").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= COMMON).select("word")
    return common.unionByName(_own_words(docs.sparkSession)).distinct()


def _own_words(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*map(F.lit, WORDS))).alias("word"))


def _features(knows: Knowledge) -> dict[str, Column]:
    """What the trees look at, of columns rule, value, left, right, path and known."""
    v, n = F.col("value"), F.length("value").cast("double")
    share = lambda chars: F.length(F.regexp_replace(v, f"[^{chars}]", "")) / n
    letters = F.regexp_replace(v, "[^A-Za-z]", "")
    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[0-9]+", "\u0001"), "[A-Z]+", "\u0002"), "[a-z]+", "\u0003"), r"[^\x01-\x03]+", "\u0004")
    flag = lambda c: F.coalesce(c.cast("double"), F.lit(0.0))
    table = F.lit(list(knows.transitions))
    codes = F.transform(F.split(v, ""), _class)
    steps = _let(codes, lambda c: F.transform(c, lambda x, i: F.when(i > 0, F.get(table, F.get(c, i - 1) * CLASSES + x)).otherwise(0.0)))
    near = F.array_distinct(F.split(F.lower(F.concat_ws(" ", F.reverse("left"), "right")), "[^a-z]+"))
    odds = F.create_map(*(F.lit(x) for pair in knows.words.items() for x in pair)) if knows.words else F.create_map(F.lit(""), F.lit(0.0))
    path = F.lower(F.coalesce("path", F.lit("")))
    return {
        "length": n,
        "digits": share("0-9"),
        "upper": share("A-Z"),
        "lower": share("a-z"),
        "other": 1 - share("A-Za-z0-9"),
        "vowels": F.length(F.regexp_replace(letters, "[^AEIOUaeiou]", "")) / F.greatest(F.length(letters), F.lit(1)),
        "changes": F.length(kinds) / n,
        "distinct": F.size(F.array_distinct(F.split(v, ""))) / n,
        "transitions": F.aggregate(steps, F.lit(0.0), lambda s, x: s + x) / F.greatest(n - 1, F.lit(1.0)),
        "known": F.col("known") / n,
        "hex": flag(v.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")),
        "uuid": flag(v.rlike("^[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$")),
        "slashes": F.length(F.regexp_replace(v, "[^/]", "")) / n,
        "dashes": F.length(F.regexp_replace(v, "[^_-]", "")) / n,
        "issued": flag(v.rlike(_ISSUED)),
        "holder": flag(v.rlike(_HOLDERS)),
        "named": flag((F.col("rule") != "token") | F.concat_ws(" ", F.reverse("left")).rlike(f"(?i)(?:{_NAMES})")),
        "assigned": flag((F.col("rule") == "url") | F.get("left", F.lit(0)).rlike("[=:][\\s\"'`]*$")),
        "block": flag(F.col("rule") == "block"),
        "neighbours": F.aggregate(F.transform(near, lambda w: F.coalesce(odds[w], F.lit(0.0))), F.lit(0.0), lambda s, x: s + x),
        "tested": flag(path.rlike(r"(?:^|[/._-])(?:tests?|specs?|examples?|samples?|fixtures?|mocks?|docs?)(?:[/._-]|$)")),
        "settings": flag(path.rlike(r"(?:^|[/._-])(?:env|conf|config|settings|credentials|secrets?|properties|ya?ml|ini|toml|pem|key)(?:[/._-]|$)")),
    }


def labelled() -> list[tuple[str, str | None, float]]:
    """(text, path, label): made-up findings, one in each text, label 1 for secrets. The test data label none.

    Most have no path; of those with one, harmless ones stand more often in tests and examples.
    """
    r, out = random.Random(SEED), []
    of = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    low, up, dig = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    hexa, mixed = dig + "abcdef", low + up + dig
    words = WORDS
    path = lambda odd: None if r.random() < 0.7 else r.choice(["tests/", "docs/", "examples/"] if r.random() < odd else ["src/", "app/", "deploy/"]) + r.choice(["a.py", "main.yaml", "settings.ini", ".env", "readme.md"])
    word = lambda n: "_".join(r.choice(words) for _ in range(n))
    name = lambda: r.choice(["token", "secret", "password", "api_key", "API-KEY", "access_key", "client_secret", "passwd", "auth_token", "pwd"])
    put = lambda v: r.choice(['{} = "{}"', "{}: {}", "{}={}", "{} = '{}'", '"{}": "{}"']).format(name(), v)
    yes = [
        lambda: put(of(hexa, r.choice([32, 40, 64]))),
        lambda: put(of(mixed, r.choice([16, 20, 24, 32, 40]))),
        lambda: put(of(mixed + "!@#$%^&*+", r.randint(9, 20))),
        lambda: put(str(uuid.UUID(int=r.getrandbits(128)))),
        lambda: put(base64.b64encode(r.randbytes(r.choice([20, 30, 45]))).decode()),
        lambda: put(r.choice(words).title() + of(dig, r.randint(2, 4)) + r.choice("!?#$") + of(mixed, 3)),
        lambda: "see " + r.choice(["AKIA", "ASIA"]) + of(up + dig, 16),
        lambda: "got " + r.choice(["ghp_", "gho_", "npm_"]) + of(mixed, 36),
        lambda: "use " + r.choice(["sk_live_", "rk_live_", "xoxb-1", "AIza", "glpat-1"]) + of(mixed, 35),
        lambda: "Bearer eyJ" + of(mixed, 20) + ".eyJ" + of(mixed, 40) + "." + of(mixed + "-_", 43),
        lambda: "text " + of(mixed, r.choice([32, 40, 48])) + " follows",
        lambda: "text " + base64.b64encode(r.randbytes(r.choice([30, 48]))).decode() + " follows",
        lambda: f"postgres://{r.choice(words)}:{of(mixed, r.randint(8, 20))}@host/db",
        lambda: "-----BEGIN RSA PRIVATE KEY-----\n" + base64.b64encode(r.randbytes(90)).decode() + "\n-----END",
    ]
    no = [
        lambda: "commit " + of(hexa, 40) + " merged",
        lambda: "sha256 " + of(hexa, 64),
        lambda: "id " + str(uuid.UUID(int=r.getrandbits(128))),
        lambda: put(r.choice(words) + r.choice(words)),
        lambda: put(r.choice(["example", "changeme", "your_key_here", "xxxxxxxxxxxx", "${TOKEN}", "required", "optional", "<none>-none", "********", "placeholder", "string_value"])),
        lambda: put("your-" + word(2) + "-here"),
        lambda: "the " + name() + " " + r.choice(words) + r.choice(words) + " is set",
        lambda: "see " + word(3) + "_" + of(dig, r.randint(1, 4)),
        lambda: "at " + f"20{of(dig, 2)}-0{r.randint(1, 9)}-1{r.randint(0, 9)}T12-{of('012345', 2)}-{of('012345', 2)}",
        lambda: "call " + "-".join(of(dig, 4) for _ in range(4)),
        lambda: "order " + of(dig, r.randint(16, 24)),
        lambda: "in /" + "/".join(r.choice(words) for _ in range(4)) + of(dig, 2),
        lambda: f"http://user:{r.choice(['password', 'example', 'changeme', 'xxxxxxxx'])}@host/",
        lambda: "== " + "-" * r.randint(10, 20) + "1" + "=" * r.randint(5, 20),
        lambda: "see " + r.choice(words) * 3 + of(dig, 1) + r.choice(words) * 2,
    ]
    for make in yes:
        out += [(make(), path(0.2), 1.0) for _ in range(EACH)]
    for make in no:
        out += [(make(), path(0.6), 0.0) for _ in range(EACH)]
    return out


def _node(node) -> tuple | float:
    """A fitted tree as plain values: (feature, threshold, left, right), or the vote."""
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    return int(node.split().featureIndex()), float(node.split().threshold()), _node(node.leftChild()), _node(node.rightChild())


@dataclass(frozen=True)
class Forest:
    """What the labelled findings say, and the trees fitted on them."""

    knows: Knowledge
    trees: tuple[tuple | float, ...]


@functools.cache
def _fitted() -> list[Forest]:
    return []


def forest(spark: SparkSession) -> Forest:
    """Fitted on the labelled findings, once a process; findings and seed are the same in each session.

    The findings are a bounded table (EACH of each sort), so the driver may hold it.
    """
    if not _fitted():
        rows = spark.createDataFrame([(i, t, p, y) for i, (t, p, y) in enumerate(labelled())], "doc_id long, text string, path string, y double").coalesce(1)
        found = covered(candidates(rows), _own_words(spark)).join(rows.select("doc_id", "y"), "doc_id").coalesce(1).sortWithinPartitions("doc_id", "start")
        knows = Knowledge.of([(r["value"], r["left"], r["right"], r["y"]) for r in found.collect()])
        names = _features(knows)
        data = found.select("y", *(c.cast("double").alias(k) for k, c in names.items()))
        data = VectorAssembler(inputCols=list(names), outputCol="features").transform(data).select("y", "features")
        model = RandomForestClassifier(labelCol="y", numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird").fit(data)
        _fitted().append(Forest(knows, tuple(_node(t._java_obj.rootNode()) for t in model.trees)))
    return _fitted()[0]


def _vote(tree: tuple | float, names: list[str]) -> Column:
    if isinstance(tree, float):
        return F.lit(int(tree))
    at, threshold, left, right = tree
    return F.when(F.col(names[at]) <= threshold, _vote(left, names)).otherwise(_vote(right, names))


def secrets(docs: DataFrame, staging: Staging) -> DataFrame:
    """doc_id, rule, start, end, votes of every candidate in documents (doc_id, text, path); secret where votes win.

    The forest looks at the value's length, its kinds of characters and their transitions, how much of it the
    dictionary of all texts covers, the file's path where documents have that column, and the words beside it. Places
    count code points of the whole text, end exclusive, and are those of the value without its name. Null or empty
    texts, and tables without rows, have none. Every candidate of every text is scored, however long the text.
    doc_ids must not repeat; other columns are ignored.
    """
    grown = forest(docs.sparkSession)
    found = staging.save(candidates(docs), "candidates")
    names = _features(grown.knows)
    rows = covered(found, dictionary(docs)).select("doc_id", "rule", "start", "end", *(c.cast("double").alias(f"f_{k}") for k, c in names.items()))
    votes = functools.reduce(lambda a, b: a + b, (_vote(t, [f"f_{k}" for k in names]) for t in grown.trees))
    return rows.select("doc_id", "rule", "start", "end", votes.alias("votes")).withColumn("secret", F.col("votes") * 2 > TREES)


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_candidates, n_secrets, spans (rule:start:end of secrets): one row for every document.

    Repeated doc_ids count once, with their smallest text. The test documents have no path.
    """
    return scanned(one_per_id(table(spark, sf_dir, "documents"), "doc_id", "text"), Staging(spark, "op5"))


def scanned(docs: DataFrame, staging: Staging) -> DataFrame:
    entry = F.when(F.col("secret"), F.struct("start", "end", F.concat_ws(":", "rule", "start", "end").alias("t")))
    of = secrets(docs, staging).groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"), F.count(F.when(F.col("secret"), 1)).alias("s"), F.array_sort(F.collect_list(entry)).alias("a"))
    zero = F.lit(0).cast("long")
    out = docs.select("doc_id").join(of, "doc_id", "left")
    joined = F.coalesce(F.concat_ws(",", F.transform("a", lambda x: x["t"])), F.lit(""))
    return out.select("doc_id", F.coalesce("c", zero).alias("n_candidates"), F.coalesce("s", zero).alias("n_secrets"), joined.alias("spans"))
