"""Personal data: base patterns, and contexts bootstrapped from them, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Staging, one_per_id, table

#: The kinds, in the order of the results. Possessive forms match the same as greedy ones here, in bounded stack; a
#: run of e-mail or number characters is tried from its start alone (or from the end of the last match).
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What may be an identifier that no base pattern knows: a token with '@' or '(at)' inside, or tokens with a digit,
#: joined by single spaces.
_MAIL = r"(?=[\w.%+/#()-]*?[\w.%+-](?:@|\(at\))\w)"
_DIGIT = r"(?=[A-Za-z._%+@/#()-]*+[0-9])"
CANDIDATE = rf"(?<![\w.%+@/#()-])(?:{_MAIL}[\w.%+@/#()-]++|{_DIGIT}[\w.%+@/#()-]++(?:\x20(?!{_MAIL}){_DIGIT}[\w.%+@/#()-]++)*+)"
#: A context counts once so many different identifiers of a kind stand in it, and so much of what stands in it, but for
#: unknown candidates that may be of that kind, is of it.
SUPPORT, CONFIDENCE = 5, 0.9
#: Numbers added up in one go, and code points of a text redacted in one go: arrays and texts grow by copying, so a
#: longer one is built from runs of these sizes. They bound time and memory, never what is handled.
SUM_RUN, TEXT_RUN = 64, 4096
FOUND = "array<struct<kind:string,start:int,end:int,value:string,left:array<string>,right:string>>"


def _let(value: Column, then) -> Column:
    """then(value), with the value worked out once: a lambda's variable stands for it wherever it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def running_sums(values: Column) -> Column:
    """Sums of an array<long> up to each place, in runs whose own sums are then added up likewise."""
    zero = F.lit(0).cast("long")

    def within(run: Column) -> Column:
        begin = F.struct(zero.alias("s"), F.array().cast("array<long>").alias("all"))
        return F.aggregate(run, begin, lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["all"], F.array(acc["s"] + x)).alias("all")))

    def runs(of: Column) -> Column:
        places = F.when(F.size(of) > 0, F.sequence(F.lit(0), F.floor((F.size(of) - 1) / SUM_RUN).cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: within(F.slice(of, i * SUM_RUN + 1, SUM_RUN)))

    def carried(parts: Column, sums: Column) -> Column:
        """The sums of all parts, each with what the parts before it add up to."""
        return F.flatten(F.transform(parts, lambda p, i: F.transform(p["all"], lambda x: x + F.when(i > 0, F.get(sums, i - 1)).otherwise(zero))))

    totals = lambda parts: F.transform(parts, lambda p: p["s"])
    above = lambda parts: _let(totals(parts), lambda of: _let(runs(of), lambda up: _let(within(totals(up))["all"], lambda top: carried(up, top))))
    return _let(values, lambda of: _let(runs(of), lambda parts: _let(above(parts), lambda sums: carried(parts, sums))))


def _matches(text: Column, words: Column, kind: str, pattern: str) -> Column:
    """Array FOUND of the matches of a pattern: places in code points, end exclusive, and the words around.

    words: the text split at white space. left: what stands before the match within its word, if anything, then the
    words before, nearest first, two in all; right: what stands after it within its word, or the next word. They
    depend on the text and the match's place and value alone, not on what else the pattern matches.
    """
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.filter(F.zip_with(found, between, lambda m, p: F.struct(m.alias("m"), p.alias("p"))), lambda x: x["m"].isNotNull())
    # code points in the low half, runs of white space in the high half
    weigh = lambda x: F.length(x).cast("long") + F.regexp_count(x, F.lit(r"\s+")).cast("long") * F.lit(1 << 32)
    point, word = lambda x: x.bitwiseAND(0xFFFFFFFF).cast("int"), lambda x: F.shiftright(x, 32).cast("int")
    word_at = lambda i: F.coalesce(F.get(words, i), F.lit(""))
    cut_at = lambda w, at, side: F.call_function("substring_index", w, at, F.lit(side))

    def one(m: Column, begin: Column, end: Column) -> Column:
        first, last = word(begin), word(end)
        glued = cut_at(word_at(first), F.get(F.split(m, r"\s+", 2), F.lit(0)), 1)
        after = cut_at(word_at(last), F.regexp_extract(m, r"\S+$", 0), -1)
        left = F.filter(F.array(glued, word_at(first - 1), word_at(first - 2)), lambda w: w != "")
        right = F.when(after != "", after).otherwise(word_at(last + 1))
        return F.struct(F.lit(kind).alias("kind"), point(begin).alias("start"), point(end).alias("end"), m.alias("value"), F.slice(left, 1, 2).alias("left"), right.alias("right"))

    def placed(own: Column) -> Column:
        sums = running_sums(F.flatten(F.transform(own, lambda x: F.array(weigh(x["p"]), weigh(x["m"])))))
        return _let(sums, lambda at: F.transform(own, lambda y, i: one(y["m"], F.get(at, 2 * i), F.get(at, 2 * i + 1))))

    return _let(pairs, placed)


def split_words(text: Column) -> Column:
    return F.split(text, r"\s+")


def _is_valid() -> Column:
    """Whether a base match passes its check."""
    digits = F.regexp_replace("value", "[^0-9]", "")
    parts_fit = F.forall(F.split("value", r"\."), lambda p: p.rlike("^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    turned = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda s, i: s + F.when(i % 2 == 1, F.substring(turned, i, F.lit(1))).otherwise(F.substring(F.translate(turned, "0123456789", "0246813579"), i, F.lit(1))).cast("int"),
    )
    return (
        F.when(F.col("kind") == "ip", parts_fit)
        .when(F.col("kind") == "card", F.length(digits).between(16, 19) & F.when(F.length(digits).between(16, 19), total % 10 == 0).otherwise(False))
        .when(F.col("kind") == "phone", F.length(digits).between(8, 15))
        .otherwise(True)
    )


def _shape_of(kind: str) -> Column:
    """Whether a candidate can be of the kind at all."""
    digits = F.length(F.regexp_replace("value", "[^0-9]", ""))
    plain = ~F.col("value").rlike(r"[^0-9 ()./+-]")
    return {
        "email": F.col("value").rlike(r"@|\(at\)"),
        "ip": F.col("value").rlike(r"^[0-9]+(?:\.[0-9]+){3}$") | F.col("value").rlike(r"^[0-9]+-[0-9]+-[0-9]+-[0-9]+$"),
        "card": plain & digits.between(12, 19),
        "phone": plain & digits.between(7, 15),
    }[kind]


def instances(docs: DataFrame) -> DataFrame:
    """doc_id, kind, start, end, value, left, right: valid base matches, and candidates (kind empty) apart from them."""
    texts = docs.where("text IS NOT NULL").select("doc_id", "text", split_words(F.col("text")).alias("words"))
    gate = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+")), "ip": F.col("text").rlike(r"[0-9]\.[0-9]")}
    empty = F.array().cast(FOUND)
    found = [F.when(gate.get(kind, F.col("text").rlike("[0-9]")), _matches(F.col("text"), F.col("words"), kind, pattern)).otherwise(empty) for kind, pattern in PATTERNS.items()]
    found.append(F.when(F.col("text").rlike(r"[0-9@]|\(at\)"), _matches(F.col("text"), F.col("words"), "", CANDIDATE)).otherwise(empty))
    # explode_outer: explode lets the optimizer copy all this into a filter, and the splitting of words into its loops
    rows = texts.select("doc_id", F.explode_outer(F.concat(*found)).alias("x")).where("x IS NOT NULL").select("doc_id", "x.*")
    return rows.withColumn("valid", _is_valid()).where("valid").drop("valid")


def _contexts(rows: DataFrame) -> DataFrame:
    """doc_id, kind, start, end, value, shapes, context: the word to the left, the two there, and the ones at both sides."""
    one, two, right = F.lower(F.get("left", F.lit(0))), F.lower(F.concat_ws(" ", F.get("left", F.lit(1)), F.get("left", F.lit(0)))), F.lower("right")
    contexts = F.array(F.concat(F.lit("1 "), one), F.when(F.size("left") > 1, F.concat(F.lit("2 "), two)), F.when(right != "", F.concat(F.lit("3 "), one, F.lit(" _ "), right)))
    return rows.where(F.size("left") > 0).select("doc_id", "kind", "start", "end", "value", "shapes", F.explode(F.array_compact(contexts)).alias("context"))


def _apart(found: DataFrame) -> DataFrame:
    """Candidates that overlap no base match, by the furthest end of the base matches that begin before theirs."""
    base = F.col("kind") != ""
    order = Window.partitionBy("doc_id").orderBy(F.when(base, F.col("start")).otherwise(F.col("end")), base).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reach = found.withColumn("reach", F.max(F.when(base, F.col("end"))).over(order))
    return reach.where(~base & (F.coalesce("reach", F.lit(0)) <= F.col("start"))).drop("reach")


def bootstrap(found: DataFrame, staging: Staging) -> DataFrame:
    """doc_id, kind, start, end: identifiers that contexts of base matches point to.

    Contexts and identifiers form a two-sided graph. A context's score for a kind is the share of what is held to be
    of that kind in what is held so or contradicts it: identifiers of other kinds, and candidates whose shape it cannot
    be. Unknown candidates of a fitting shape count neither way. A context speaks only once SUPPORT different values
    back it with CONFIDENCE. A candidate takes the kind of its best such context, if its shape allows, for good, and
    counts for its contexts in the next round, until a round finds none. Rounds are joins and sums that combine before
    the shuffle, so a context as frequent as 'the' is one row for each task. Candidates that overlap a base match are
    none.
    """
    shapes = F.array_compact(F.array(*(F.when(_shape_of(k), F.lit(k)) for k in PATTERNS)))
    free = _apart(found).withColumn("shapes", shapes)
    edges = staging.save(_contexts(free.unionByName(found.where("kind <> ''").withColumn("shapes", F.array().cast("array<string>")))), "edges")
    against = lambda k: F.when(F.col("kind") == "", ~F.array_contains("shapes", k)).otherwise(F.col("kind") != k)
    total = edges.groupBy("context").agg(F.map_from_arrays(F.array(*map(F.lit, PATTERNS)), F.array(*(F.count_if(against(k)) for k in PATTERNS))).alias("against"))
    columns = ["context", "kind", "value"]
    counts = edges.where("kind <> ''").groupBy(*columns).agg(F.count(F.lit(1)).alias("c"))
    taken, turn = None, 0
    while True:
        score = counts.groupBy("context", "kind").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("values"))
        good = score.where(F.col("values") >= SUPPORT).join(total, "context").withColumn("score", F.col("c") / (F.col("c") + F.col("against")[F.col("kind")])).where(F.col("score") >= CONFIDENCE)
        good = staging.save(good.select("context", F.col("kind").alias("as"), "score"), f"contexts{turn}")
        best = edges.where("kind = ''").join(good, "context").where(F.array_contains("shapes", F.col("as")))
        if taken is not None:
            best = best.join(taken, ["doc_id", "start", "end"], "left_anti")
        best = best.groupBy("doc_id", "start", "end").agg(F.max(F.struct("score", "as")).alias("top"))
        new = staging.save(best.select("doc_id", "start", "end", F.col("top.as").alias("kind")), f"taken{turn}")
        if new.isEmpty():
            return new if taken is None else taken
        taken = new if taken is None else taken.unionByName(new)
        more = edges.where("kind = ''").drop("kind").join(new, ["doc_id", "start", "end"]).groupBy(*columns).agg(F.count(F.lit(1)).alias("c"))
        counts = staging.save(counts.unionByName(more).groupBy(*columns).agg(F.sum("c").alias("c")), f"counts{turn}")
        turn += 1


def personal_data(docs: DataFrame, staging: Staging) -> DataFrame:
    """doc_id, kind, start, end, base for every span of personal data in documents (doc_id, text).

    Base spans are the matches of PATTERNS that pass their checks; others (base false) come from contexts. Places
    count code points and are those of the whole text, however long; the work grows with its length. Null or empty
    texts have none. Spans of different kinds may overlap. doc_ids must not repeat; other columns are ignored.
    """
    found = staging.save(instances(docs), "instances")
    more = bootstrap(found, staging)
    return found.where("kind <> ''").select("doc_id", "kind", "start", "end", F.lit(True).alias("base")).unionByName(more.select("doc_id", "kind", "start", "end", F.lit(False).alias("base")))


def digest(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans: one row for each document."""
    place = F.array_position(F.array(*map(F.lit, PATTERNS)), F.col("kind"))
    text = F.concat_ws(":", "kind", "start", "end")
    entry = F.struct(place.alias("k"), "start", "end", text.alias("t"))
    of = spans.groupBy("doc_id").agg(
        *(F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in PATTERNS),
        F.array_sort(F.collect_list(F.when(F.col("base"), entry))).alias("b"),
        F.array_sort(F.collect_list(entry)).alias("a"),
    )
    joined = {c: F.concat_ws(",", F.transform(c, lambda x: x["t"])) for c in ("b", "a")}
    of = of.select("doc_id", *(f"n_{k}" for k in PATTERNS), F.sha2(joined["b"], 256).alias("base_sha256"), joined["a"].alias("spans"))
    out = docs.select("doc_id").join(of, "doc_id", "left")
    return out.select("doc_id", *(F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in PATTERNS), F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def _joined(spans: DataFrame) -> DataFrame:
    """doc_id, start, end, kind: overlapping spans as one, named after the first."""
    order = Window.partitionBy("doc_id").orderBy("start", "end", "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("start") < F.col("reach"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = spans.select("doc_id", "start", "end", "kind").withColumn("reach", reach).withColumn("island", island)
    first = rows.groupBy("doc_id", "island").agg(F.min(F.struct("start", "end", "kind")).alias("first"), F.max("end").alias("end"))
    return first.select("doc_id", "first.start", "end", "first.kind")


def redacted(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """documents whose spans are replaced by ``<kind>``; overlapping spans become one, named after the first.

    A text is cut into runs of TEXT_RUN code points, and each run is redacted by itself. All columns stay, whatever
    their names; rows without a span, null and empty texts pass unchanged.
    """
    runs = F.sequence(F.floor(F.col("start") / TEXT_RUN).cast("int"), F.floor((F.col("end") - 1) / TEXT_RUN).cast("int"))
    cut = _joined(spans).select("doc_id", "start", "end", "kind", F.explode(runs).alias("run"))
    low, high = F.col("start") - F.col("run") * TEXT_RUN, F.col("end") - F.col("run") * TEXT_RUN
    name = F.when(low >= 0, F.concat(F.lit("<"), F.col("kind"), F.lit(">"))).otherwise("")
    cut = cut.select("doc_id", "run", F.struct(F.greatest(low, F.lit(0)).alias("s"), F.least(high, F.lit(TEXT_RUN)).alias("e"), name.alias("name")).alias("x"))
    cut = cut.groupBy("doc_id", "run").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    cut = cut.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("run", "xs"))).alias("cuts"))
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.struct(*(F.col(c) for c in docs.columns)).alias("row")).join(cut, "doc_id", "left")
    text = F.col("row.text")

    def within(part: Column, xs: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            out = F.concat(acc["out"], F.substring(part, acc["at"] + 1, x["s"] - acc["at"]), x["name"])
            return F.struct(x["e"].alias("at"), out.alias("out"))

        done = F.aggregate(xs, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.substring(part, acc["at"] + 1, F.length(part))))
        return F.when(xs.isNull(), part).otherwise(done)

    parts = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % TEXT_RUN), F.lit(0))
    new = F.when(F.col("cuts").isNull(), text).otherwise(F.array_join(F.transform(parts, lambda part, i: within(part, F.col("cuts")[i])), ""))
    return rows.select(*((new if c == "text" else F.col("row").getField(c)).alias(c) for c in docs.columns))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    docs = one_per_id(table(spark, sf_dir, "documents"), "doc_id", "text")
    return digest(docs, personal_data(docs, Staging(spark, "op3")))
