"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Seeds are the spans of four exact kinds (email, ip, card, phone) that pass their
checks.  Each seed induces two lexical patterns: its shape (runs of letters
and each digit generalised) and the word before it.  Candidates are windows of up to
WINDOW neighbouring words with digits or an at-sign that no seed covers.  Patterns and instances (the
texts of seeds and candidates) form a bipartite graph: a pattern's confidence is the mean score of its
distinct instances, an instance's score follows from the confidence of its patterns, and seeds stay
at 1; ROUNDS rounds of both are aggregations and joins.  A candidate whose shape is confident and has
LEAST_SEEDS seeds, whose score is high and which passes the checks of its kind is an identifier that the
exact rules had missed (such as a phone number that runs into a card number).
Words before that are confident by themselves (LEAST_SEEDS distinct seeds of a kind, and
LEAST_CONFIDENCE of all seeds and failing places after the word) propose windows of any shape; they hold if they pass
the stricter check of resembles().

Edge cases: null text is an empty text, without spans (and stays null when redacted); very long texts are searched as
a whole, and the expressions cannot backtrack over a run of characters more than once; repeated rows give
equal results; of added spans that begin together the one of a known shape, then the longest is taken; rows without an id are told apart by their
text; an empty table gives no rows; other columns, whatever their names, are ignored (and kept by ``redact``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

KINDS = ("email", "ip", "card", "phone")
#: The contract's expressions. A match can only begin where a run begins or the last match ended, which is said here so that the search is linear.
EXPRESSIONS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
BLANK = r"\x20\x09-\x0D"
#: A word with a digit or an at-sign.
MARKED = rf"(?<![^{BLANK}])[^{BLANK}0-9@]*+[0-9@][^{BLANK}]*+"
WINDOW = 6
ROUNDS = 3
LEAST_SEEDS = 5
LEAST_CONFIDENCE = 0.8
#: Rows of the hottest pattern are dealt to this many tasks.
SALTS = 16

SPAN = "struct<start:int,kind:int,stop:int,value:string>"


def located(text: Column, expression: str) -> Column:
    """array<struct<start, stop, value>> of the expression's matches, in code points."""
    found = F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    between = F.split(text, expression, -1)
    pairs = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda m, b: F.struct(m.alias("value"), F.length(b).alias("gap")))
    empty = F.array().cast("array<struct<start:int,stop:int,value:string>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + F.length(x["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(begin.alias("start"), end.alias("stop"), x["value"].alias("value")))).alias("out"))

    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    at = F.sequence(F.lit(1), F.greatest(F.length(number), F.lit(1)))
    reverse = F.reverse(number)

    def part(i: Column) -> Column:
        d = F.coalesce(F.substring(reverse, i, F.lit(1)).try_cast("int"), F.lit(0)) * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.transform(at, part), F.lit(0), lambda a, x: a + x) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    """The check of a kind's match."""
    number = digits(value)
    if kind == "ip":
        short = lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(value, r"\."), short)
    if kind == "card":
        return F.length(number).between(14, 19) & F.when(F.length(number).between(14, 19), luhn(number)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(number).between(10, 15)
    return F.lit(True)


def resembles(kind: str, value: Column) -> Column:
    """The check of a window of any shape: what passes() asks, and what the kind's expression implies."""
    if kind == "email":
        return value.rlike(r"^[^@]*[A-Za-z0-9][^@]*@[^@]*[A-Za-z0-9][^@]*[^A-Za-z0-9@]+[A-Za-z]{2,}[^@A-Za-z0-9]*$")
    plain = ~value.rlike(r"[\p{L}@]")
    if kind == "ip":
        parts = F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0))
        return plain & (F.size(parts) == 4) & passes("ip", F.array_join(parts, "."))
    return plain & passes(kind, value)


def spans_of_kind(text: Column, i: int) -> Column:
    ok = F.filter(located(text, EXPRESSIONS[KINDS[i]]), lambda m: passes(KINDS[i], m["value"]))
    return F.transform(ok, lambda m: F.struct(m["start"].alias("start"), F.lit(i).alias("kind"), m["stop"].alias("stop"), m["value"].alias("value")))


def count_of_kind(spans: Column, i: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == i)).cast("long")


def base_spans(text: Column) -> Column:
    """array<struct<start, kind (its place in KINDS), stop, value>> of the exact rules, by start and kind."""
    out = []
    for i, kind in enumerate(KINDS):
        spans = spans_of_kind(text, i)
        needs = F.contains(text, F.lit("@")) if kind == "email" else F.contains(text, F.lit("+")) if kind == "phone" else F.lit(True)
        out.append(F.when(needs, spans).otherwise(F.array().cast(f"array<{SPAN}>")))
    return F.array_sort(F.concat(*out))


def as_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat(F.element_at(names, s["kind"] + 1), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["stop"].cast("string"))), ",")


def shape(value: Column) -> Column:
    """Letters in runs as 'a', each digit as '9' (in runs, beside letters or in an email)."""
    plain = F.regexp_replace(F.regexp_replace(value, r"[\p{L}_]+", "a"), "[0-9]", "9")
    return F.when(F.contains(plain, F.lit("a")), F.regexp_replace(plain, "9+", "9")).when(value.rlike(r"^[0-9]+(\.[0-9]+)+$"), F.regexp_replace(plain, "9+", "9")).otherwise(plain)


def words_before(text: Column, start: Column) -> Column:
    """The word before a position, in lower case; '' at the start."""
    return F.lower(F.regexp_extract(F.substring(text, F.greatest(start - 63, F.lit(1)), F.least(start, F.lit(64))), rf"([^{BLANK}]+)[{BLANK}]+$", 1))


def find(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans, added) of the rows that may have spans: exact ones and what their patterns discover."""
    marked = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).filter(F.col("text").rlike("[0-9@]"))
    keyed = marked.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    spans = keyed.select("doc_id", "text_key", "text", base_spans(F.col("text")).alias("spans"), located(F.col("text"), MARKED).alias("words"))
    free = F.filter("words", lambda w: ~F.exists("spans", lambda s: (s["start"] <= w["start"]) & (w["stop"] <= s["stop"])))
    spans = spans.withColumn("words", free)
    before = lambda at: words_before(F.col("text"), at)
    spans = spans.withColumn("seeds", F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["value"].alias("value"), before(s["start"]).alias("before"))))
    spans = spans.withColumn("windows", windows(F.col("text"), F.col("words"), F.col("spans")))
    found = materialize(spans.select("doc_id", "text_key", "spans", "seeds", "windows"), "pii-spans")

    seeds = found.select(F.inline("seeds")).select("kind", "value", shape(F.col("value")).alias("shape"), "before").distinct()
    candidates = found.select("doc_id", "text_key", "spans", F.explode("windows").alias("w")).select("doc_id", "text_key", "spans", "w.*")
    candidates = candidates.withColumn("shape", shape(F.col("value"))).distinct()
    shapes = seeds.groupBy("kind", "shape").agg(F.count_distinct("value").alias("n")).filter(F.col("n") >= LEAST_SEEDS).select("kind", "shape")
    ok = F.lit(False)
    for i, kind in enumerate(KINDS):
        ok = ok | ((F.col("kind") == i) & passes(kind, F.col("value")))
    possible = materialize(candidates.join(shapes.hint("merge"), "shape"), "pii-candidates")
    accepted = scored(seeds, possible.select("kind", "value", "shape", "before", ok.alias("checks")).distinct())
    new = possible.filter(ok).join(accepted.hint("merge"), ["kind", "value", "shape", "before"], "left_semi").withColumn("by", F.lit(0))
    new = new.select("doc_id", "text_key", "by", "start", "stop", "kind", "value").unionByName(proposed(seeds, candidates))
    # of the windows that overlap, the first one holds, then one of a known shape, then the longest
    listed = new.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("start", "by", (-F.col("stop")).alias("back"), "kind", "value"))).alias("new"))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
    chosen = F.aggregate(
        "new", empty,
        lambda acc, x: F.when(x["start"] >= acc["at"], F.struct((-x["back"]).alias("at"), F.concat(acc["out"], F.array(F.struct(x["start"].alias("start"), x["kind"].alias("kind"), (-x["back"]).alias("stop"), x["value"].alias("value")))).alias("out"))).otherwise(acc),
        lambda acc: acc["out"],
    )
    listed = listed.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), chosen.alias("added"))
    rows = found.select("doc_id", "text_key", "spans").distinct()
    listed = listed.hint("merge")
    joined = rows.join(listed, rows["doc_id"].eqNullSafe(listed["d"]) & (rows["text_key"] == listed["k"]), "left")
    return joined.select("doc_id", "text_key", "spans", F.coalesce("added", F.array().cast(f"array<{SPAN}>")).alias("added"))


def windows(text: Column, words: Column, spans: Column) -> Column:
    """array<struct<start, stop, value, before>>: up to WINDOW words in a row, each a blank apart, without the punctuation around them and clear of the spans."""
    at = F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1)))

    def one(i: Column, n: int) -> Column:
        first, last = F.try_element_at(words, i), F.try_element_at(words, i + (n - 1))
        apart = last["stop"] - first["start"] - F.aggregate(F.slice(words, i, F.lit(n)), F.lit(0), lambda a, w: a + w["stop"] - w["start"])
        raw = F.substring(text, first["start"] + 1, last["stop"] - first["start"])
        lead = F.length(raw) - F.length(F.regexp_replace(raw, r"^[^\p{L}0-9+(]+", ""))
        value = F.regexp_replace(F.regexp_replace(raw, r"^[^\p{L}0-9+(]+", ""), r"[^\p{L}0-9)]+$", "")
        start = first["start"] + lead
        made = F.struct(start.alias("start"), (start + F.length(value)).alias("stop"), value.alias("value"), words_before(text, first["start"]).alias("before"))
        return F.when((i + (n - 1) <= F.size(words)) & (apart == n - 1) & (F.length(value) > 4), made)

    made = F.flatten(F.transform(at, lambda i: F.array(*[one(i, n) for n in range(1, WINDOW + 1)])))
    clear = F.filter(made, lambda w: w.isNotNull() & ~F.exists(spans, lambda s: (s["start"] < w["stop"]) & (w["start"] < s["stop"])))
    return F.when(F.size(words) > 0, clear).otherwise(F.array().cast("array<struct<start:int,stop:int,value:string,before:string>>"))


def proposed(seeds: DataFrame, candidates: DataFrame) -> DataFrame:
    """(doc_id, text_key, by, start, stop, kind, value): windows of any shape after words that are confident for their kind."""
    places = range(len(KINDS))
    checked = candidates.filter(F.col("before") != "").select("doc_id", "text_key", "start", "stop", "value", "before", *[resembles(k, F.col("value")).alias(f"ok{i}") for i, k in enumerate(KINDS)])
    # a place fails for a kind if none of the windows that begin there passes; equal ones count once
    place = checked.groupBy("doc_id", "text_key", "start", "before").agg(F.min_by("value", "stop").alias("value"), *[F.bool_or(f"ok{i}").alias(f"ok{i}") for i in places])
    failed = place.groupBy("before", "value").agg(*[F.bool_and(f"ok{i}").alias(f"ok{i}") for i in places])
    failed = failed.groupBy("before").agg(*[F.count_if(~F.col(f"ok{i}")).alias(f"failed{i}") for i in places])
    known = seeds.filter(F.col("before") != "").select("kind", "value", "before").distinct().groupBy("before").agg(F.count("*").alias("all"), *[F.count_if(F.col("kind") == i).alias(f"n{i}") for i in places])
    words = known.join(failed.withColumnRenamed("before", "b").hint("merge"), F.col("before") == F.col("b"), "left")
    sure = [(F.col(f"n{i}") >= LEAST_SEEDS) & (F.col(f"n{i}") >= LEAST_CONFIDENCE * (F.col("all") + F.coalesce(f"failed{i}", F.lit(0)))) for i in places]
    kinds = F.filter(F.array(*[F.when(c, F.lit(i)) for i, c in enumerate(sure)]), lambda k: k.isNotNull())
    words = words.select("before", F.explode(kinds).alias("kind"))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
    fine = F.filter(F.array(*[F.when(F.col(f"ok{i}"), F.lit(i)) for i in places]), lambda k: k.isNotNull())
    passed = checked.select("doc_id", "text_key", "start", "stop", "value", "before", F.explode(fine).alias("kind")).withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(SALTS)))
    return passed.join(words.select("*", salts).hint("merge"), ["before", "kind", "salt"], "left_semi").select("doc_id", "text_key", F.lit(1).alias("by"), "start", "stop", "kind", "value")


def scored(seeds: DataFrame, candidates: DataFrame) -> DataFrame:
    """Distinct candidates (kind, value, shape, before) that the scores of the pattern-instance graph accept."""
    nodes = seeds.select("kind", "value", "shape", "before", F.lit(True).alias("seed"), F.lit(1.0).alias("score"))
    known = seeds.select("kind", "value").distinct().hint("merge")
    other = candidates.join(known, ["kind", "value"], "left_anti").select("kind", "value", "shape", "before", F.lit(False).alias("seed"), F.lit(0.0).alias("score"), "checks")
    again = candidates.join(known, ["kind", "value"], "left_semi").select("kind", "value", "shape", "before")  # a known instance in another place
    # a candidate that fails its kind's check speaks against its patterns
    graph = materialize(nodes.withColumn("checks", F.lit(True)).unionByName(other), "pii-graph")
    for _ in range(ROUNDS):
        by_shape = graph.groupBy("kind", "shape").agg(F.avg("score").alias("shape_conf"), F.count_if("seed").alias("n_seeds"))
        by_word = graph.groupBy("kind", "before").agg(F.avg("score").alias("word_conf"))
        salted = graph.drop("shape_conf", "n_seeds").withColumn("salt", F.pmod(F.xxhash64("value"), F.lit(SALTS)))
        salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt")
        joined = salted.join(by_shape.select("*", salts).hint("merge"), ["kind", "shape", "salt"]).join(by_word.select("*", salts).hint("merge"), ["kind", "before", "salt"])
        score = F.when(~F.col("checks"), 0.0).otherwise(1 - (1 - F.col("shape_conf")) * (1 - F.col("word_conf") / 2))
        joined = joined.withColumn("score", F.when(F.col("seed"), 1.0).otherwise(score))
        graph = materialize(joined.select("kind", "value", "shape", "before", "seed", "score", "checks", "shape_conf", "n_seeds"), "pii-graph")
    sure = (F.col("shape_conf") >= LEAST_CONFIDENCE) & (F.col("n_seeds") >= LEAST_SEEDS)
    found = graph.filter(~F.col("seed") & F.col("checks") & sure & (F.col("score") >= LEAST_CONFIDENCE)).select("kind", "value", "shape", "before")
    return found.unionByName(again).distinct()


def all_spans(spans: Column, added: Column) -> Column:
    return F.array_sort(F.concat(spans, added))


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document; the counts and the digest are of the exact rules."""
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    found = find(docs.select("doc_id", "text")).withColumnRenamed("doc_id", "d").withColumnRenamed("text_key", "k")
    found = found.hint("merge")
    joined = keyed.join(found, keyed["doc_id"].eqNullSafe(found["d"]) & (keyed["text_key"] == found["k"]), "left")
    none = F.array().cast(f"array<{SPAN}>")
    base, added = F.coalesce("spans", none), F.coalesce("added", none)
    counts = [count_of_kind(base, i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return joined.select("doc_id", *counts, F.sha2(as_text(base), 256).alias("base_sha256"), as_text(all_spans(base, added)).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in capitals and brackets; other columns, rows and texts stay.

    Only rows that may have a span, those with a digit or an at-sign, are shuffled with their texts.
    """
    found = find(docs.select("doc_id", "text")).select(F.col("doc_id").alias("_pii_d"), F.col("text_key").alias("_pii_k"), all_spans(F.col("spans"), F.col("added")).alias("_pii_spans")).filter(F.size("_pii_spans") > 0).hint("merge")
    marked = F.coalesce("text", F.lit("")).rlike("[0-9@]")
    asked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_pii_row"), F.col("doc_id").alias("_pii_id"), F.coalesce("text", F.lit("")).alias("_pii_text")).filter(F.col("_pii_text").rlike("[0-9@]"))
    joined = asked.join(found, F.col("_pii_id").eqNullSafe(F.col("_pii_d")) & (F.xxhash64("_pii_text") == F.col("_pii_k")), "left")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col("_pii_text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        outside = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.element_at(names, s["kind"] + 1))
        # a span that begins within the last one only moves its end
        return F.when(s["start"] >= acc["at"], F.struct(s["stop"].alias("at"), outside.alias("out"))).otherwise(F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["out"].alias("out")))

    clean = F.aggregate("_pii_spans", start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    new = F.when(F.col("_pii_spans").isNotNull(), clean).otherwise(text)
    return docs.filter(~marked).unionByName(joined.select(*[new.alias(c) if c == "text" else F.col("_pii_row")[c].alias(c) for c in docs.columns]))
