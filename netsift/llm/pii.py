"""Personal data by fixed patterns plus bootstrapped contextual extraction, in DataFrame operations only.

Fixed patterns give the base spans (e-mail, IP, card, phone).  These are seeds: the words beside them are
lexical patterns.  Patterns and the values they surround form a graph whose scores are passed to and fro for
a few rounds: a pattern is as good as the values it surrounds, a value as good as the patterns around it.
Values of identifier shape that no fixed pattern took and that end with a score of ``confident`` or more become
further spans of that kind, if their shape is one of the kind's: numbers for phones, cards and addresses, letters or
letters with digits for e-mail (``suits``).

Patterns run over whole texts in time linear in their length (no pattern can start inside a run it has
already refused), and positions are code points, ends exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netsift.llm.scratch import written

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "A-Za-z0-9._%+-"
#: The four base patterns, written so that they never look at a run of characters twice.
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Candidates for context: they start behind white space, ``:`` or ``=`` (so a glued cue is a cue).  Names spelled with "at" and
#: "dot"; up to five groups of digits and dialling signs; words with a digit; letters joined by signs.
_END = r"(?=[\s,;:!?]|$)"
TOKEN = (r"(?<![^\s:=])(?:[^\s:=@]++\x20at\x20\S++\x20dot\x20\p{L}++"
         rf"|[+(]?+[0-9][0-9()./-]*+{_END}(?:\x20[0-9(][0-9()./-]*+{_END}){{0,4}}+"
         r"|[^\s0-9:=]*+[0-9]\S*+|\p{L}++(?:[._()\[\]{}+-]++\p{L}++)++)")
#: The whole word before a value (on any line) and the one behind it on the same line; no run is looked at twice.
BEFORE, BEHIND = r"(?<!\S)(\S++)\s*+$", r"^[^\S\n\r]*+(\S++)"


def _found(text: Column, kind: str, pattern: str, worth: Column) -> Column:
    """Array of (kind, i, gap, left, value, right): every match with the words before and behind it."""
    t = F.when(worth, text)
    gaps, values = F.split(t, pattern, -1), F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    rows = F.arrays_zip(gaps.alias("g"), F.concat(values, F.array(F.lit(None).cast("string"))).alias("v"),
                        F.slice(gaps, 2, F.greatest(F.size(gaps), F.lit(1))).alias("n"))
    kept = F.filter(rows, lambda x: x["v"].isNotNull())
    return F.coalesce(F.transform(kept, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).cast("long").alias("gap"),
        F.regexp_extract(x["g"], BEFORE, 1).alias("left"), x["v"].alias("value"),
        F.regexp_extract(x["n"], BEHIND, 1).alias("right"))), F.array())


def _key(doc_id: str, text) -> Column:
    """128 bits of id and text: two of them are equal only for equal rows."""
    return F.struct(F.xxhash64(doc_id, text).alias("a"), F.xxhash64(text, F.lit(1), doc_id).alias("b"))


def matches(docs: DataFrame) -> DataFrame:
    """rid, key, doc_id, kind, start, end, value, left, right, valid; a row without a match has one row of nulls.

    ``rid`` numbers the input rows, ``key`` is a hash of id and text.  Kind ``token`` is a candidate for context.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text")).withColumn("rid", F.monotonically_increasing_id())
    worth = {
        "email": F.contains("text", F.lit("@")), "ip": F.col("text").rlike(r"[0-9]\.[0-9]"),
        "card": F.col("text").rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), "phone": F.contains("text", F.lit("+")),
        "token": F.col("text").rlike(r"[0-9]|\p{L}[._()\[\]{}+-]\p{L}|\x20at\x20"),
    }
    every = [_found(F.col("text"), k, p, worth[k]) for k, p in {**PATTERNS, "token": TOKEN}.items()]
    flat = written(rows.select(
        "rid", _key("doc_id", "text").alias("key"), "doc_id",
        F.explode_outer(F.concat(*every)).alias("m")).select("rid", "key", "doc_id", "m.*"), "matches")
    order = Window.partitionBy("rid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("value")
    placed = flat.where("kind is not null").withColumn("end", F.sum(F.col("gap") + size).over(order)).withColumn(
        "start", F.col("end") - size)
    core_start = F.length(F.regexp_extract("value", r"^[^0-9A-Za-z+]*+", 0))
    core = F.regexp_replace("value", r"^[^0-9A-Za-z+]++|[^0-9A-Za-z]++$", "")
    token = F.col("kind") == "token"
    placed = placed.withColumn("start", F.when(token, F.col("start") + core_start).otherwise(F.col("start"))).withColumn(
        "value", F.when(token, core).otherwise(F.col("value"))).withColumn("end", F.col("start") + F.length("value"))
    digits = F.regexp_replace("value", "[^0-9]", "")
    n = F.length(digits)
    small = F.forall(F.split("value", r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
        F.split("value", r"\."), lambda p: F.coalesce(F.right(F.concat(F.lit("0"), F.regexp_replace(p, "^0+", "")), F.lit(4)).cast("int"), F.lit(0)) <= 255)
    valid = (F.when(F.col("kind") == "ip", small)
             .when(F.col("kind") == "card", n.between(14, 19) & F.call_function("luhn_check", F.when(n <= 19, digits).otherwise("1")))
             .when(F.col("kind") == "phone", n.between(10, 15)).otherwise(True))
    placed = placed.withColumn("valid", valid).drop("i", "gap")
    nothing = flat.where("kind is null").drop("i", "gap").withColumns(
        {"start": F.lit(None).cast("long"), "end": F.lit(None).cast("long"), "valid": F.lit(False)})
    return written(placed.unionByName(nothing), "placed")


def _digits(value: str = "value") -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def suits(value: str, kind: str, min_digits: int) -> Column:
    """Whether a value's shape is one that identifiers of the kind have."""
    n, letter = _digits(value), F.col(value).rlike(r"\p{L}")
    dots = F.length(F.regexp_replace(value, "[^.]", ""))
    return (F.when(F.col(kind) == "email", letter & ((n == 0) | (n >= min_digits)))
            .when(F.col(kind) == "phone", ~letter & n.between(min_digits - 1, 15))
            .when(F.col(kind) == "card", ~letter & n.between(12, 19)).otherwise(~letter & (dots == 3)))


def contextual(found: DataFrame, rounds: int = 3, confident: float = 0.9, support: int = 3, min_digits: int = 6) -> DataFrame:
    """rid, kind, start, end of further spans, induced from the base spans in ``found``.

    A pattern is the word before a value, or the word behind it on the same line.  It needs ``support`` different
    values of a kind before it says anything: seeds, or values that the last round left with a score of ``confident``.
    A place of a value counts as its better side, and the value's score is the mean over its places, so one
    reliable cue is enough whatever stands on the other side.
    """
    base = found.where("valid and kind <> 'token'")
    token = found.where((F.col("kind") == "token") & ((_digits() >= min_digits - 1) | (_digits() == 0)))
    taken = base.select(F.col("rid").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"))
    loose = token.join(taken, (F.col("rid") == F.col("r")) & (F.col("start") < F.col("e")) & (F.col("s") < F.col("end")), "left_anti")

    word = (F.lower("left"), F.lower("right"))
    sides = F.filter(F.array(F.concat(F.lit("l:"), word[0]), F.concat(F.lit("r:"), word[1])), lambda p: F.length(p) > 2)
    both = base.select("rid", "kind", "start", "end", "value", "left", "right").unionByName(
        loose.select("rid", F.lit(None).cast("string").alias("kind"), "start", "end", "value", "left", "right"))
    places = written(both.select("value", "kind", sides.alias("sides")).where(F.size("sides") > 0)
                     .groupBy("value", "kind", "sides").agg(F.count("*").alias("n")), "places")
    edges = places.select("value", "kind", F.explode("sides").alias("pattern"), "n").groupBy("value", "kind", "pattern").agg(
        F.sum("n").alias("n"))
    edges = written(edges, "edges")
    seeds, unseen = edges.where("kind is not null"), edges.where("kind is null").drop("kind")
    loose_places = places.where("kind is null").drop("kind")
    weight = loose_places.groupBy("value").agg(F.sum("n").alias("places"))
    total = edges.groupBy("pattern").agg(F.sum("n").alias("all"))
    own = seeds.select("pattern", "kind", "value", F.col("n").cast("double").alias("good"), F.lit(True).alias("sure"))
    score = None
    for k in range(rounds):
        good = own if score is None else own.unionByName(unseen.join(score, "value").select(
            "pattern", "kind", "value", (F.col("n") * F.col("score")).alias("good"), (F.col("score") >= confident).alias("sure")))
        able = good.groupBy("pattern", "kind").agg(
            F.sum("good").alias("good"), F.count_distinct(F.when(F.col("sure"), F.col("value"))).alias("values")).where(F.col("values") >= support)
        patterns = able.join(total, "pattern").select("pattern", "kind", (F.col("good") / (F.col("all") + 1)).alias("trust"))
        told = (loose_places.withColumn("pattern", F.explode("sides")).join(patterns, "pattern").where(suits("value", "kind", min_digits))
                .groupBy("value", "sides", "n", "kind").agg(F.max("trust").alias("trust")))
        score = written(told.groupBy("value", "kind").agg(F.sum(F.col("n") * F.col("trust")).alias("t"))
                        .join(weight, "value").select("value", "kind", (F.col("t") / F.col("places")).alias("score")), "score")
    best = score.groupBy("value").agg(F.max(F.struct("score", "kind")).alias("b")).where(F.col("b.score") >= confident)
    return loose.select("rid", "key", "doc_id", "start", "end", "value").join(
        best.select("value", "b.kind"), "value").select("rid", "key", "doc_id", "kind", "start", "end")


def spans(docs: DataFrame, **settings) -> DataFrame:
    """rid, key, doc_id, base and all: arrays of (start, rank of kind, kind, end), sorted; one row per input row."""
    found = matches(docs)
    more = contextual(found, **settings)
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    base = found.withColumn("kind", F.when(F.col("valid") & (F.col("kind") != "token"), F.col("kind"))).select(
        "rid", "key", "doc_id", "kind", "start", "end", F.lit(True).alias("base"))
    span = F.struct("start", rank.alias("rank"), "kind", "end")
    return base.unionByName(more.withColumn("base", F.lit(False))).groupBy("rid", "key", "doc_id").agg(
        F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull() & F.col("base"), span))).alias("base"),
        F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), span))).alias("all"))


def joined(column: str) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def personal_data(docs: DataFrame, **settings) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans: one row per input row; null text is empty."""
    def count_of(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans(docs, **settings).select(
        "doc_id", *[count_of(k) for k in KINDS], F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("all").alias("spans"))


def masked(docs: DataFrame, **settings) -> DataFrame:
    """All rows and columns of ``docs``; each span gives way to its kind's name in angle brackets, n_chars follows.

    Spans that overlap are covered by one name, that of the first.  Texts without a span stay as they are.
    """
    key, spans_of = "__key", "__all"
    while {key, spans_of} & set(docs.columns):
        key, spans_of = f"_{key}", f"_{spans_of}"
    mine = spans(docs, **settings).where(F.size("all") > 0).select("key", F.col("all").alias(spans_of)).dropDuplicates(["key"])
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = docs.withColumn(key, _key("doc_id", text)).join(mine.withColumnRenamed("key", key), key, "left")
    # fold: written so far, and the code point up to which the text is dealt with
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc, x):
        fresh = x["start"] >= acc["at"]
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int"))
        return F.struct(F.when(fresh, F.concat(acc["out"], gap, F.lit("<"), F.upper(x["kind"]), F.lit(">")))
                        .otherwise(acc["out"]).alias("out"), F.greatest(acc["at"], x["end"]).alias("at"))

    done = F.aggregate(spans_of, start, step, lambda a: F.concat(
        a["out"], F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.length("text"))))
    changed = both.withColumn("text", F.when(F.col(spans_of).isNotNull(), done).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.col(spans_of).isNotNull(), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return changed.select(*docs.columns)
