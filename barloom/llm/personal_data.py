"""Personal data by bootstrapped contextual extraction, in DataFrame operations only.

Seeds are what four fixed patterns find: e-mail and IP addresses, card and phone numbers.
Seeds induce lexical patterns of three kinds: the word before an instance, the word after it
(of a word that could be an identifier itself, its shape), and the instance's shape. Every token
of the corpus that could be an identifier, and every run of numbers parted by single spaces,
seed or not, is an instance of the patterns it stands in, so patterns and instances form a
graph. Its edges are counted by partial aggregates, and scores go round it: a pattern is as good
as the instances it holds, an instance outside the seeds as good as the share of its
occurrences that two good patterns of different kinds hold. Those count like seeds in the next
round, on the whole graph, so that they make further patterns good. What the last round accepts
becomes a span of kind `found`.

Spans are code-point offsets, end exclusive. Fixed patterns match leftmost and without
overlap for each kind; matches that fail their check are dropped, without another try.

Cases: NULL and empty texts have no span. Rows with a NULL id and repeated rows are searched
like any other. An empty table induces nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import hidden, sieved

# The kinds in their order, with their patterns. Possessive repeats and the
# look-behinds read the same matches in linear time.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# A text without this holds no match of the kind.
HINTS = {"email": "@", "ip": None, "card": None, "phone": "+"}
FOUND = "found"
IDENTIFIER = r"(?<!\S)\S*[0-9@]\S*"
SPACED = r"(?<!\S)[+(]*+[0-9][0-9().+-]*+(?:\x20[(]?[0-9][0-9().-]*+)++[,;:!?]*+(?!\S)"


@dataclass(frozen=True)
class Settings:
    rounds: int = 3
    seeds_least: int = 3          # different seeds, or accepted instances, a pattern must hold
    texts_least: int = 3          # occurrences of a pattern
    pattern_least: float = 0.8    # score of a pattern that discovers
    kinds_least: int = 2          # kinds of good patterns that hold an accepted occurrence
    unknown: float = 0.0          # what an instance counts that no round has accepted


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits is a multiple of ten."""
    n = F.length(digits)
    each = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.when((n - i) % 2 == 1,
                         F.pmod(F.substring(digits, i, F.lit(1)).cast("int") * 2, F.lit(10))
                         + F.when(F.substring(digits, i, F.lit(1)).cast("int") >= 5, 1).otherwise(0))
        .otherwise(F.substring(digits, i, F.lit(1)).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _byte(part: Column) -> Column:
    """Whether a string of digits is a number up to 255."""
    plain = F.ltrim(part, F.lit("0"))
    return (F.length(plain) <= 3) & (F.coalesce(F.substring(plain, 1, 3).try_cast("int"), F.lit(0)) <= 255)


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), _byte)
    count = F.length(_digits(match))
    if kind == "card":
        return count.between(14, 19) & _luhn(_digits(match))
    if kind == "phone":
        return count.between(10, 15)
    return F.lit(True)


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, match): what stands between the matches gives their places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    none = F.struct(F.lit(0).alias("at"), F.array().cast(
        "array<struct<start:int,end:int,match:string>>").alias("out"))
    pairs = F.arrays_zip(F.slice(between, F.lit(1), F.size(found)).alias("gap"), found.alias("match"))
    return F.aggregate(
        pairs, none,
        lambda state, x: F.struct(
            (state["at"] + F.length(x["gap"]) + F.length(x["match"])).alias("at"),
            F.concat(state["out"], F.array(F.struct(
                (state["at"] + F.length(x["gap"])).alias("start"),
                (state["at"] + F.length(x["gap"]) + F.length(x["match"])).alias("end"),
                x["match"].alias("match")))).alias("out")),
        lambda state: state["out"])


_SPANS = "array<struct<start:int,rank:int,end:int,kind:string,match:string>>"


def seed_spans(text: Column) -> Column:
    """Array of (start, rank, end, kind, match) of the four fixed kinds, in order of start and kind."""

    def of(rank: int, kind: str) -> Column:
        kept = F.filter(matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["match"]))
        spans = F.transform(kept, lambda m: F.struct(
            m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"),
            F.lit(kind).alias("kind"), m["match"].alias("match")))
        test = F.contains(text, F.lit(HINTS[kind])) if HINTS[kind] else text.rlike("[0-9]")
        return F.when(test, spans).otherwise(F.array().cast(_SPANS))

    return F.array_sort(F.concat(*[of(rank, kind) for rank, kind in enumerate(KINDS)]))


def _shape(token: Column) -> Column:
    """Letters as a, digits as 9, runs as one; other characters as they are."""
    plain = F.regexp_replace(F.regexp_replace(token, r"\p{L}+", "a"), "[0-9]+", "9")
    return F.regexp_replace(plain, "(?:a9|9a)[a9]*", "x")


def _placed(text: Column, pattern: str) -> Column:
    """Array of (start, end, match, before, after): the matches, which are whole words, and the
    words beside each. They are of the text up to the next match, or of that match."""
    found = matches(text, pattern)
    words = F.transform(found, lambda m: m["match"])
    pairs = F.arrays_zip(
        found.alias("m"), F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)).alias("gap"),
        F.slice(F.concat(F.array(F.lit("")), words), F.lit(1), F.size(found)).alias("last"),
        F.slice(F.concat(F.split(text, pattern, -1), F.array(F.lit(""))), F.lit(2), F.size(found)).alias("rest"),
        F.slice(F.concat(words, F.array(F.lit("")), F.array(F.lit(""))), F.lit(2), F.size(found)).alias("next"))
    return F.transform(pairs, lambda x: F.struct(
        x["m"]["start"].alias("start"), x["m"]["end"].alias("end"), x["m"]["match"].alias("match"),
        F.when(x["gap"].rlike(r"\S"), F.regexp_extract(x["gap"], r"(?<!\S)\S++(?=\s++\z)", 0))
        .otherwise(F.regexp_extract(x["last"], r"(?<!\S)\S++\z", 0)).alias("before"),
        F.when(x["rest"].rlike(r"\S"), F.regexp_extract(x["rest"], r"\A\s++(\S++)", 1))
        .otherwise(F.regexp_extract(x["next"], r"\A(\S++)", 1)).alias("after")))


def _edges(rows: DataFrame, text: str, seeds: str, uid: str) -> DataFrame:
    """(uid, start, end, pattern, after, shape, instance, seed) of every token or spaced run of
    numbers that could be an identifier. pattern is the word before and the shape."""
    whole = F.concat(_placed(F.col(text), IDENTIFIER), _placed(F.col(text), SPACED))
    tokens = rows.where(F.col(text).rlike("[0-9@]")).select(
        uid, F.col(seeds).alias("s"), F.explode(whole).alias("m"))

    def word(x: Column) -> Column:
        return F.when(x.rlike("[0-9@]"), _shape(x)).otherwise(F.lower(x))

    seed = F.exists("s", lambda x: (x["start"] < F.col("end")) & (x["end"] > F.col("start")))
    return tokens.select(
        uid, "s", F.col("m.start").alias("start"), F.col("m.end").alias("end"),
        word(F.col("m.before")).alias("before"), word(F.col("m.after")).alias("after"),
        _shape(F.col("m.match")).alias("shape"), F.xxhash64("m.match").alias("instance")).select(
        uid, "start", "end", F.concat_ws(" ", "before", "shape").alias("pattern"),
        "before", "after", "shape", "instance", seed.alias("seed"))


_PLACE = ("before", "after", "shape", "instance")


def accepted_places(occurrences: DataFrame, settings: Settings) -> DataFrame:
    """(before, after, shape, instance) of the accepted occurrences outside the seeds."""
    graph = materialize(occurrences.groupBy(*_PLACE).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("seed").alias("seeds"))
        .withColumn("id", F.xxhash64(*_PLACE)), "graph")
    # A word before or after, where there is one, and the shape: an edge each.
    edges = materialize(graph.select("id", "instance", "n", "seeds", F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("key")) for kind in _PLACE[:3]])).alias("x"))
        .select("id", "instance", "n", "seeds", "x.kind", "x.key").where("key <> ''"), "edges")
    held = materialize(edges.groupBy("kind", "key", "instance").agg(F.sum("n").alias("n")), "held")
    accepted = None
    for _ in range(settings.rounds):
        sure = graph.select("id", "instance", "n", F.col("seeds").alias("yes"))
        if accepted is not None:
            sure = sure.join(accepted.withColumn("more", F.lit(1)), "id", "left").select(
                "instance", "n", F.when(F.col("more") == 1, F.col("n")).otherwise(F.col("yes")).alias("yes"))
        # Instances nothing speaks for count as unknown.
        belief = sure.groupBy("instance").agg((F.sum("yes") / F.sum("n")).alias("p")).where("p > 0")
        p = F.coalesce("p", F.lit(settings.unknown))
        # Repeats of one instance add little: each counts by the logarithm of its occurrences.
        weight = F.log2(F.col("n") + 1.0)
        good = held.join(belief, "instance", "left").groupBy("kind", "key").agg(
            (F.sum(weight * p) / F.sum(weight)).alias("score"),
            F.count_if(p >= 0.5).alias("sure"), F.sum("n").alias("all"))
        good = good.where((F.col("score") >= settings.pattern_least) & (F.col("sure") >= settings.seeds_least)
                          & (F.col("all") >= settings.texts_least)).select("kind", "key")
        accepted = materialize(
            edges.where("seeds < n").join(good, ["kind", "key"]).groupBy("id").agg(
                F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") >= settings.kinds_least).select("id"),
            "accepted")
    if accepted is None:
        return graph.limit(0).select(*_PLACE)
    return graph.join(accepted, "id", "left_semi").select(*_PLACE)


def find_spans(docs: DataFrame, text: str = "text", out: str = "spans",
               settings: Settings = Settings()) -> DataFrame:
    """docs with an array of (start, rank, end, kind, match): seeds, and what the induced
    patterns found outside them (kind `found`, rank 4)."""
    names = hidden(docs, "uid", "seeds", "more")
    uid, seeds, more = names["uid"], names["seeds"], names["more"]
    base = docs.drop(out).withColumn(seeds, seed_spans(F.coalesce(F.col(text), F.lit(""))))
    # Only texts with a digit or an at sign can hold an instance.
    some = base.where(F.col(text).rlike("[0-9@]")).select(
        F.xxhash64(F.col(text)).alias("h1"), F.md5(F.col(text)).alias("h2"), F.col(text).alias("t"), seeds)
    occurrences = _edges(some.withColumn(uid, F.concat_ws("-", "h1", "h2")), "t", seeds, uid)
    occurrences = materialize(occurrences.distinct(), "occurrences")
    places = materialize(accepted_places(occurrences, settings), "places")
    fresh = occurrences.where("NOT seed").join(places, list(_PLACE), "left_semi").groupBy(uid).agg(
        F.collect_set(F.struct("start", "end")).alias(more))
    fresh = materialize(fresh, "fresh")
    if fresh.isEmpty():
        return base.withColumnRenamed(seeds, out)
    # Texts without a find stay where they are; the few others meet their finds in a join.
    first = F.regexp_extract(uid, "^(-?[0-9]+)-", 1).cast("long")
    h1, plain = F.xxhash64(F.col(text)), docs.drop(out)
    key = F.concat_ws("-", h1, F.md5(F.col(text)))
    never = sieved(plain, h1, fresh, first, "never").withColumn(more, F.lit(None).cast(fresh.schema[more].dataType))
    maybe = sieved(plain, h1, fresh, first, "maybe").withColumn(uid, key).join(fresh, uid, "left").drop(uid)
    joined = never.unionByName(maybe).withColumn(seeds, seed_spans(F.coalesce(F.col(text), F.lit(""))))
    found = F.transform(F.coalesce(more, F.array().cast("array<struct<start:int,end:int>>")), lambda m: F.struct(
        m["start"].alias("start"), F.lit(len(KINDS)).alias("rank"), m["end"].alias("end"),
        F.lit(FOUND).alias("kind"),
        F.substring(F.col(text), m["start"] + 1, m["end"] - m["start"]).alias("match")))
    return joined.withColumn(out, F.array_sort(F.concat(seeds, found))).drop(seeds, more)


def digest(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in capitals and angle brackets; spans
    that begin inside an earlier one are covered by it (to the furthest end)."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    body = F.aggregate(
        spans, start,
        lambda state, s: F.when(
            s["start"] >= state["at"],
            F.struct(s["end"].alias("at"), F.concat(
                state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]),
                F.lit("<"), F.upper(s["kind"]), F.lit(">")).alias("out")))
        .otherwise(F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out"))),
        lambda state: F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, body).otherwise(text)
