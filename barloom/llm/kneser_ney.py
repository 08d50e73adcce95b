"""Quality classification by an interpolated modified Kneser-Ney trigram model.

The model is trained on the trusted documents, but for one in five, which only the thresholds
are taken from. Its counts are Spark aggregates over word hashes: raw counts for trigrams,
continuation counts (how many different words come before) for bigrams and words, and three
discounts per order from the counts of counts. Each order's discounted probability is
interpolated with the next lower one, the lowest with a uniform share for unknown words.

A model of few entries is broadcast, and every whole text is scored where it lies. For a larger
one the texts are cut into slices, whose words, pairs and trigrams are counted and looked up by
exchanging arrays of their hashes (`exchange`); no part of the model is a table or is broadcast.
Both ways give the same perplexities. A document is kept when its perplexity is at
most its language's threshold: a high quantile over that language's trusted documents that the
model has not read, with a margin.

Cases: NULL and empty texts have the end as their only token. A NULL language is a group of
its own; a language without trusted documents takes the threshold of all. Without any
trusted document everything is kept. Rows with a NULL id are scored, but never trusted.
Repeated rows are scored each.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import collecting, drop_scratch, materialize, release
from .common import (U64, as_i64, byte_codes, encoded, fold, hidden, mix, ship, sieved, slices, texts_of,
                     word_hashes)
from .exchange import (REQUEST, Plan, asked_by, distinct, in_rounds, sliced, token_arrays, token_data,
                       with_answers)
from .quality_rules import chosen

BEGIN, END, UNKNOWN = (mix(np.array([x], dtype=U64))[0] for x in (0xB0, 0xE0, 0xD0))
BROADCAST_IDS = 1_000_000
SHARES = 6                        # slices are shuffled to their answers in so many jobs at most
_CODES = byte_codes(lower=False)


@dataclass(frozen=True)
class Settings:
    trusted_most: int | None = None               # documents the model is trained on; None: no bound
    unread: int = 5               # one in so many trusted documents is not learned from
    quantile: float = 0.99        # of the trusted perplexities of a language
    margin: float = 1.25          # a perplexity is rejected from so many times the quantile
    broadcast_entries: int = 6_000_000            # of 12 bytes
    hot_entries: int = 1 << 20    # has no use any more: what is not broadcast is exchanged
    rounds: int = 5               # in which keys are exchanged, at most


def pair_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * U64(0x9E3779B97F4A7C15) + right)


def text_tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Every word and one end per text, and bounds."""
    words, bounds, _, _ = word_hashes(encoded(texts), _CODES)
    return np.insert(words, bounds[1:], END), bounds + np.arange(len(bounds))


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(two back, one back, token) for every word and one end per text, and bounds."""
    token, bounds = text_tokens(texts)
    one, two = np.empty_like(token), np.empty_like(token)
    one[1:], two[2:] = token[:-1], token[:-2]
    first = bounds[:-1]
    one[first] = two[first] = BEGIN
    second = first[first + 1 < bounds[1:]] + 1
    two[second] = BEGIN
    return two, one, token, bounds


def discounts(times: Sequence[int]) -> list[float]:
    """Of counts of 1, of 2 and above, from how many are 1, 2, 3 and 4."""
    n = [max(1, int(k)) for k in times]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]


def _taken(counts: DataFrame, c: str) -> Column:
    """The discount of a count, of three kinds, from the counts of counts."""
    ones = counts.agg(*[F.count_if(F.col(c) == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    d = discounts([ones[f"n{k}"] or 0 for k in (1, 2, 3, 4)])
    return F.when(F.col(c) == 1, d[0]).when(F.col(c) == 2, d[1]).otherwise(d[2])


def _discounted(counts: DataFrame, context: list[str], c: str) -> tuple[DataFrame, DataFrame]:
    """(context, token, c, discounted share p, mass) and (context, mass left for the lower order)."""
    taken = _taken(counts, c)
    total = counts.groupBy(*context).agg(F.sum(c).alias("total"), F.sum(taken).alias("taken"))
    mass = (F.col("taken") / F.col("total")).alias("mass")
    share = counts.join(total, context).select(
        *context, "token", c, ((F.col(c) - taken) / F.col("total")).alias("p"), mass)
    return share, total.select(*context, mass)


@dataclass
class Model:
    """Sorted keys with values: words, bigrams, trigrams, and the mass of both contexts."""
    tables: dict[str, tuple[np.ndarray, np.ndarray]]
    unknown: float

    def look(self, name: str, key: np.ndarray, default: float) -> np.ndarray:
        keys, values = self.tables[name]
        if not len(keys):
            return np.full(len(key), default)
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, values[at], default)

    def log_probability(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(natural log probability, tokens) of each text."""
        two, one, token, bounds = trigrams(texts)
        context = pair_key(two, one)
        p = self.look("word", token, self.unknown)
        p = self.look("pair", pair_key(one, token), 0.0) + self.look("pair_mass", one, 1.0) * p
        p = self.look("triple", pair_key(context, token), 0.0) + self.look("triple_mass", context, 1.0) * p
        return np.add.reduceat(np.log(p), bounds[:-1]) if len(texts) else np.zeros(0), np.diff(bounds)


@dataclass
class Tables:
    """The same model where Spark has it, over word hashes, with the count c behind each share."""
    word: DataFrame               # token, c, p
    pair: DataFrame               # one, token, c, p, mass
    pair_mass: DataFrame          # one, mass
    triple: DataFrame             # two, one, token, c, p, mass
    triple_mass: DataFrame        # two, one, mass
    unknown: float
    entries: int                  # rows of all tables, at most


def learn(trusted: DataFrame, text: str = "text") -> Tables:
    """Train on all of the given documents; one row of counts an order reaches the driver."""
    ship(trusted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            yield pa.RecordBatch.from_arrays(
                [pa.array(as_i64(x)) for x in trigrams(texts_of(batch, "t"))[:3]], names=["two", "one", "token"])

    grams = trusted.select(F.col(text).alias("t")).mapInArrow(run, "two long, one long, token long")
    raw = materialize(grams.groupBy("two", "one", "token").agg(F.count(F.lit(1)).alias("c")), "trigrams")
    before = materialize(raw.groupBy("one", "token").agg(F.count(F.lit(1)).alias("c")), "bigrams")
    spread = materialize(before.groupBy("token").agg(F.count(F.lit(1)).alias("c")), "unigrams")
    triple, triple_mass = _discounted(raw, ["two", "one"], "c")
    pair, pair_mass = _discounted(before, ["one"], "c")
    taken = _taken(spread, "c")
    total, left, words = spread.agg(F.sum("c"), F.sum(taken), F.count(F.lit(1))).first()
    floor = (left / total if words else 1.0) / (words + 1)
    word = spread.select("token", "c", ((F.col("c") - taken) / F.lit(total) + F.lit(floor)).alias("p"))
    return Tables(word, pair, pair_mass, triple, triple_mass, floor, raw.count() + 2 * (before.count() + words))


def _key(names: list[str], columns: list[np.ndarray]) -> np.ndarray:
    """The key of a word, a pair, or a trigram, from its words' hashes."""
    hashed = [c.astype(np.int64).view(U64) for c in columns]
    key = hashed[0]
    for word in hashed[1:]:
        key = pair_key(key, word)
    return key


def collected(tables: Tables) -> Model:
    """The model on the driver, for one of few entries."""
    def table(df: DataFrame, names: list[str], value: str) -> tuple[np.ndarray, np.ndarray]:
        rows = df.select(*names, value).toArrow()
        keys = _key(names, [rows.column(n).to_numpy() for n in names])
        order = np.argsort(keys)
        return keys[order], rows.column(value).to_numpy().astype(np.float32)[order]

    return Model({"word": table(tables.word, ["token"], "p"),
                  "pair": table(tables.pair, ["one", "token"], "p"),
                  "pair_mass": table(tables.pair_mass, ["one"], "mass"),
                  "triple": table(tables.triple, ["two", "one", "token"], "p"),
                  "triple_mass": table(tables.triple_mass, ["two", "one"], "mass")}, tables.unknown)


def fit(trusted: DataFrame, text: str = "text") -> Model:
    """Train on documents that are few enough for a model on the driver."""
    return collected(learn(trusted, text))


def perplexity(df: DataFrame, model: Model, text: str = "text", out: str = "perplexity") -> DataFrame:
    """df with the perplexity of every whole text; no shuffle."""
    ship(df.sparkSession)
    work = hidden(df, "text")["text"]
    names = [c for c in df.columns if c.lower() != out.lower()]
    plain = df.select(*[F.col(f"`{c}`") for c in names], F.col(text).alias(work))
    schema = T.StructType([*[df.schema[c] for c in names], T.StructField(out, T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, work):
            total, tokens = shared.value.log_probability(texts_of(batch, work))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(np.exp(-total / tokens))], names=schema.names)

    return plain.mapInArrow(run, schema)


# --- a model of any size ---------------------------------------------------------------

class Grams:
    """The words, pairs and trigrams of a slice; a context is a pair, or two beginnings.

    What has an unknown word is in no model and not asked for.
    """

    def __init__(self, data: bytes):
        words, self.token, self.size = token_arrays(data)
        self.words = np.append(words, BEGIN)                       # the beginning is the last one
        self.start = np.cumsum(self.size) - self.size
        self.one = np.empty_like(self.token)
        self.one[1:] = self.token[:-1]
        self.one[self.start] = len(words)
        known = words[self.token] != UNKNOWN
        before = np.ones(len(known), bool)
        before[1:] = known[:-1]
        before[self.start] = True
        self.asked = known & before                                # pairs
        context = np.ones(len(known), bool)
        context[1:] = self.asked[:-1]
        context[self.start] = True
        self.asked_triple = known & context
        self.pair = pair_key(self.words[self.one], self.words[self.token])
        self.begin = pair_key(self.words[-1:], self.words[-1:])
        context = np.empty_like(self.pair)
        context[1:] = self.pair[:-1]
        context[self.start] = self.begin
        self.triple = pair_key(context, self.words[self.token])

    def triples(self) -> np.ndarray:
        return self.triple[self.asked_triple]

    def contexts(self) -> np.ndarray:
        """All pairs, and the two beginnings as the last one."""
        return np.append(self.pair[self.asked], self.begin)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(the distinct pairs in order, the number of each token's pair, that of its context)."""
        every, _, kind = distinct(self.contexts())
        own = np.full(len(self.pair), len(every))                  # the number of what is not asked for
        own[self.asked] = kind[:-1]
        before = np.empty(len(own), np.int64)
        before[1:] = own[:-1]
        before[self.start] = kind[-1]
        return every, own, before


def _sums(kind: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(kind, values, size).astype(np.int64)


def _kinds(context: np.ndarray, c: np.ndarray, size: int) -> list[np.ndarray]:
    """Of each context how many counts are 1, 2 and more, and by how much their sum exceeds 1, 2 and 0."""
    of = [np.bincount(context[x], minlength=size) for x in (c == 1, c == 2, c > 2)]
    return [*of, _sums(context, c, size) - of[0] - 2 * of[1]]


def _census(sums: list[np.ndarray]) -> list[int]:
    """Of the first count: how many are 1, 2, 3, 4, how many there are, and their sum."""
    return [*[int((sums[0] == k).sum()) for k in (1, 2, 3, 4)], int((sums[0] > 0).sum()), int(sums[0].sum())]


def _shares(c: np.ndarray, d: list[float]) -> np.ndarray:
    """Counts without their discounts."""
    return np.where(c > 0, c - np.choose(np.minimum(np.maximum(c, 1), 3) - 1, d), 0.0)


def _mass(kinds: list[np.ndarray], d: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """(the sum of a context's counts or 1, the mass left to the lower order)."""
    ones, twos, others, more = kinds
    total = ones + 2 * twos + more
    some = np.maximum(total, 1)
    return some, np.where(total > 0, (d[0] * ones + d[1] * twos + d[2] * others) / some, 1.0)


def _known_words(found: DataFrame, plan: Plan, shares: int) -> DataFrame:
    """Slices that are not learned from, with one word for all that the model lacks."""
    answers, _ = in_rounds(lambda number: asked_by(found, lambda data: token_arrays(data)[0], number, plan),
                           [np.add], plan.rounds, "known", _census)
    others = found.where("NOT learned")
    names = others.columns

    def run(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        words, kind, size = token_arrays(rows.column("data")[0].as_py())
        order = np.argsort(words)
        known = np.empty(len(words), bool)
        known[order] = plan.answered(answers, words[order])[0] > 0
        place = np.where(known, np.cumsum(known) - 1, known.sum())
        data = token_data(np.append(words[known], UNKNOWN), place[kind], size)
        return rows.set_column(names.index("data"), "data", pa.array([data], pa.binary()))

    return with_answers(others, answers, run, others.schema, "known", shares)


def perplexity_exchanged(rows: DataFrame, settings: Settings) -> DataFrame | None:
    """(doc_id, lang, perplexity) of texts (t, learned, doc_id, lang), by counts exchanged with all
    others, and nothing if the tokens that are learned from are few enough for a broadcast.

    Words that no learned text has are told apart first. Then trigrams are counted. Each one is
    counted once, by the slice that owns it, for its pair and its context, and each pair for its
    words; then every slice has the counts of all it holds.
    """
    spark = rows.sparkSession
    with collecting() as paths:
        found = materialize(sliced(rows, text_tokens), "slices", "learned")
    path = f"{paths[0]}/slices"
    release(spark)
    tokens, learned = found.agg(F.sum("tokens"), F.sum(F.when(F.col("learned"), F.col("tokens")))).first()
    # A token makes a trigram, and a pair and a word that are contexts, too.
    if 5 * (learned or 0) <= settings.broadcast_entries:
        drop_scratch(spark, [path])
        return None
    plan, few, shares = Plan.of(tokens, settings.rounds), Plan.of(tokens, 1), Plan.of(tokens, SHARES).rounds
    read = found.where("learned")
    with collecting() as paths:
        others = _known_words(found, few, shares)
    drop_scratch(spark, paths, others)
    drop_scratch(spark, [f"{path}/learned=false"])
    found = read.unionAll(others)

    triples, n3 = in_rounds(lambda number: asked_by(found, lambda data: Grams(data).triples(), number, plan),
                            [np.add], plan.rounds, "triples", _census)
    d3 = discounts(n3[:4])

    def count_pairs(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        grams = Grams(rows.column("data")[0].as_py())
        every, first, _ = distinct(grams.triple)
        c, own = plan.answered(answers, every)
        pairs, kind, before = grams.pairs()
        at, c = first[own > 0], c[own > 0]
        counts = [np.bincount(kind[at], minlength=len(pairs)), *_kinds(before[at], c, len(pairs))]
        out = []
        for number in range(plan.rounds):
            mine = plan.of_round(pairs, number)
            out.append(plan.pieces(key[0].as_py(), pairs[mine], [x[mine] for x in counts]))
        return pa.Table.from_batches(out).append_column(
            "round", pa.array(np.repeat(np.arange(plan.rounds), [x.num_rows for x in out]), pa.int32()))

    with collecting() as paths:
        counted = with_answers(read.select("slice", "data"), triples, count_pairs, f"{REQUEST}, round int", "counted",
                                shares, "round")

    def ask_pairs(number: int) -> DataFrame:
        drop_scratch(spark, [f"{folder}/counted/round={number - 1}" for folder in paths])
        return counted.where(F.col("round") == number).drop("round").unionAll(
            asked_by(others, lambda data: Grams(data).contexts(), number, plan))

    pairs, n2 = in_rounds(ask_pairs, [np.add] * 5, plan.rounds, "pairs", _census)
    drop_scratch(spark, paths)
    d2 = discounts(n2[:4])

    def count_words(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        grams = Grams(rows.column("data")[0].as_py())
        every, first, _ = distinct(grams.contexts())
        c, *_, own = plan.answered(answers, every)
        some = (own > 0) & (c > 0)                   # a pair of beginnings comes before no word
        at, c = first[some], c[some]
        size = len(grams.words)
        counts = [np.bincount(grams.token[at], minlength=size), *_kinds(grams.one[at], c, size)]
        order = np.argsort(grams.words)
        return pa.Table.from_batches([few.pieces(key[0].as_py(), grams.words[order], [x[order] for x in counts])])

    with collecting() as paths:
        counted = with_answers(read.select("slice", "data"), pairs, count_words, REQUEST, "counted", shares)
    words, n1 = in_rounds(lambda number: counted.unionAll(
        asked_by(others, lambda data: Grams(data).words, number, few)), [np.add] * 5, few.rounds, "words", _census)
    drop_scratch(spark, paths)
    d1 = discounts(n1[:4])
    known, total = int(n1[4]), max(1, int(n1[5]))
    left = d1[0] * n1[0] + d1[1] * n1[1] + d1[2] * (known - n1[0] - n1[1])
    floor = (float(left) / total if known else 1.0) / (known + 1)

    kinds = {c: found.schema[c].dataType.elementType.simpleString() for c in ("doc_id", "lang")}
    answers = functools.reduce(DataFrame.unionAll, [
        df.withColumn("order", F.lit(k)) for k, df in enumerate((words, pairs, triples))])

    def scores(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        grams = Grams(rows.column("data")[0].as_py())
        told = [answers.filter(pa.compute.equal(answers.column("order"), k)) for k in range(3)]
        order = np.argsort(grams.words)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        c, *of, _ = few.answered(told[0], grams.words[order])
        p1 = (_shares(c, d1) / total + floor)[place]
        sum2, mass2 = (x[place] for x in _mass(of, d2))
        every, kind, before = grams.pairs()
        c, *of, _ = (np.append(x, 0) for x in plan.answered(told[1], every))
        sum3, mass3 = _mass(of, d3)
        p = _shares(c, d2)[kind] / sum2[grams.one] + mass2[grams.one] * p1[grams.token]
        every, _, kind = distinct(grams.triples())
        c = np.zeros(len(p))
        if len(every):
            c[grams.asked_triple] = _shares(plan.answered(told[2], every)[0], d3)[kind]
        p = c / sum3[before] + mass3[before] * p
        log_p = np.add.reduceat(np.log(p), grams.start)
        own = [pa.concat_arrays(rows.column(c).chunks).flatten() for c in ("doc_id", "lang")]
        return pa.table([*own, pa.array(np.exp(-log_p / grams.size))], names=["doc_id", "lang", "perplexity"])

    return with_answers(found.select("slice", "data", "doc_id", "lang"), answers, scores,
                         f"doc_id {kinds['doc_id']}, lang {kinds['lang']}, perplexity double", "scores", shares)


def _flagged(rows: DataFrame, read: DataFrame) -> DataFrame:
    """(t, learned, doc_id, lang) of all rows; texts that are surely not read are not shuffled."""
    flag = [F.col("text").alias("t"), F.coalesce("read", F.lit(False)).alias("learned"), "doc_id", "lang"]
    if read.count() <= BROADCAST_IDS:
        return rows.join(F.broadcast(read), F.col("doc_id") == F.col("id"), "left").select(*flag)
    hashed = F.xxhash64("doc_id"), read, F.xxhash64("id")
    never = sieved(rows, *hashed, "never").withColumn("read", F.lit(False))
    return sieved(rows, *hashed, "maybe").join(read, F.col("doc_id") == F.col("id"), "left").select(*flag).unionAll(
        never.select(*flag))


def classify(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, keep) of every row of docs.

    trusted holds the ids of documents known as good, in a column named as doc_id.
    """
    ship(docs.sparkSession)
    ids = trusted.select(F.col(doc_id).alias("id")).where(F.col("id").isNotNull()).distinct()
    unread = fold("id", settings.unread) == 0
    first = ids.where(~unread)
    if first.isEmpty():
        first = ids
    if settings.trusted_most is not None:
        first = first.orderBy(F.xxhash64("id"), "id").limit(settings.trusted_most)
    read = materialize(first.withColumn("read", F.lit(True)), "chosen")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"))
    with collecting() as paths:
        scored = perplexity_exchanged(_flagged(rows, read), settings)
        if scored is None:
            tables = learn(chosen(rows.select("doc_id", "text"), read.select("id")))
            scored = perplexity(rows, collected(tables)).select("doc_id", "lang", "perplexity")
            scored = materialize(scored, "perplexity")
    drop_scratch(docs.sparkSession, paths, scored)
    fresh = ids.join(read, "id", "left").select("id", F.coalesce("read", F.lit(False)).alias("read"))
    known = scored.join(fresh, scored["doc_id"] == fresh["id"]).select("lang", "perplexity", "read")
    # A language whose trusted documents were all read takes what there is.
    cut = F.percentile_approx(F.when(~F.col("read"), F.col("perplexity")), settings.quantile, 10_000)
    every = F.percentile_approx("perplexity", settings.quantile, 10_000)
    limit = F.coalesce(cut, every) * settings.margin
    by_lang = known.groupBy(F.col("lang").alias("of")).agg(limit.alias("own"))
    by_lang = materialize(by_lang, "thresholds")
    if by_lang.count() <= 10_000:                # languages; a wild column goes by a shuffle
        by_lang = F.broadcast(by_lang)
    overall = known.agg(limit.alias("all")).first()["all"]
    joined = scored.join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left").select(
        "doc_id", "lang", "perplexity",
        F.coalesce("own", F.lit(overall).cast("double")).alias("threshold"))
    return joined.withColumn("keep", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))
