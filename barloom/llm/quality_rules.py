"""Quality rules: counted rules, and bands of n-gram perplexity per language.

The counted rules look at words, symbols, repeated lines and repeated three-word windows. What
passes them is judged by the perplexity of its characters under an interpolated modified
Kneser-Ney model of character 5-grams. The model is learned from the trusted texts: tasks
count their grams, Spark adds them up and derives continuation counts, discounts, shares and
the mass left to the lower order as joins and aggregates over the distinct grams, whose
number grows with the alphabet rather than with the corpus.

The finished probabilities and back-off masses are sorted arrays of 64-bit hashes, found by
the leading bits of a hash. A task looks every character of a slice up among the grams of the
highest order; only the distinct grams that are not there go through the lower orders. The
arrays are broadcast if the model has at most `broadcast_entries` entries. A larger model stays where it is: the distinct
grams of all texts are joined to its tables, order by order, and the documents' grams to
the result. Both ways give the same figures.

Each language has a band of perplexities: quantiles of its trusted documents that pass the
counted rules, widened by a margin. A share of the trusted documents is not learned from, so
that the upper end does not come from texts the model knows. Documents outside are rejected.

Cases: NULL and empty texts have no word and fail the counted rules. A NULL language is one of
its own; a language without trusted documents takes the band of all, and without any trusted
document every band is open. Rows with a NULL id are measured but never trusted; repeated
rows are measured each, and each trusted. Padding before and after a text is U+FFFF; the same
character inside a text is read as such. Of the input only id, text and language are read,
so other columns cannot clash. A text is held whole with about 60 times its bytes while it
is read.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import (SIEVE, SLICE_BYTES, U64, _stream, byte_codes, encoded, fold, mix, ship, sieved, slices,
                     texts_of, word_hashes)

ORDER = 5
EDGE = "￿"
_PAD = EDGE * (ORDER - 1)
_CODES = byte_codes(lower=False)
_FACTOR = _stream(61, ORDER) | U64(1)              # of the last character, the one before, ...
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_GAPS = b" \t\n\x0b\x0c\r"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Settings:
    least_words: int = 50
    repeat_percent: int = 50      # of the words may lie in repeated windows
    low: float = 0.002            # quantiles of the trusted perplexities
    high: float = 0.998
    margin: float = 1.15          # the band reaches so many times beyond them
    unread: int = 5               # one in so many trusted documents is not learned from
    broadcast_entries: int = 6_000_000            # of 16 bytes, 24 in a task
    held: int = 400_000           # different grams that a task counts before it hands them on


# --- counted rules ---------------------------------------------------------------------

def counted(texts: list[bytes]) -> list[np.ndarray]:
    """The columns of BASE for each text. Words are compared by 64-bit hashes."""
    words, bounds, start, end = word_hashes(texts, _CODES)
    count = np.diff(bounds)
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    firsts = np.concatenate(([0], np.cumsum(sizes)))
    points = np.concatenate(([0], np.cumsum((joined & 0xC0) != 0x80)))
    chars = np.concatenate(([0], np.cumsum(points[end] - points[start])))
    symbols = np.concatenate(([0], np.cumsum(_SYMBOL[joined])))
    owner = np.repeat(np.arange(len(texts)), count)
    covered = np.zeros(len(words), dtype=bool)
    if len(words) > 2:
        first = np.flatnonzero(owner[2:] == owner[:-2])
        factor = _stream(91, 4) | U64(1)
        window = mix(words[first] * factor[0] + words[first + 1] * factor[1] + words[first + 2] * factor[2]
                     + owner[first].astype(U64) * factor[3])
        order = np.argsort(window)
        equal = window[order][1:] == window[order][:-1]
        again = np.zeros(len(window), dtype=bool)
        again[order[1:][equal]] = again[order[:-1][equal]] = True
        for k in range(3):
            covered[first[again] + k] = True
    repeats = np.concatenate(([0], np.cumsum(covered)))
    doubled = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        lines = [line for line in text.split(b"\n") if line.strip(_GAPS)]
        doubled[i] = len(lines) - len(set(lines))
    return [count, chars[bounds[1:]] - chars[bounds[:-1]], symbols[firsts[1:]] - symbols[firsts[:-1]],
            doubled, repeats[bounds[1:]] - repeats[bounds[:-1]]]


def failed(settings: Settings = Settings()) -> Column:
    return (F.col("n_words") < settings.least_words) | (
        100 * F.col("n_repeat_words") > settings.repeat_percent * F.col("n_words"))


# --- grams -----------------------------------------------------------------------------

class Characters:
    """The characters of some texts, and the places of those that are predicted."""

    def __init__(self, texts: list[str]):
        joined = "".join([_PAD + t + EDGE for t in texts])
        self.text = joined
        self.code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(U64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes + ORDER)
        self.bounds = np.concatenate(([0], np.cumsum(sizes + 1)))
        skip = np.zeros(len(joined), dtype=bool)
        for k in range(1, ORDER):
            skip[ends - sizes - 1 - k] = True
        self.place = np.flatnonzero(~skip)                 # of every predicted character

    def grams(self) -> np.ndarray:
        """The hash of the gram that ends at each place."""
        n = max(0, len(self.code) - ORDER + 1)
        return gram_hash([self.code[ORDER - 1 - k:ORDER - 1 - k + n] for k in range(ORDER)], n)[
            self.place - ORDER + 1]

    def hash(self, end: np.ndarray, n: int) -> np.ndarray:
        """The hash of the n characters up to each of some places."""
        return gram_hash([self.code[end - k] for k in range(n)], len(end))


class Grams(Characters):
    """The distinct grams among those that end at each character."""

    def __init__(self, texts: list[str]):
        super().__init__(texts)
        key = self.grams()
        order = np.argsort(key)
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = key[order[1:]] != key[order[:-1]]
        self.kind = np.empty(len(key), dtype=np.int64)     # number of each one's gram
        self.kind[order] = np.cumsum(fresh) - 1
        self.sample = self.place[order[fresh]]             # a place of every gram

    def spelled(self) -> list[str]:
        return [self.text[i - ORDER + 1:i + 1] for i in self.sample.tolist()]


def gram_hash(backwards: list[np.ndarray], size: int) -> np.ndarray:
    """The hash of grams given by their characters, the last one first."""
    total = np.full(size, U64(len(backwards) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    for k, code in enumerate(backwards):
        total += (code + U64(1)) * _FACTOR[k]
    return mix(total)


def hash_of(grams: list[str], n: int) -> np.ndarray:
    code = np.frombuffer("".join(grams).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = code.astype(U64).reshape(len(grams), n)
    return gram_hash([code[:, n - 1 - k] for k in range(n)], len(grams))


def gram_counts(docs: DataFrame, text: str, settings: Settings) -> DataFrame:
    """(gram, c) of every character with the four before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def hand_on() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["gram", "c"])
            held.clear()
            return rows

        for batch in slices(batches, "t", SLICE_BYTES // 2):
            grams = Grams(texts_of(batch, "t"))
            held.update(dict(zip(grams.spelled(), np.bincount(grams.kind).tolist())))
            if len(held) >= settings.held:
                yield hand_on()
        yield hand_on()

    ship(docs.sparkSession)
    return docs.select(F.col(text).alias("t")).mapInArrow(run, "gram string, c long").groupBy("gram").agg(
        F.sum("c").alias("c"))


# --- the model -------------------------------------------------------------------------

@dataclass
class Tables:
    """Per order the probability of every gram, and the mass that its context leaves."""
    p: dict[int, DataFrame]       # (gram, p)
    mass: dict[int, DataFrame]    # (context, mass)
    floor: float                  # probability of a character never seen
    entries: int


def discounts(n: list[int]) -> list[float]:
    """Of grams counted once, twice, more often, from the counts of counts."""
    n = [max(1, k) for k in n]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.05), k - 0.05) for k in (1, 2, 3)]


def fit(trusted: DataFrame, text: str = "text", settings: Settings = Settings()) -> Tables:
    """The model of all given texts."""
    counts = {ORDER: materialize(gram_counts(trusted, text, settings), "grams")}
    for n in range(ORDER - 1, 0, -1):                      # how many characters come before
        counts[n] = materialize(counts[n + 1].groupBy(F.expr(f"substring(gram, 2, {n})").alias("gram")).agg(
            F.count(F.lit(1)).alias("c")), f"grams{n}")
    tables = Tables({}, {}, 1.0, 0)
    for n in range(1, ORDER + 1):
        tally = counts[n].agg(*[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)], F.count(F.lit(1))).first()
        d = discounts(list(tally[:4]))
        taken = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        parts = counts[n].select("gram", "c", taken.alias("taken"),
                                 F.expr(f"substring(gram, 1, {n - 1})").alias("context"))
        total = parts.groupBy("context").agg(F.sum("c").alias("total"),
                                             (F.sum("taken") / F.sum("c")).alias("mass"))
        total = materialize(total, f"contexts{n}")
        share = parts.join(total, "context").withColumn("own", (F.col("c") - F.col("taken")) / F.col("total"))
        if n == 1:
            first = total.first()
            tables.floor = (first["mass"] if first else 1.0) / (tally[4] + 1)
            p = share.select("gram", (F.col("own") + tables.floor).alias("p"))
        else:
            lower = tables.p[n - 1].select(F.col("gram").alias("rest"), F.col("p").alias("below"))
            p = share.withColumn("rest", F.expr(f"substring(gram, 2, {n - 1})")).join(lower, "rest").select(
                "gram", (F.col("own") + F.col("mass") * F.col("below")).alias("p"))
            tables.mass[n] = total.select("context", "mass")
        tables.p[n] = materialize(p, f"p{n}")
        tables.entries += tally[4] + (total.count() if n > 1 else 0)
    return tables


class Lookup:
    """Values by 64-bit hash. The keys are sorted; leading bits tell where to begin to look."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys = np.append(keys[order], U64(0xFFFFFFFFFFFFFFFF))      # where every search ends
        self.values = np.append(values[order], 0.0)
        self.bits = max(1, len(keys).bit_length())

    @functools.cached_property
    def start(self) -> np.ndarray:
        """The first key with each run of leading bits. Every Python worker makes its own."""
        first = np.arange(1 << self.bits, dtype=U64) << U64(64 - self.bits)
        return np.searchsorted(self.keys[:-1], first).astype(np.int32)

    def find(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of every key among the values, whether it is there)."""
        at = self.start[key >> U64(64 - self.bits)]
        have = self.keys[at]
        live = np.flatnonzero(have < key)
        ahead, asked = at[live], key[live]
        while len(live):
            ahead += 1
            at[live] = ahead
            have[live] = seen = self.keys[ahead]
            more = np.flatnonzero(seen < asked)
            live, ahead, asked = live[more], ahead[more], asked[more]
        return at, (have == key) & (at < len(self.keys) - 1)

    def get(self, key: np.ndarray, default: np.ndarray | float) -> np.ndarray:
        at, hit = self.find(key)
        return np.where(hit, self.values[at], default)


@dataclass
class Arrays:
    """The tables by hash. Those of the highest order have the logarithms of their probabilities."""
    p: dict[int, Lookup]
    mass: dict[int, Lookup]
    floor: float

    @classmethod
    def of(cls, tables: Tables) -> Arrays:
        def table(df: DataFrame, n: int, log: bool = False) -> Lookup:
            rows = df.toArrow()
            values = rows.column(1).to_numpy()
            return Lookup(hash_of(rows.column(0).to_pylist(), n), np.log(values) if log else values)
        return cls({n: table(df, n, n == ORDER) for n, df in tables.p.items()},
                   {n: table(df, n - 1) for n, df in tables.mass.items()}, tables.floor)

    def log_p(self, texts: list[str]) -> np.ndarray:
        """The log probability of each text with its end."""
        read = Characters(texts)
        key = read.grams()
        at, known = self.p[ORDER].find(key)
        each = self.p[ORDER].values[at]
        rest = np.flatnonzero(~known)
        _, first, kind = np.unique(key[rest], return_index=True, return_inverse=True)
        each[rest] = np.log(self._backed_off(read, read.place[rest[first]]))[kind]
        upto = np.concatenate(([0.0], np.cumsum(each)))
        return upto[read.bounds[1:]] - upto[read.bounds[:-1]]

    def _backed_off(self, read: Characters, end: np.ndarray) -> np.ndarray:
        """The probabilities of characters whose grams the model lacks in the highest order."""
        p = np.full(len(end), self.floor)
        for n in range(1, ORDER + 1):
            if n > 1:
                p = p * self.mass[n].get(read.hash(end - 1, n - 1), 1.0)
            if n < ORDER:
                p = self.p[n].get(read.hash(end, n), p)
        return p


# --- measuring -------------------------------------------------------------------------

def measure(docs: DataFrame, tables: Tables, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
            settings: Settings = Settings()) -> DataFrame:
    """(doc_id, lang, the columns of BASE, perplexity) of every row."""
    spark = docs.sparkSession
    ship(spark)
    near = tables.entries <= settings.broadcast_entries
    shared = spark.sparkContext.broadcast(Arrays.of(tables) if near else None)   # bounded by the setting

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "t", SLICE_BYTES // 2):
            texts = texts_of(batch, "t")
            size = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
            log_p = shared.value.log_p(texts) if shared.value else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(np.arange(len(texts)) + row),
                 *map(pa.array, counted(encoded(texts))), pa.array(size), pa.array(log_p)],
                names=["doc_id", "lang", "row", *BASE, "size", "log_p"])
            row += len(texts)

    kinds = {c: docs.schema[n].dataType.simpleString() for c, n in (("doc_id", doc_id), ("lang", lang))}
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("t"))
    schema = (f"doc_id {kinds['doc_id']}, lang {kinds['lang']}, row long, "
              + "".join(f"{c} long, " for c in BASE) + "size long, log_p double")
    measured = rows.mapInArrow(run, schema)
    if not near:
        measured = materialize(measured.drop("log_p"), "measured").join(_joined(rows, tables), "row")
    return measured.withColumn("perplexity", F.exp(-F.col("log_p") / F.col("size"))).drop("row", "size", "log_p")


def _joined(rows: DataFrame, tables: Tables) -> DataFrame:
    """(row, log_p) through joins of grams with the model's tables, for a model of any size.

    A row's number is its task's and its place there, as in `measure`, which reads the same
    rows in the same order.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "t", SLICE_BYTES // 2):
            for one in texts_of(batch, "t"):
                grams = Grams([one])
                spelled = grams.spelled()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(spelled), row)), pa.array(spelled), pa.array(np.bincount(grams.kind))],
                    names=["row", "gram", "times"])
                row += 1

    grams = materialize(rows.mapInArrow(run, "row long, gram string, times long"), "row_grams")
    known = grams.select("gram").distinct()
    p: Column = F.lit(tables.floor)
    for n in range(1, ORDER + 1):
        start = ORDER - n + 1
        if n > 1:
            context = tables.mass[n].withColumnsRenamed({"context": f"c{n}", "mass": f"m{n}"})
            known = known.join(context, F.expr(f"substring(gram, {start}, {n - 1}) = c{n}"), "left")
            p = p * F.coalesce(f"m{n}", F.lit(1.0))
        own = tables.p[n].withColumnsRenamed({"gram": f"g{n}", "p": f"p{n}"})
        known = known.join(own, F.expr(f"substring(gram, {start}, {n}) = g{n}"), "left")
        p = F.coalesce(f"p{n}", p)
    weights = known.select("gram", F.log(p).alias("w"))
    return grams.join(weights, "gram").groupBy("row").agg(F.sum(F.col("times") * F.col("w")).alias("log_p"))


def chosen(docs: DataFrame, ids: DataFrame, words: int = SIEVE) -> DataFrame:
    """The rows of docs whose doc_id is in ids, which holds none twice. Texts of the others are
    not shuffled."""
    maybe = sieved(docs, F.xxhash64("doc_id"), ids, F.xxhash64("id"), "maybe", words)
    return maybe.join(ids, F.col("doc_id") == F.col("id")).select(*docs.columns)


def judge(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text",
          lang: str = "lang", settings: Settings = Settings()) -> DataFrame:
    """(doc_id, lang, the columns of BASE, base_failed, perplexity, lower, upper, kept) of every row.

    trusted holds the ids of documents known as good, in a column named as doc_id.
    """
    ids = trusted.select(F.col(doc_id).alias("id")).where(F.col("id").isNotNull()).distinct()
    unread = fold("id", settings.unread) == 0
    tables = fit(chosen(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), ids.where(~unread)),
                 "text", settings)
    measured = materialize(measure(docs, tables, doc_id, text, lang, settings)
                           .withColumn("base_failed", failed(settings)), "measured")
    good = measured.where("NOT base_failed").join(
        ids.withColumn("unread", unread), F.col("doc_id") == F.col("id"))
    # Texts that the model has read look easier to it: they mark the lower end, unread ones the upper.
    band = lambda of, q: F.percentile_approx(of, q, 10_000)       # noqa: E731
    fresh = band(F.when(F.col("unread"), F.col("perplexity")), settings.high)
    limits = [(band("perplexity", settings.low) / settings.margin).alias("low"),
              (F.greatest(fresh, band("perplexity", settings.high)) * settings.margin).alias("high")]
    of_all = good.agg(*limits).first()
    bands = good.groupBy(F.col("lang").alias("of")).agg(*limits)
    joined = measured.join(bands, F.col("lang").eqNullSafe(F.col("of")), "left")
    lower = F.coalesce("low", F.lit(of_all["low"]).cast("double"), F.lit(0.0))
    upper = F.coalesce("high", F.lit(of_all["high"]).cast("double"), F.lit(float("inf")))
    return joined.select(
        "doc_id", "lang", *BASE, "base_failed", "perplexity", lower.alias("lower"), upper.alias("upper"),
        (~F.col("base_failed") & (F.col("perplexity") >= lower) & (F.col("perplexity") <= upper)).alias("kept"))
