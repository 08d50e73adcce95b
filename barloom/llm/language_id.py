"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its hashed character n-grams; a linear layer and a
softmax give the class. Both layers are trained by stochastic gradient descent in numpy on a
bounded sample of labelled rows. A temperature fitted on part of the sample calibrates the
scores, and texts below a calibrated score are rejected.

Cases: texts that are NULL or hold no letter are `und` with score 0 and are rejected. NULL
labels are not learned from. With no labelled row the model knows no class: every text is
`und`. Ids, sources and labels are never inputs of a prediction.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import hidden, ship, slices, texts_of

UNKNOWN = "und"
BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
PART = 64                         # texts whose n-grams are made at a time on the driver


@dataclass(frozen=True)
class Settings:
    per_class: int = 600          # bound of the labelled sample, per language
    dimensions: int = 16
    epochs: int = 6
    least_steps: int = 4000       # a small sample is read more often
    rate: float = 1.0
    held_back: float = 0.25       # share of the sample that fits temperature and rejection
    reject_share: float = 0.0005  # of correctly read texts, at most this share is rejected
    floor: float = 0.35           # no score from here up is rejected


@functools.cache
def letter_table() -> np.ndarray:
    """Letters (general category L) as True, by code point."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


Grams = list[tuple[np.ndarray, np.ndarray]]     # per order: buckets, bounds of each text


def subwords(texts: list[str]) -> tuple[Grams, np.ndarray]:
    """(hashed n-grams of each order, whether each text has a letter).

    Letters are lower-cased; every run of other characters counts as one gap. N-grams may
    begin or end in a gap, but not span one.
    """
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"),
                          dtype=np.uint32)
    letter = letter_table()[codes]
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1
    starts = np.concatenate(([0], np.cumsum(sizes)))
    letters_before = np.concatenate(([0], np.cumsum(letter)))
    has = np.diff(letters_before[starts]) > 0
    keep = letter.copy()
    keep[1:] |= letter[:-1]                       # one gap after each run of letters
    symbols = (codes * letter)[keep]
    bounds = np.concatenate(([0], np.cumsum(keep)))[starts]
    gap = symbols == 0
    out: Grams = []
    hashed = symbols.copy()
    inner = np.zeros(len(symbols), dtype=bool)    # a gap strictly inside
    for order in range(2, ORDERS[-1] + 1):
        if len(symbols) < order:
            hashed, inner = hashed[:0], inner[:0]
        else:
            hashed = hashed[:-1] * np.uint32(0x9E3779B1) + symbols[order - 1:]
            inner = inner[:-1] | gap[order - 2:-1] if order > 2 else inner[:-1]
        bucket = ((hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(16)
        ok = ~inner
        # A gram belongs to the text in which it begins; it may end in the text's last gap.
        place = np.concatenate(([0], np.cumsum(ok)))
        out.append((bucket[ok].astype(np.int32), place[np.minimum(bounds, len(ok))]))
    return out, has


def _of_text(grams: Grams, i: int) -> np.ndarray:
    return np.concatenate([g[cut[i]:cut[i + 1]] for g, cut in grams])


def _lists(texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
    """The n-grams of every text and whether it has a letter, a few texts at a time."""
    found, has = [], []
    for i in range(0, len(texts), PART):
        grams, letters = subwords(texts[i:i + PART])
        found += [_of_text(grams, j) for j in range(len(letters))]
        has.append(letters)
    return found, np.concatenate(has) if has else np.zeros(0, bool)


@dataclass
class Model:
    classes: list[str]
    table: np.ndarray              # BUCKETS x classes: embeddings times the linear layer
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, grams: Grams) -> np.ndarray:
        count = len(grams[0][1]) - 1
        out, size = np.zeros((count, len(self.classes))), np.zeros(count)
        for values, cut in grams:
            held = np.diff(cut)
            some = held > 0
            if some.any():
                out[some] += np.add.reduceat(self.table[values], cut[:-1][some], axis=0)
            size += held
        return out / np.maximum(size, 1)[:, None] + self.bias

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(class, calibrated score, whether accepted) of each text."""
        if not self.classes:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        grams, has = subwords(texts)
        chance = _softmax(self.logits(grams) / self.temperature)
        best = chance.argmax(axis=1)
        score = np.where(has, chance[np.arange(len(texts)), best], 0.0)
        names = [self.classes[b] if ok else UNKNOWN for b, ok in zip(best, has)]
        return names, score, has & (score >= self.threshold)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], labels: list[str], settings: Settings = Settings()) -> Model:
    classes = sorted(set(labels))
    if not classes:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    rng = np.random.default_rng(5)
    target = np.array([classes.index(x) for x in labels])
    grams, has = _lists(texts)
    order = rng.permutation(np.flatnonzero(has))
    back = order[:int(len(order) * settings.held_back)] if len(order) >= 40 else order
    learn = order[len(back):] if len(order) >= 40 else order
    k, dim = len(classes), settings.dimensions
    embed = rng.normal(0, 1 / dim, (BUCKETS, dim))
    linear, bias = np.zeros((dim, k)), np.zeros(k)
    bags = {}
    for i in learn:
        rows, times = np.unique(grams[i], return_counts=True)
        if len(rows):
            bags[i] = rows, times / times.sum()
    epochs = min(40, max(settings.epochs, -(-settings.least_steps // max(1, len(bags)))))
    steps = max(1, epochs * len(bags))
    done = 0
    for _ in range(epochs):
        for i in rng.permutation(list(bags)):
            rows, share = bags[i]
            rate = settings.rate * (1 - done / steps)
            done += 1
            mean = share @ embed[rows]
            error = _softmax((mean @ linear + bias)[None])[0]
            error[target[i]] -= 1
            back_step = linear @ error
            linear -= rate * np.outer(mean, error)
            bias -= rate * 0.05 * error
            # Summed over the batch of one text, a gram's share is tiny; scale by the root.
            embed[rows] -= rate * np.sqrt(share)[:, None] * back_step[None, :]
    model = Model(classes, (embed @ linear).astype(np.float32), bias)
    return _calibrate(model, [texts[i] for i in back], target[back], settings)


def _calibrate(model: Model, texts: list[str], want: np.ndarray, settings: Settings) -> Model:
    """The temperature of least log loss on held-back rows, then the rejection score."""
    if not texts:
        return model
    logits = np.concatenate([model.logits(subwords(texts[i:i + PART])[0])
                             for i in range(0, len(texts), PART)])
    grid = np.geomspace(0.05, 20, 61)
    loss = [-np.log(_softmax(logits / t)[np.arange(len(want)), want] + 1e-12).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    chance = _softmax(logits / model.temperature)
    right = chance.argmax(axis=1) == want
    if right.any():
        low = np.quantile(chance.max(axis=1)[right], settings.reject_share)
        model.threshold = float(min(low, settings.floor))
    return model


def labelled_sample(df: DataFrame, learn_from: Column, text: str, label: str, key: str,
                    per_class: int) -> list[tuple[str, str]]:
    """At most per_class (text, label) rows of each label, those of smallest key hash.

    The counts of all labelled rows set the share of each label that is drawn by hash, so
    that little more than the bound is ranked; the driver receives the bounded sample only.
    """
    rows = df.where(learn_from & F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("t"), F.col(label).cast("string").alias("l"),
        F.xxhash64(F.col(key).cast("string"), F.lit(17)).alias("h"))
    count = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not count:
        return []
    part = F.lit(False)
    for name, n in count.items():
        share = min(1.0, (per_class + 4 * per_class ** 0.5 + 10) / n)
        top = int((1 << 63) * (2 * share - 1)) - (share >= 1)
        part = part | ((F.col("l") == name) & (F.col("h") <= F.lit(max(-(1 << 63), top))))
    rank = F.row_number().over(Window.partitionBy("l").orderBy("h", "t"))
    picked = rows.where(part).withColumn("r", rank).where(F.col("r") <= per_class)
    return [(r["t"], r["l"]) for r in picked.orderBy("l", "r").collect()]


def fit_on(df: DataFrame, learn_from: Column, text: str = "text", label: str = "lang",
           key: str = "doc_id", settings: Settings = Settings()) -> Model:
    sample = labelled_sample(df, learn_from, text, label, key, settings.per_class)
    return fit([t for t, _ in sample], [x for _, x in sample], settings)


def identify(df: DataFrame, model: Model, text: str = "text", lang: str = "lang_pred",
             score: str = "score", accepted: str = "accepted") -> DataFrame:
    """df with the predicted language, its calibrated score and whether it is accepted."""
    ship(df.sparkSession)
    work = hidden(df, "text")["text"]
    names = [c for c in df.columns if c.lower() not in {lang, score, accepted}]
    plain = df.select(*[F.col(f"`{c}`") for c in names], F.col(text).alias(work))
    schema = T.StructType([*[df.schema[c] for c in names], T.StructField(lang, T.StringType()),
                           T.StructField(score, T.DoubleType()),
                           T.StructField(accepted, T.BooleanType())])
    shared = df.sparkSession.sparkContext.broadcast(model)     # BUCKETS x classes floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, work):
            best, chance, ok = shared.value.predict(texts_of(batch, work))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(best, pa.string()), pa.array(chance, pa.float64()),
                 pa.array(ok, pa.bool_())], names=[*names, lang, score, accepted])

    return plain.mapInArrow(run, schema)
