"""Importance resampling towards a target: hashed n-gram weights and a draw without replacement.

The words of a text are its runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased; its features are the runs of one or two consecutive words. A feature falls
into one of `buckets` by its CRC-32. Two passes read the texts: the first counts features
per bucket, over all documents and over the target; the second adds up per document the
gains that the counts give its features. In both, each batch interns its n-grams in an
open-addressed numpy table under their XXH64 with the bytes compared (`ngram_table`). A slot
holds the bucket and the count, so CRC and gain are found once per distinct n-gram, and
the occurrences gather the gain by their slot.

The draw is by Gumbel keys: the weight and a noise from the id's SHA-256 give each row a
whole-number score; the highest scores win. Scores lie within a few ten thousands of each
other whatever the input, so counts per score are a small table which gives the cut and
the rank at which each score begins, and only rows of equal score are ordered among
themselves, by id.

Cases: NULL and empty texts, and texts without a word, have no features and weight 0. Rows
with a NULL id are weighed, but have no score, cannot be drawn and are not part of N. Rows
that repeat an id are rows of their own; with equal scores their order is not defined. With no
documents the result is empty; without targets T is 0. Of the input only the id and the
text are read, so other columns cannot clash. A text is held whole with about 60 times its
bytes while it is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import SLICE_BYTES, ship, slices
from .ngram_table import Runs


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000
    share: int = 25               # percent of the rows with enough words that are drawn
    least_words: int = 20
    seed: int = 7


def _word_bytes() -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = table[0x80:] = True
    return table


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = _word_bytes()


def features(texts: list[bytes]) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, starts and lengths of all n-grams, word bounds of the texts, which words have
    a successor). Single words come first, then pairs, in order."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    inside = _INSIDE[joined]
    ends = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    keep = inside.copy()
    keep[ends] = True                                 # one space after every word
    packed = np.where(inside, _LOWER[joined], np.uint8(32))[keep]
    stop = np.flatnonzero(packed == 32)
    start = np.concatenate(([0], stop[:-1] + 1)) if len(stop) else np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.searchsorted(ends, np.concatenate(([0], np.cumsum(sizes))), side="left")
    follows = np.ones(len(start), dtype=bool)         # false for a text's last word
    follows[bounds[1:][np.diff(bounds) > 0] - 1] = False
    pair = np.flatnonzero(follows)
    starts = np.concatenate((start, start[pair]))
    lengths = np.concatenate((stop - start, stop[pair + 1] - start[pair] if len(pair) else pair))
    return Runs(packed), starts, lengths, bounds, follows


def _slots(runs: Runs, starts: np.ndarray, lengths: np.ndarray, buckets: int
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot of every occurrence, bucket and count of every slot)."""
    slot, holder = runs.intern(starts, lengths)
    bucket = (runs.crc32(starts[holder], lengths[holder]) % np.uint32(buckets)).astype(np.int64)
    return slot, bucket, np.bincount(slot, minlength=len(holder))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [b"" if t is None else t
            for t in pc.cast(batch.column("t"), pa.binary()).to_pylist()]


def bucket_counts(df: DataFrame, text: str = "text", settings: Settings = Settings()) -> np.ndarray:
    """How many features of the texts fall into each bucket."""
    ship(df.sparkSession)
    buckets = settings.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in slices(batches, "t", SLICE_BYTES // 2):
            runs, starts, lengths, _, _ = features(_texts(batch))
            _, bucket, count = _slots(runs, starts, lengths, buckets)
            total += np.bincount(bucket, count, buckets).astype(np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])],
                                         names=["bucket", "n"])

    rows = (df.select(F.col(text).alias("t")).mapInArrow(run, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).toArrow())     # a row a bucket at most
    out = np.zeros(buckets, dtype=np.int64)
    out[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in target and raw."""
    k = float(len(raw))
    s, t = raw.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weigh(df: DataFrame, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text",
          settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row; no shuffle."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(gain)      # a number a bucket
    buckets = settings.buckets

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", SLICE_BYTES // 2):
            runs, starts, lengths, bounds, follows = features(_texts(batch))
            slot, bucket, _ = _slots(runs, starts, lengths, buckets)
            each = shared.value[bucket][slot]
            words = np.diff(bounds)
            own = each[:len(follows)].copy()          # of a word and the pair it begins
            own[follows] += each[len(follows):]
            upto = np.concatenate(([0], np.cumsum(own)))
            total = upto[bounds[1:]] - upto[bounds[:-1]]
            n = words + np.maximum(words - 1, 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(words), pa.array(n),
                 pa.array(total // np.maximum(n, 1))],
                names=["doc_id", "n_words", "n_features", "weight"])

    kind = df.schema[doc_id].dataType.simpleString()
    return df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t")).mapInArrow(
        run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: str, seed: int) -> Column:
    """Thousandths of a Gumbel number drawn from the id; NULL ids have NULL."""
    text = F.concat(F.lit(f"{seed}:"), F.col(doc_id).cast("string"))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(weighed: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """weighed with score and rank; undrawn rows have no rank.

    weighed must be stored: it is read three times.
    """
    scored = weighed.withColumn("score", F.col("weight") + noise("doc_id", settings.seed))
    able = F.col("n_words") >= settings.least_words
    counts = scored.where(able & F.col("score").isNotNull()).groupBy("score").agg(
        F.count(F.lit(1)).alias("n"))
    downwards = Window.orderBy(F.col("score").desc())             # a row a score
    places = counts.withColumn("upto", F.sum("n").over(downwards)).withColumn(
        "all", F.sum("n").over(Window.partitionBy())).select(
        F.col("score").alias("at"), (F.col("upto") - F.col("n")).alias("before"),
        F.floor(F.col("all") * settings.share / F.lit(100)).cast("long").alias("take"))
    wanted = materialize(places.where("before < take"), "places")
    top = scored.where(able).join(wanted, F.col("score") == F.col("at"))
    inside = F.row_number().over(Window.partitionBy("at").orderBy("doc_id"))
    rank = (F.col("before") + inside).cast("long")
    ranked = top.withColumn("rank", F.when(rank <= F.col("take"), rank))
    least = wanted.agg(F.min("at")).first()[0]
    rest = scored if least is None else scored.where(
        ~(able & F.coalesce(F.col("score") >= least, F.lit(False))))
    return ranked.select(*scored.columns, "rank").unionByName(
        rest.withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of docs."""
    gain = gains(bucket_counts(docs, text, settings), bucket_counts(target, target_text, settings))
    return draw(materialize(weigh(docs, gain, doc_id, text, settings), "weights"), settings)
