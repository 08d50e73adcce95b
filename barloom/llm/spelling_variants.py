"""Spelling variants: words one edit apart, found through Bloom filters of the vocabulary.

Words are runs of ASCII letters and U+00C0 to U+00FF, A-Z lower-cased. Tasks count the runs
of their slices before anything is shuffled; the vocabulary are the runs that are long and
frequent enough. A blocked Bloom filter per word length (64-bit blocks, four bits a word)
is built as an aggregate and broadcast. Every word generates its edits as hashes only: all
deletions, and all replacements by a smaller character of the target length's alphabet. An
insertion is a deletion seen from the other side, and a replacement by a larger character
is one by a smaller from the other, so that each pair is met once. Edits which the filter
may hold are spelled out and shuffled to an exact join with the vocabulary.

The filters that are broadcast together hold `filter_bytes` at most. A larger vocabulary is
probed in several passes over some lengths each; a length that is too large alone is cut by
the hash. Each probe belongs to one pass, so the passes together do the work of one.

A word's form is its most frequent near word, if that is `ratio` times as frequent; a
word's root is the last of its forms. Frequencies grow at each step, so chains are short and
have no cycles; they are followed by doubling.

Cases: NULL and empty texts have no words. A NULL id takes part as an empty one. Repeated
rows count each. With no words the result is empty. Ties between near words go to the
smallest in code-point order. Of the input only id and text are read, so other columns
cannot clash. A text is held whole with about 30 times its bytes while it is read; a long
word costs its length times the alphabet.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import SLICE_BYTES, U64, _stream, mix, ship, slices
from .ngram_table import Runs


@dataclass(frozen=True)
class Settings:
    least_length: int = 6         # code points
    least_count: int = 5
    ratio: int = 5                # a form is at least so many times as frequent; 2 or more
    typo_modulus: int = 199       # of the crc32 of `<doc_id>:<run>`; 0 leaves every run whole
    bits: int = 16                # of the filter, per word
    filter_bytes: int = 16 << 20  # broadcast at a time
    held: int = 400_000           # different words that a task counts before it hands them on

    def __post_init__(self):
        if self.ratio < 2:            # equally frequent words would be each other's forms
            raise ValueError("ratio must be 2 or more")


def _tables() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    letter = np.zeros(256, dtype=bool)
    letter[65:91] = letter[97:123] = letter[0xC3] = True
    return lower, letter


_LOWER, _LETTER = _tables()


# --- counting --------------------------------------------------------------------------

def runs_of(texts: list[bytes]) -> tuple[Runs, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, start, bytes and code points of every run, bounds of the texts' runs).

    In UTF-8 the characters U+00C0 to U+00FF are those, and the only ones, led by byte C3.
    """
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    inside = _LETTER[joined]
    inside[1:] |= joined[:-1] == 0xC3
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    leads = np.concatenate(([0], np.cumsum(joined == 0xC3)))
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.searchsorted(start, np.concatenate(([0], np.cumsum(sizes))))
    return Runs(_LOWER[joined]), start, end - start, end - start - (leads[end] - leads[start]), bounds


def count_slice(ids: list[str], texts: list[bytes], settings: Settings) -> Counter[str]:
    """Counts of the runs as the vocabulary reads them, those long enough."""
    runs, start, length, points, bounds = runs_of(texts)
    slot, holder = runs.intern(start, length)
    times = np.bincount(slot, minlength=len(holder))
    out: Counter[str] = Counter()
    if settings.typo_modulus:
        own = runs.crc32(start[holder], length[holder])[slot]
        before = np.array([zlib.crc32(f"{i}:".encode()) for i in ids], dtype=np.uint32)
        h = runs.crc32_after(np.repeat(before, np.diff(bounds)), own, start, length)
        typo = np.flatnonzero(h % np.uint32(settings.typo_modulus) == 0)
        np.subtract.at(times, slot[typo], 1)
        typo = typo[points[typo] > settings.least_length]
        for i, place in zip(typo.tolist(), (h[typo] % points[typo]).tolist()):
            word = runs.raw(start[i], length[i]).decode()
            out[word[:place] + word[place + 1:]] += 1
    long = np.flatnonzero((points[holder] >= settings.least_length) & (times > 0))
    for i, n in zip(holder[long].tolist(), times[long].tolist()):
        out[runs.raw(start[i], length[i]).decode()] += n
    return out


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
               settings: Settings = Settings()) -> DataFrame:
    """(word, n, length) of every word that is long and frequent enough, stored.

    The tasks have added up their own counts, so the rows go straight to their word's
    partition; the number of partitions stays as configured, since probing costs far more
    than a word's bytes tell.
    """
    spark = docs.sparkSession
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def hand_on() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                names=["word", "n"])
            held.clear()
            return rows

        for batch in slices(batches, "t", SLICE_BYTES // 2):
            texts = [b"" if t is None else t for t in pc.cast(batch.column("t"), pa.binary()).to_pylist()]
            held.update(count_slice(batch.column("id").to_pylist(), texts, settings))
            if len(held) >= settings.held:
                yield hand_on()
        yield hand_on()

    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("t"))
    counted = (rows.mapInArrow(run, "word string, n long")
               .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "word")
               .groupBy("word").agg(F.sum("n").alias("n"))
               .where(F.col("n") >= settings.least_count))
    return materialize(counted.withColumn("length", F.char_length("word")), "vocabulary")


# --- filters ---------------------------------------------------------------------------

_CODE = _stream(41, 256)                           # of a character, all below U+0100
_BASE = 0x9FB21C651E98DF25                         # odd, so that it has an inverse
_INVERSE = U64(pow(_BASE, -1, 1 << 64))


def powers(n: int) -> np.ndarray:
    out = np.full(n, U64(_BASE))
    if n:
        out[0] = U64(1)
    return np.cumprod(out, dtype=U64)


def finish(total: np.ndarray, length: int) -> np.ndarray:
    return mix(total + U64(length * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))


def bits_of(h: np.ndarray) -> np.ndarray:
    out = np.zeros(len(h), dtype=U64)
    for k in range(4):
        out |= U64(1) << ((h >> U64(6 * k)) & U64(63))
    return out


@dataclass(frozen=True)
class Shard:
    """Blocks for the words of one length, or for part of them, in the array of a pass."""
    first: int
    blocks: int
    part: int
    parts: int
    alphabet: np.ndarray

    def place(self, h: np.ndarray) -> np.ndarray:
        return ((h >> U64(32)) * U64(self.blocks) >> U64(32)).astype(np.int64) + self.first

    def own(self, h: np.ndarray) -> np.ndarray:
        return (h >> U64(24)) % U64(self.parts) == U64(self.part)


def plan(lengths: list[tuple[int, int, np.ndarray]], settings: Settings) -> list[dict[int, Shard]]:
    """Passes of shards by length, from (length, words, alphabet)."""
    most = settings.filter_bytes // 8
    passes: list[dict[int, Shard]] = [{}]
    used = 0
    for length, words, alphabet in sorted(lengths, key=lambda row: row[0]):
        blocks = -(-words * settings.bits // 64)
        parts = -(-blocks // most)
        for part in range(parts):
            size = -(-blocks // parts)
            if used + size > most:
                passes.append({})
                used = 0
            passes[-1][length] = Shard(used, size, part, parts, alphabet)
            used += size
    return [p for p in passes if p]


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, their characters) for each length of a batch."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(size).tolist():
        row = np.flatnonzero(size == length)
        joined = "".join(words[i] for i in row.tolist()).encode("latin-1")
        yield length, row, np.frombuffer(joined, dtype=np.uint8).reshape(len(row), length)


def _lengths(words: DataFrame) -> list[tuple[int, int, np.ndarray]]:
    """(length, number of words, characters in use), a row for every length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for length, row, chars in _by_length(batch.column("word").to_pylist()):
                seen = np.zeros(256, dtype=bool)
                seen[chars] = True
                rows.append((length, len(row), *np.packbits(seen).view(np.int64).tolist()))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)],
                                                 names=["length", "n", *_SEEN])

    rows = words.select("word").mapInArrow(run, "length long, n long, " + ", ".join(f"{c} long" for c in _SEEN))
    return [(r["length"], r["n"],
             np.flatnonzero(np.unpackbits(np.array([r[c] for c in _SEEN]).view(np.uint8))).astype(np.uint8))
            for r in rows.groupBy("length").agg(
                F.sum("n").alias("n"), *[F.bit_or(c).alias(c) for c in _SEEN]).collect()]


_SEEN = ("a", "b", "c", "d")


def build_filter(words: DataFrame, shards: dict[int, Shard]) -> np.ndarray:
    """The blocks of one pass: as many as the settings allow, whatever the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, chars in _by_length(batch.column("word").to_pylist()):
                shard = shards[length]
                h = finish((_CODE[chars] * powers(length)).sum(axis=1, dtype=U64), length)
                h = h[shard.own(h)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.place(h)), pa.array(bits_of(h).view(np.int64))], names=["at", "bits"])

    rows = (words.where(F.col("length").isin(*shards)).select("word").mapInArrow(run, "at long, bits long")
            .groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(max(s.first + s.blocks for s in shards.values()), dtype=U64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(U64)
    return out


# --- probing ---------------------------------------------------------------------------

def _hits(blocks: np.ndarray, shard: Shard, h: np.ndarray) -> np.ndarray:
    if shard.parts > 1:
        mine = np.flatnonzero(shard.own(h))
        h = h[mine]
    bits = bits_of(h)
    found = np.flatnonzero(blocks[shard.place(h)] & bits == bits)
    return mine[found] if shard.parts > 1 else found


def edits(words: list[str], blocks: np.ndarray, shards: dict[int, Shard], chunk: int = 1 << 16
          ) -> tuple[list[int], list[str]]:
    """(word, edit) for each edit that the filter may hold, words by their place."""
    owner: list[int] = []
    spelled: list[str] = []
    for length, rows, every in _by_length(words):
        shorter, same = shards.get(length - 1), shards.get(length)
        if shorter is None and same is None:
            continue
        factor = powers(length)
        step = max(1, chunk // max(length, 64))
        for first in range(0, len(rows), step):
            row, chars = rows[first:first + step], every[first:first + step]
            terms = _CODE[chars] * factor
            upto = np.cumsum(terms, axis=1, dtype=U64)
            total = upto[:, -1]
            if shorter is not None:                # once for a run of equal characters
                fresh = np.ones(chars.shape, dtype=bool)
                fresh[:, 1:] = chars[:, 1:] != chars[:, :-1]
                w, i = np.nonzero(fresh)
                h = finish(upto[w, i] - terms[w, i] + (total[w] - upto[w, i]) * _INVERSE, length - 1)
                for k in _hits(blocks, shorter, h).tolist():
                    word = words[row[w[k]]]
                    owner.append(row[w[k]])
                    spelled.append(word[:i[k]] + word[i[k] + 1:])
            if same is not None:
                rest = total[:, None] - terms
                for at in range(length):
                    w, c = np.nonzero(same.alphabet < chars[:, at, None])
                    put = same.alphabet[c]
                    h = finish(rest[w, at] + _CODE[put] * factor[at], length)
                    for k in _hits(blocks, same, h).tolist():
                        word = words[row[w[k]]]
                        owner.append(row[w[k]])
                        spelled.append(word[:at] + chr(put[k]) + word[at + 1:])
    return owner, spelled


def _probe(words: DataFrame, blocks: np.ndarray, shards: dict[int, Shard]) -> DataFrame:
    """(edit, word, n) for each edit that the filter may hold."""
    shared = words.sparkSession.sparkContext.broadcast((blocks, shards))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, spelled = edits(batch.column("word").to_pylist(), *shared.value)
            of = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(spelled, pa.string()), batch.column("word").take(of), batch.column("n").take(of)],
                names=["edit", "word", "n"])

    reach = sorted({n for length in shards for n in (length, length + 1)})
    return words.where(F.col("length").isin(*reach)).select("word", "n").mapInArrow(
        run, "edit string, word string, n long")


def near_pairs(words: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(a, a_n, b, b_n): every two words of the vocabulary that are one edit apart, once."""
    spark: SparkSession = words.sparkSession
    ship(spark)
    path = scratch_path(spark, "asked")
    _probe(words.where("false"), np.zeros(0, U64), {}).write.parquet(path)
    for shards in plan(_lengths(words), settings):
        # Written pass by pass, so that executors hold the filters of one pass only.
        _probe(words, build_filter(words, shards), shards).write.mode("append").parquet(path)
    known = words.select(F.col("word").alias("b"), F.col("n").alias("b_n"))
    return spark.read.schema("edit string, word string, n long").parquet(path).join(
        known, F.col("edit") == F.col("b")).select(
        F.col("word").alias("a"), F.col("n").alias("a_n"), "b", "b_n")


# --- forms and roots -------------------------------------------------------------------

def with_forms(words: DataFrame, pairs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word."""
    nothing = F.lit(None)
    side = lambda w, near, n: F.struct(F.col(w).alias("word"), F.col(near).alias("near"), F.col(n).alias("near_n"))
    both = pairs.select(F.inline(F.array(side("a", "b", "b_n"), side("b", "a", "a_n"))))
    rows = both.select("word", nothing.cast("long").alias("n"),
                       F.struct((-F.col("near_n")).alias("m"), "near").alias("best")).unionByName(
        words.select("word", "n", nothing.cast("struct<m: bigint, near: string>").alias("best")))
    merged = rows.groupBy("word").agg(F.max("n").alias("n"), F.count("best").alias("n_near"),
                                      F.min("best").alias("best"))
    formed = -F.col("best.m") >= settings.ratio * F.col("n")
    return merged.select("word", "n", "n_near", F.when(formed, F.col("best.near")).alias("form"),
                         F.when(formed, -F.col("best.m")).alias("form_n"))


def with_roots(formed: DataFrame) -> DataFrame:
    """formed with the last of each word's forms; formed must be stored."""
    links = materialize(formed.where("form IS NOT NULL").withColumn("root", F.col("form")), "links")
    while True:
        ahead = links.select(F.col("word").alias("via"), F.col("root").alias("on"))
        moved = materialize(links.join(ahead, F.col("root") == F.col("via"), "left"), "moved")
        links = moved.withColumn("root", F.coalesce("on", "root")).drop("via", "on")
        if moved.where("on IS NOT NULL").isEmpty():
            break
    return formed.where("form IS NULL").withColumn("root", F.col("word")).unionByName(links)


def group_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   settings: Settings = Settings()) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary."""
    words = vocabulary(docs, doc_id, text, settings)
    formed = with_forms(words, near_pairs(words, settings), settings)
    return with_roots(materialize(formed, "formed"))
