"""Benchmark decontamination by spaced seeds.

A seed is a mask over consecutive tokens whose zeros are ignored, so a window still hashes
alike when a substituted token falls on a zero. The masked windows of the benchmark are
hashed into a table; those of every document are joined to it. Each hit fixes an alignment
of item and document; along it the item is compared token by token, and of the stretches with
four matches in five (a match counts 1, a substitution -4, and the sum is not negative) the one
with most matches decides. The masks together leave no such stretch without a hit: they were
chosen so that every placement of n // 5 substitutions in 7 to 25 tokens has one, and a longer
stretch has a part of that kind.

Tokens are runs of bytes other than white space and ASCII punctuation, A-Z lower-cased.
An item with fewer than `whole` tokens is matched as a whole when it has at least `least`
tokens; shorter ones cannot be told from chance and match nothing.

The benchmark meets the documents in blocks of at most `block_seeds` masked windows: one
block is broadcast, further blocks make further passes, so no broadcast grows with it.

Cases: NULL and empty texts match nothing and items of that kind are ignored. Repeated items
and documents are each reported. NULL ids stay NULL.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import U64, _stream, byte_codes, encoded, hidden, mix, ship, slices, texts_of, word_hashes

MASKS = ("111011", "11111", "1101011", "1111001")


@dataclass(frozen=True)
class Settings:
    masks: tuple[str, ...] = MASKS
    tokens: int = 12              # matched tokens that make an overlap (or four fifths of the item)
    least: int = 5                # tokens of the shortest item that is looked for
    whole: int = 7                # items with fewer tokens are matched as a whole
    penalty: float = 4.0
    block_seeds: int = 1_000_000


_CODES = byte_codes(punctuation=False)
_FACTORS = _stream(301, 64) | U64(1)


def masked(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of every window under the mask, whatever text it lies in."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, dtype=U64)
    out = np.full(n, hash_of(mask), dtype=U64)
    for k, bit in enumerate(mask):
        if bit == "1":
            out += words[k:k + n] * _FACTORS[k]
    return mix(out)


def hash_of(mask: str) -> U64:
    return U64(int(mask, 2) * 1000003 + len(mask))


class Block:
    """Part of the benchmark: its tokens, and its seeds sorted by hash."""

    def __init__(self, ids: list, texts: list[bytes], settings: Settings):
        self.ids, self.settings = ids, settings
        self.words, self.bounds, _, _ = word_hashes(texts, _CODES)
        size = np.diff(self.bounds)
        masks = [*settings.masks]
        masks += ["1" * n for n in sorted(set(size.tolist())) if settings.least <= n < settings.whole]
        self.masks, found = list(dict.fromkeys(masks)), []
        for mask in self.masks:
            h = masked(self.words, mask)
            start = np.arange(len(h))
            item = np.searchsorted(self.bounds, start, side="right") - 1
            ok = start + len(mask) <= self.bounds[item + 1]
            short = size[item] < settings.whole
            ok &= np.where(short, (size[item] == len(mask)) & ("0" not in mask) & (len(mask) >= settings.least),
                           mask in settings.masks)
            found.append((h[ok], item[ok], (start - self.bounds[item])[ok]))
        self.seeds = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, U64)] * 3
        order = np.argsort(self.seeds[0], kind="stable")
        self.hashes, self.item, self.place = (x[order] for x in self.seeds)
        del self.seeds
        bits = max(16, int(np.ceil(np.log2(len(self.hashes) + 1))) + 5)
        self.shift = U64(64 - min(bits, 24))
        self.filter = np.zeros(1 << (64 - int(self.shift)), dtype=bool)
        self.filter[(self.hashes >> self.shift).astype(np.int64)] = True

    def hits(self, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Distinct (text, item, first word of the item's alignment, relative to the text)."""
        found = []
        for mask in self.masks:
            h = masked(words, mask)
            at = np.flatnonzero(self.filter[(h >> self.shift).astype(np.int64)])
            first = np.searchsorted(self.hashes, h[at], side="left")
            last = np.searchsorted(self.hashes, h[at], side="right")
            text = np.searchsorted(bounds, at, side="right") - 1
            ok = (last > first) & (at + len(mask) <= bounds[text + 1])
            at, first, last, text = at[ok], first[ok], last[ok], text[ok]
            times = last - first
            seed = np.repeat(first, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            text = np.repeat(text, times)
            found.append(np.stack([text, self.item[seed],
                                   np.repeat(at, times) - bounds[text] - self.place[seed]], axis=1))
        every = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
        return np.unique(every, axis=0) if len(every) else every

    def overlap(self, words: np.ndarray, item: int, shift: int) -> tuple[int, int, int] | None:
        """(first word, one past the last, matches) of the stretch with most matches among
        those with enough in five (the shortest, then the first of them), if it has enough."""
        own = self.words[self.bounds[item]:self.bounds[item + 1]]
        low, high = max(0, -shift), min(len(own), len(words) - shift)
        same = own[low:high] == words[low + shift:high + shift]
        gain = np.concatenate(([0.0], np.cumsum(np.where(same, 1.0, -self.settings.penalty))))
        # For every end the earliest begin whose sum is not above the end's: the most matches.
        begins = np.searchsorted(-np.minimum.accumulate(gain), -gain, side="left")
        count = np.concatenate(([0], np.cumsum(same)))
        most = count - count[begins]
        matches = int(most.max())
        if matches < min(self.settings.tokens, -(-4 * len(own) // 5)):
            return None
        hit = np.flatnonzero(same)                      # stretches begin and end with a match
        ends = np.flatnonzero(most == matches)
        first = hit[count[begins[ends]]]
        last = hit[count[ends] - 1] + 1
        k = int((last - first).argmin())
        begin, end = int(first[k]), int(last[k])
        return low + shift + begin, low + shift + end, matches


def _blocks(benchmark: DataFrame, item_id: str, text: str, settings: Settings) -> Iterator[Block]:
    """The benchmark in blocks, each read for itself, so that the driver holds one at a time."""
    rows = materialize(
        benchmark.where(F.col(text).isNotNull())
        .select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t"),
                (F.size(F.split(text, r"\s+")) * len(settings.masks)).alias("n")), "benchmark")
    seeds = rows.agg(F.sum("n")).first()[0] or 0
    count = 1 if seeds <= settings.block_seeds else -(-2 * seeds // settings.block_seeds)
    for k in range(count):
        part = rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(count)) == k).orderBy("i", "t").collect()
        if part:
            yield Block([r["i"] for r in part], [r["t"].encode() for r in part], settings)


OVERLAP = T.ArrayType(T.StructType([
    T.StructField("item_id", T.StringType()), T.StructField("first_word", T.LongType()),
    T.StructField("end_word", T.LongType()), T.StructField("matches", T.LongType())]))


def find_overlaps(docs: DataFrame, benchmark: DataFrame, text: str = "text",
                  item_id: str = "item_id", item_text: str = "text", out: str = "overlaps",
                  settings: Settings = Settings()) -> DataFrame:
    """docs with an array of the verified overlaps of each text: item, first word, one past
    the last, matched words, by item. No shuffle of the documents."""
    ship(docs.sparkSession)
    current = docs.drop(out).withColumn(out, F.array().cast(OVERLAP))
    for block in _blocks(benchmark, item_id, item_text, settings):
        if len(block.hashes):
            current = _pass(current, block, text, out)
    return current


def _pass(docs: DataFrame, block: Block, text: str, out: str) -> DataFrame:
    work = hidden(docs, "text", "more")
    names = [c for c in docs.columns if c != out]
    plain = docs.select(*[F.col(f"`{c}`") for c in names], F.col(text).alias(work["text"]), F.col(out))
    schema = T.StructType([*[docs.schema[c] for c in names], docs.schema[out],
                           T.StructField(work["more"], OVERLAP)])
    shared = docs.sparkSession.sparkContext.broadcast(block)
    kind = pa.list_(pa.struct([("item_id", pa.string()), ("first_word", pa.int64()),
                               ("end_word", pa.int64()), ("matches", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in slices(batches, work["text"]):
            words, bounds, _, _ = word_hashes(encoded(texts_of(batch, work["text"])), _CODES)
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            for text_no, item, shift in held.hits(words, bounds):
                own = words[bounds[text_no]:bounds[text_no + 1]]
                stretch = held.overlap(own, item, shift)
                key = (int(text_no), int(item))
                if stretch and stretch[2] > best.get(key, (0, 0, 0))[2]:
                    best[key] = stretch
            for (text_no, item), (first, end, matches) in sorted(best.items()):
                found[text_no].append({"item_id": held.ids[item], "first_word": int(first),
                                       "end_word": int(end), "matches": matches})
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], batch.columns[-1], pa.array(found, kind)],
                names=schema.names)

    merged = plain.mapInArrow(run, schema)
    return merged.withColumn(out, F.concat(out, work["more"])).drop(work["more"])
