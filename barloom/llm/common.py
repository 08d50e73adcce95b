"""Helpers shared by the operators: shipping code, slicing batches, hashing words.

Words are runs of bytes other than 0x20 and 0x09-0x0D, with A-Z lower-cased. They are
represented by 64-bit hashes; two different words collide with probability 2**-64.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "1000"
U64 = np.uint64
_GOLDEN = 0x9E3779B97F4A7C15
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that tasks can import it.

    Also makes Arrow batches small enough for whole texts, unless the session says otherwise:
    the default of 10,000 rows holds tens of megabytes, several times over, in each task.
    """
    sc = spark.sparkContext
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, BATCH_ROWS)
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="barloom-code-")
    path = os.path.join(folder, "barloom_code.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for here, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(here, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
    atexit.register(lambda: (os.path.exists(path) and os.remove(path), os.rmdir(folder)))


def fold(doc_id: str | Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; NULL ids have NULL."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str)
                   else doc_id.cast("string")) % parts


SIEVE = 1 << 20                   # words of 64 bits


def sieved(df: DataFrame, hashed: Column, keys: DataFrame, key_hash: Column, how: str, words: int = SIEVE
           ) -> DataFrame:
    """The rows of df whose hash may be among the keys' (how = "maybe"), or is surely not ("never").

    The keys make a Bloom filter of at most `words` words, two bits a key, which is joined to df
    as a broadcast of that many rows: rows are told apart where they lie, before anything of
    them is shuffled. What may be among the keys needs an exact join, an inner or outer one,
    since Spark would move a semi join below the filter.
    """
    names = hidden(df, "h", "word", "bits", "held")
    h, word, bits, held = (names[n] for n in ("h", "word", "bits", "held"))

    def marked(rows: DataFrame, value: Column) -> DataFrame:
        rows = rows.withColumn(h, value)
        bit = [F.expr(f"shiftleft(1L, CAST(shiftrightunsigned({h}, {by}) & 63 AS INT))") for by in (40, 50)]
        return rows.withColumn(word, F.pmod(h, F.lit(words))).withColumn(bits, bit[0].bitwiseOR(bit[1]))

    table = marked(keys, key_hash).groupBy(word).agg(F.bit_or(bits).alias(held))
    inside = F.coalesce(F.col(held).bitwiseAND(F.col(bits)) == F.col(bits), F.lit(False))
    joined = marked(df, hashed).join(F.broadcast(table), word, "inner" if how == "maybe" else "left")
    return joined.where(inside if how == "maybe" else ~inside).select(*[f"`{c}`" for c in df.columns])


def hidden(df: DataFrame, *names: str) -> dict[str, str]:
    """Names for working columns that no column of df has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = {}
    for name in names:
        fresh = f"_{name}"
        while fresh.lower() in taken:
            fresh = f"_{fresh}"
        taken.add(fresh.lower())
        out[name] = fresh
    return out


def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most limit bytes of text (one row at least)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def texts_of(batch: pa.RecordBatch, column: str) -> list[str]:
    """Texts, NULL as empty."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


# --- hashing ---------------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer over uint64."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _stream(seed: int, n: int) -> np.ndarray:
    return mix((np.arange(1, n + 1, dtype=U64) + U64(seed)) * U64(_GOLDEN))


_BASE = 0xD1342543DE82EF95                     # odd, so that it has an inverse
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, n of each at least."""
    size = max(1 << 16, 1 << (n - 1).bit_length()) if n else 1 << 16
    have = _POWERS.get(0)
    if have is None or len(have[0]) < size:
        out = []
        for base in (_BASE, _INVERSE):
            row = np.ones(size, dtype=U64)
            done, step = 1, base
            while done < size:
                row[done:2 * done] = row[:done] * U64(step)
                step = step * step & 0xFFFFFFFFFFFFFFFF
                done *= 2
            out.append(row)
        have = _POWERS[0] = (out[0], out[1])
    return have


def byte_codes(lower: bool = True, punctuation: bool = True) -> np.ndarray:
    """A random code per byte, 0 for bytes between words.

    lower folds A-Z. punctuation=False makes ASCII punctuation part of the gaps.
    """
    codes = _stream(11, 256)
    if lower:
        codes[65:91] = codes[97:123]
    gaps = [32, 9, 10, 11, 12, 13]
    if not punctuation:
        gaps += [b for b in range(33, 127) if not chr(b).isalnum()]
    codes[gaps] = 0
    return codes


_WORD_CODES = byte_codes()


def word_hashes(texts: list[bytes], codes: np.ndarray | None = None
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of every word, first word of each text and one past the last, word starts, ends).

    Starts and ends are byte offsets in the texts joined by one line feed each.
    """
    codes = _WORD_CODES if codes is None else codes
    joined = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    code = codes[joined]
    inside = code != 0
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if len(inside) and inside[0]:
        edge = np.concatenate(([0], edge))
    start, end = edge[0::2], edge[1::2]
    power, inverse = _powers(len(joined))
    total = np.zeros(len(joined) + 1, dtype=U64)
    np.cumsum(code * power[:len(joined)], out=total[1:])
    length = end - start
    hashes = mix((total[end] - total[start]) * inverse[start]
                 + length.astype(U64) * U64(_GOLDEN))
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    firsts = np.concatenate(([0], np.cumsum(lengths + 1)))
    return hashes, np.searchsorted(start, firsts), start, end


def shingle_hashes(words: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of width words within each text, and the bounds of each text's runs.

    A text with fewer words, but at least one, has its whole sequence as one run.
    """
    count = np.diff(bounds)
    n = len(words)
    factors = _stream(77, width)
    if n >= width:
        runs = np.zeros(n - width + 1, dtype=U64)
        for k in range(width):
            runs += words[k:n - width + 1 + k] * (factors[k] | U64(1))
        runs = mix(runs)
    else:
        runs = np.zeros(0, dtype=U64)
    made = np.where(count >= width, count - width + 1, np.minimum(count, 1))
    out_bounds = np.concatenate(([0], np.cumsum(made)))
    out = np.empty(out_bounds[-1], dtype=U64)
    place = np.arange(out_bounds[-1], dtype=np.int64)
    owner = np.repeat(np.arange(len(count)), made)
    source = place - out_bounds[owner] + bounds[:-1][owner]
    long = count[owner] >= width
    out[long] = runs[source[long]]
    for i in np.flatnonzero((count > 0) & (count < width)):
        seq = words[bounds[i]:bounds[i + 1]]
        total = (seq * (factors[:len(seq)] | U64(1))).sum(dtype=U64, keepdims=True)
        out[out_bounds[i]] = mix(total + _stream(78, len(seq))[-1:])[0]
    return out, out_bounds


class Tally:
    """Sums by key over many small arrays, merged a buffer at a time."""

    def __init__(self, kind: np.dtype, columns: int, buffer: int = 1 << 20, drop_singles: bool = False):
        self.buffer, self.drop_singles = buffer, drop_singles
        self.keys = np.zeros(0, kind)
        self.sums = [np.zeros(0, np.int64) for _ in range(columns)]
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.waiting = 0

    def add(self, keys: np.ndarray, *values: np.ndarray) -> None:
        self.parts.append((keys, *values))
        self.waiting += len(keys)
        if self.waiting >= self.buffer:
            self.merge()

    def merge(self) -> None:
        """Fold what waits into the sums. Where singles are dropped, a key needs two in one
        buffer to be remembered."""
        if not self.parts:
            return
        every, where = np.unique(np.concatenate([self.keys, *[p[0] for p in self.parts]]),
                                 return_inverse=True)
        self.sums = [
            np.bincount(where, np.concatenate([held, *[p[i + 1] for p in self.parts]]),
                        len(every)).astype(np.int64) for i, held in enumerate(self.sums)]
        self.keys, self.parts, self.waiting = every, [], 0
        if self.drop_singles:
            keep = self.sums[0] > 1
            self.keys, self.sums = self.keys[keep], [s[keep] for s in self.sums]


def encoded(texts: list[str]) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]


def as_i64(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64) if x.dtype == U64 else x.astype(np.int64)


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the bounds of each row."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, type=kind))
