"""Packing documents into sequences of fixed length by a configuration linear program.

Documents are tokenized; only those longer than a sequence are cut. What is packed is known
by the histogram of piece lengths alone, which has at most `capacity` entries however many
documents there are. On it the configuration LP (least number of sequences that covers every
length) is solved by multiplicative weights: the lengths' weights price a knapsack, a
dynamic program finds the best configuration, and covered lengths lose weight. Multiplicities
are rounded down, and what is left, with the very short pieces, goes to the fullest sequence
type that still takes it (best fit over types of sequences, not over sequences).

The plan is a table of ranges: the items of rank a to b among those of one length go to such
sequences at such an offset. Ranks are given out by Spark: a rank within the task that wrote
the piece, plus the counts of the tasks before it.

Cases: NULL and empty texts are the end id alone. Repeated rows are packed each. NULL ids
stay NULL. An empty table gives no pieces.
"""

from __future__ import annotations

import bisect
import functools
import json
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..session import materialize
from .bpe import Merges, Recent, Transducer
from .common import hidden, ship, slices, texts_of
from .token_counts import E, L, LETTER, NUMBER, OTHER, QUOTE, R, SPACE, STMD, V, class_table

CAPACITY = 4096
END_ID = 1

# --- tokenizing ------------------------------------------------------------------------

GAP = 255


@functools.cache
def word_classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or GAP by code point."""
    kind = class_table().copy()
    kind[np.isin(kind, (STMD, R, V, L, E))] = LETTER
    kind[kind == QUOTE] = OTHER
    kind[(kind == SPACE) | (np.arange(len(kind)) == 32)] = GAP
    return kind


class WordTokenizer:
    """Ids of a lower-casing BPE with word ends, as the public library gives them."""

    def __init__(self, path: str, memo: int = 300_000):
        self.machine = Transducer.from_file(path)
        self.merges = Merges(self.machine)
        with open(path, encoding="utf-8") as source:
            added = json.load(source).get("added_tokens", [])
        self.special = {t["content"]: t["id"] for t in added}
        self.memo = Recent(memo)

    def pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of every piece, as little-endian unsigned 32-bit numbers."""
        out = list(map(self.memo.young.get, pieces))
        missing = [i for i, ids in enumerate(out) if ids is None]
        found, fresh = {}, {}
        for piece in {pieces[i] for i in missing}:
            ids = self.memo.get(piece)
            if ids is not None:
                found[piece] = ids
                continue
            raw = piece.encode("utf-8", "surrogatepass")
            if len(raw) < 40:
                fresh[piece] = raw
            else:
                symbols = raw[:-1].decode("latin-1") + chr(256 + raw[-1])
                found[piece] = np.array(self.machine.encode(symbols), dtype="<u4").tobytes()
        raws, some = list(fresh.values()), 8192              # at a time, of 40 places each
        made = [ids for i in range(0, len(raws), some) for ids in self.merges.encode(raws[i:i + some])]
        for piece, ids in zip(fresh, made):
            self.memo.put(piece, ids)
            found[piece] = ids
        for i in missing:
            out[i] = found[pieces[i]]
        return out

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special strings."""
        clean = [unicodedata.normalize("NFC", t).replace("Σ", "σ").lower() for t in texts]
        joined = "\n".join(clean) + "\n"
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        kind = word_classes()[codes]
        edge = np.empty(len(kind) + 1, dtype=bool)
        edge[0] = edge[-1] = True
        edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
        for at in np.flatnonzero((codes == 39) & edge[:-1]).tolist():
            after = joined[at + 1:at + 3]          # a quote that opens a piece may contract
            size = 3 if after in ("re", "ve", "ll") else 2 if after[:1] in "stmd" and after else 0
            if size:
                edge[at + 1:at + size] = False
                edge[at + size] = True
        cut = np.flatnonzero(edge)
        start, stop = cut[:-1], cut[1:]
        inside = kind[start] != GAP
        start, stop = start[inside], stop[inside]
        ids = self.pieces([joined[a:b] for a, b in zip(start.tolist(), stop.tolist())])
        sizes = np.fromiter(map(len, clean), np.int64, len(clean)) + 1
        bounds = np.searchsorted(start, np.concatenate(([0], np.cumsum(sizes)))).tolist()
        return [b"".join(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not any(s in t for t in texts for s in self.special):
            return self._plain(texts)
        out = []
        for text in texts:
            parts: list[str | int] = [text]
            for special, number in self.special.items():
                split = []
                for part in parts:
                    if isinstance(part, int) or special not in part:
                        split.append(part)
                        continue
                    for i, piece in enumerate(part.split(special)):
                        split += ([number] if i else []) + [piece]
                parts = split
            plain = iter(self._plain([p for p in parts if isinstance(p, str)]))
            out.append(b"".join(np.array([p], "<u4").tobytes() if isinstance(p, int) else next(plain)
                                for p in parts))
        return out


@functools.cache
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


def cut_pieces(df: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY,
               end_id: int = END_ID, ids: bool = False) -> DataFrame:
    """One row per piece: the columns of df but the text, then piece, start, length,
    ids_crc32 (and the ids), with the writing task and the piece's rank among that task's
    pieces of its length."""
    ship(df.sparkSession)
    work = hidden(df, "text")["text"]
    made = [("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()),
            ("ids_crc32", T.LongType()), ("task", T.IntegerType()), ("task_rank", T.LongType())]
    if ids:
        made.append(("ids", T.ArrayType(T.IntegerType())))
    names = [c for c in df.columns if c != text and c.lower() not in {n for n, _ in made}]
    plain = df.select(*[F.col(f"`{c}`") for c in names], F.col(text).alias(work))
    schema = T.StructType([*[df.schema[c] for c in names], *[T.StructField(n, t) for n, t in made]])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, dtype=np.int64)
        for batch in slices(batches, work):
            encoded = [e + end for e in tokenizer(path).encode(texts_of(batch, work))]
            count = np.array([len(e) // 4 for e in encoded], dtype=np.int64)
            parts = -(-count // capacity)
            owner = np.repeat(np.arange(len(count)), parts)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * capacity
            length = np.minimum(count[owner] - start, capacity)
            blocks = [encoded[o][4 * a:4 * (a + n)]
                      for o, a, n in zip(owner.tolist(), start.tolist(), length.tolist())]
            crc = [zlib.crc32(b) for b in blocks]
            rank = np.empty(len(owner), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            sizes, first, times = np.unique(length[order], return_index=True, return_counts=True)
            rank[order] = np.arange(len(order)) - np.repeat(first, times) + ranks[length[order]]
            ranks[sizes] += times
            columns = [c.take(pa.array(owner)) for c in batch.columns[:-1]]
            columns += [pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                        pa.array(np.full(len(owner), task), pa.int32()), pa.array(rank, pa.int64())]
            if ids:
                columns.append(pa.array([np.frombuffer(b, "<u4").astype(np.int32) for b in blocks],
                                        pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return plain.mapInArrow(run, schema)


# --- the plan --------------------------------------------------------------------------

@dataclass(frozen=True)
class Settings:
    rounds: int = 200         # of multiplicative weights
    decay: float = 1.0        # how fast a length's price falls as it is covered
    long: float = 0.3         # what the longest pieces are priced above their share
    shortest: int = 32        # lengths up to capacity / shortest are left to the best fit


def price(weights: np.ndarray, sizes: np.ndarray, most: np.ndarray, cells: int) -> np.ndarray:
    """Copies of each class in the configuration of greatest weight (unbounded knapsack,
    cut at the copies there are)."""
    best = np.zeros(cells + 1)
    choice = np.full(cells + 1, -1)
    order = np.argsort(sizes, kind="stable")
    sizes_up, weights_up = sizes[order], weights[order]
    fits = np.searchsorted(sizes_up, np.arange(cells + 1), side="right")
    for cell in range(1, cells + 1):
        best[cell] = best[cell - 1]
        n = fits[cell]
        if n:
            value = best[cell - sizes_up[:n]] + weights_up[:n]
            top = int(value.argmax())
            if value[top] > best[cell]:
                best[cell], choice[cell] = value[top], order[top]
    copies = np.zeros(len(sizes), dtype=np.int64)
    cell = cells
    while cell > 0:
        if choice[cell] < 0:
            cell -= 1
            continue
        copies[choice[cell]] += 1
        cell -= sizes[choice[cell]]
    return np.minimum(copies, most)


def configurations(sizes: np.ndarray, counts: np.ndarray, capacity: int,
                   settings: Settings) -> list[tuple[np.ndarray, float]]:
    """(copies of each length, number of sequences) of a fractional cover."""
    covered = np.zeros(len(sizes))
    found: dict[bytes, list] = {}
    step = max(1.0, float((sizes * counts).sum()) / capacity) / settings.rounds
    # A little more than in proportion: long pieces have fewer places they fit.
    start = sizes * (1 + settings.long * sizes / capacity)
    for _ in range(settings.rounds):
        weights = np.exp(-settings.decay * covered / counts) * start
        copies = price(weights, sizes, counts, capacity)
        if not copies.any():
            break
        held = found.setdefault(copies.tobytes(), [copies, 0.0])
        held[1] += step
        covered += step * copies
    return [(c, x) for c, x in found.values()]


@dataclass
class Kind:
    """Sequences filled alike: parts are (length, copies), free what is left."""
    parts: list[tuple[int, int]]
    free: int
    count: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY,
         settings: Settings = Settings()) -> list[Kind]:
    """Kinds of sequences that hold every item of the histogram."""
    left = {n: c for n, c in histogram.items() if c > 0}
    kinds: list[Kind] = []
    lengths = np.array(sorted((n for n in left if capacity // settings.shortest < n < capacity),
                              reverse=True), dtype=np.int64)
    if len(lengths):
        counts = np.array([left[n] for n in lengths.tolist()])
        for copies, amount in configurations(lengths, counts, capacity, settings):
            used = np.flatnonzero(copies)
            parts = [(int(lengths[g]), int(copies[g])) for g in used]
            times = min(int(amount), *(left[n] // k for n, k in parts))    # rounded down
            if times:
                for n, k in parts:
                    left[n] -= times * k
                kinds.append(Kind(parts, capacity - sum(n * k for n, k in parts), times))
    _best_fit(left, kinds, capacity)
    return kinds


def _with(parts: list[tuple[int, int]], length: int, copies: int) -> list[tuple[int, int]]:
    if parts and parts[-1][0] == length:
        return [*parts[:-1], (length, parts[-1][1] + copies)]
    return [*parts, (length, copies)]


def _best_fit(left: dict[int, int], kinds: list[Kind], capacity: int) -> None:
    """Every remaining item, longest first, into the kind with the least room that takes it."""
    by_room: dict[int, list[int]] = defaultdict(list)
    rooms: list[int] = []

    def offer(i: int) -> None:
        room = kinds[i].free
        if room and kinds[i].count:
            if not by_room[room]:
                bisect.insort(rooms, room)
            by_room[room].append(i)

    for i in range(len(kinds)):
        offer(i)
    for length in sorted((n for n, c in left.items() if c), reverse=True):
        need = left[length]
        while need:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):
                per = capacity // length
                full, rest = divmod(need, per)
                if full:
                    kinds.append(Kind([(length, per)], capacity - per * length, full))
                    offer(len(kinds) - 1)
                if rest:
                    kinds.append(Kind([(length, rest)], capacity - rest * length, 1))
                    offer(len(kinds) - 1)
                break
            room = rooms[at]
            i = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
            kind = kinds[i]
            per = min(room // length, max(1, need // kind.count))
            take = min(kind.count, need // per)
            if take < kind.count:
                kinds.append(Kind(kind.parts, kind.free, kind.count - take))
                offer(len(kinds) - 1)
            kinds[i] = Kind(_with(kind.parts, length, per), room - per * length, take)
            need -= take * per
            offer(i)


def ranges(kinds: list[Kind]) -> np.ndarray:
    """Rows (length, first rank, per sequence, first sequence, offset), by length and rank."""
    rows, next_rank, first = [], defaultdict(int), 0
    for kind in kinds:
        offset = 0
        for length, per in kind.parts:
            rows.append((length, next_rank[length], per, first, offset))
            next_rank[length] += per * kind.count
            offset += per * length
        first += kind.count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(df: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY,
         end_id: int = END_ID, settings: Settings = Settings(), ids: bool = False) -> DataFrame:
    """The pieces of df's documents with sequence_id and offset."""
    pieces = materialize(cut_pieces(df, path, text, capacity, end_id, ids), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    before = (F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n"))
    counts = materialize(counts.withColumn("before", before), "counts")
    histogram = {r["length"]: r["n"] for r in
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = ranges(plan(histogram, capacity, settings))
    shared = df.sparkSession.sparkContext.broadcast(table)      # bounded by the histogram
    ranked = pieces.join(counts.drop("n"), ["task", "length"]).withColumn(
        "rank", F.col("before") + F.col("task_rank")).drop("task", "task_rank", "before")
    keep = [c for c in pieces.columns if c not in ("task", "task_rank")]
    schema = T.StructType([*[pieces.schema[c] for c in keep], T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = shared.value
        key = (rows[:, 0] << 48) + rows[:, 1]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            row = rows[np.searchsorted(key, (length << 48) + rank, side="right") - 1]
            past = rank - row[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(row[:, 3] + past // row[:, 2]),
                 pa.array(row[:, 4] + past % row[:, 2] * length)], names=schema.names)

    return ranked.select(*keep, "rank").mapInArrow(place, schema)
