"""Counts by key over a corpus, exchanged as arrays instead of rows.

A corpus is cut into slices of some texts, each with its tokens as numbers of its own words.
A slice asks for its distinct keys (64-bit hashes): they are sorted, cut by their leading bits
into parts, and each piece is one row with a binary value. The task of a part adds up what the
slices that are learned from have counted and answers every slice, in the order of its keys,
so an answer holds no keys. No key can be hot, since it comes once from each slice, and what
Spark sorts and shuffles are some rows a slice, however many keys they hold.

Of the learned slices that hold a key, the first one owns it: what is to be counted once a key
is counted there. Keys are asked for in a few rounds, by their trailing bits; what a round has
shuffled is gone before the next.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, release
from .common import U64, slices, texts_of

SLICE_TOKENS = 5 << 19
PART_KEYS = 1 << 22               # tokens of the corpus a part
ANSWER = "slice long, round int, part int, data binary"


# --- arrays as bytes -------------------------------------------------------------------

@functools.cache
def _codec() -> pa.Codec:
    return pa.Codec("zstd", compression_level=1)


def _squeezed(x: np.ndarray) -> tuple[str, int, bytes]:
    raw = np.ascontiguousarray(x)
    return raw.dtype.str, raw.nbytes, _codec().compress(raw, asbytes=True) if raw.nbytes else b""


def _spread(kind: str, size: int, data: bytes) -> np.ndarray:
    return np.frombuffer(_codec().decompress(data, size, asbytes=True) if size else b"", dtype=kind)


def _small(x: np.ndarray) -> np.ndarray:
    """The same numbers in the narrowest type; fractions as they are."""
    if x.dtype.kind == "f":
        return np.ascontiguousarray(x)
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def packed(*numbers: np.ndarray) -> bytes:
    """Arrays of integers from 0 or of fractions, each with its bytes of equal rank together."""
    out = []
    for x in map(_small, numbers):
        out.append((x.dtype.str, _squeezed(x.view(np.uint8).reshape(-1, x.itemsize).T)))
    return pickle.dumps(out, 5)


def unpacked(data: bytes) -> list[np.ndarray]:
    out = []
    for kind, planes in pickle.loads(data):
        width = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(_spread(*planes).reshape(width, -1).T).reshape(-1).view(kind))
    return out


_LOW = 5                          # bytes of a key that are written as they are


def packed_keys(key: np.ndarray) -> bytes:
    """Sorted 64-bit keys: differences of the leading bytes, and the others."""
    top = key >> U64(8 * _LOW)
    low = np.ascontiguousarray(key.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, :_LOW])
    return pickle.dumps((int(top[0]) if len(key) else 0, packed(np.diff(top, prepend=top[:1])), low.tobytes()), 5)


def unpacked_keys(data: bytes) -> np.ndarray:
    first, top, low = pickle.loads(data)
    top = np.cumsum(unpacked(top)[0], dtype=U64) + U64(first)
    out = np.zeros((len(top), 8), np.uint8)
    out[:, :_LOW] = np.frombuffer(low, np.uint8).reshape(-1, _LOW)
    return out.view("<u8").reshape(-1).astype(U64, copy=False) | top << U64(8 * _LOW)


def distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the distinct keys in order, a place of each, the number of each place's key)."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    kind = np.empty(len(key), np.int64)
    kind[order] = np.cumsum(new) - 1
    return ordered[new], order[new], kind


# --- slices ----------------------------------------------------------------------------

def token_data(words: np.ndarray, kind: np.ndarray, size: np.ndarray) -> bytes:
    """A slice: its distinct words, the number of each token's word, the tokens of each text.

    A word's number is its rank by frequency; those that come once have the last numbers, in
    order, and need none.
    """
    times = np.bincount(kind, minlength=len(words))
    often = np.flatnonzero(times > 1)
    often = often[np.argsort(-times[often], kind="stable")]
    place = np.zeros(len(words), np.int64)
    place[often] = np.arange(1, len(often) + 1)
    once = words[kind[times[kind] == 1]]
    return pickle.dumps((words[often].tobytes(), once.tobytes(), packed(place[kind], size)), 5)


def token_arrays(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct words, the number of each token's word, tokens of each text)."""
    often, once, rest = pickle.loads(data)
    place, size = unpacked(rest)
    kind = place.astype(np.int64) - 1
    words = np.frombuffer(often + once, U64)
    kind[kind < 0] = np.arange(len(often) // 8, len(words))
    return words, kind, size.astype(np.int64)


def sliced(texts: DataFrame, tokens: Callable[[list[str]], tuple[np.ndarray, np.ndarray]],
           most: int = SLICE_TOKENS) -> DataFrame:
    """(slice, learned, tokens, data, a list of each other column) of texts (t, learned, ...).

    tokens gives the token hashes of some texts and their bounds. A slice has only texts that
    are learned from, or only others.
    """
    own = [c for c in texts.columns if c not in ("t", "learned")]
    schema = "slice long, learned boolean, tokens long, data binary" + "".join(
        f", `{c}` array<{texts.schema[c].dataType.simpleString()}>" for c in own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: dict[bool, list] = {True: [], False: []}

        def out(learned: bool) -> pa.RecordBatch:
            nonlocal number
            number += 1
            parts, held[learned] = held[learned], []
            token, size = (np.concatenate(x) for x in zip(*[p[:2] for p in parts]))
            words, _, kind = distinct(token)
            columns = [pa.concat_arrays([p[2].column(c) for p in parts]) for c in own]
            return pa.RecordBatch.from_arrays(
                [pa.array([number - 1]), pa.array([learned]), pa.array([len(token)]),
                 pa.array([token_data(words, kind, size)], pa.binary()),
                 *[pa.ListArray.from_arrays(pa.array([0, len(size)], pa.int32()), c) for c in columns]],
                names=["slice", "learned", "tokens", "data", *own])

        for batch in slices(batches, "t"):
            flag = batch.column("learned").to_numpy(zero_copy_only=False).astype(bool)
            for learned in (True, False):
                some = batch.filter(pa.array(flag == learned))
                if some.num_rows:
                    token, bounds = tokens(texts_of(some, "t"))
                    held[learned].append((token, np.diff(bounds), some.select(own)))
                    if sum(len(p[0]) for p in held[learned]) >= most:
                        yield out(learned)
        for learned in (True, False):
            if held[learned]:
                yield out(learned)

    return texts.mapInArrow(run, schema)


# --- asking and answering --------------------------------------------------------------

@dataclass(frozen=True)
class Plan:
    parts: int
    rounds: int

    @classmethod
    def of(cls, tokens: int, rounds: int) -> Plan:
        """Of at most so many rounds, fewer for a corpus of few slices."""
        return cls(max(32, -(-tokens // PART_KEYS)), min(rounds, 1 + tokens // SLICE_TOKENS))

    def of_round(self, key: np.ndarray, number: int) -> np.ndarray:
        """Which of the keys are asked for in a round."""
        return key % U64(self.rounds) == U64(number)

    def pieces(self, number: int, key: np.ndarray, counts: list[np.ndarray]) -> pa.RecordBatch:
        """The request of a slice: sorted keys, with what it has counted, or nothing to learn."""
        ends = np.array([((p + 1 << 64) - 1) // self.parts for p in range(self.parts - 1)], U64)
        cut = [0, *np.searchsorted(key, ends, "right").tolist(), len(key)]
        some = [p for p in range(self.parts) if cut[p] < cut[p + 1]]
        at = [slice(cut[p], cut[p + 1]) for p in some]
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([number] * len(some), pa.int64()),
             pa.array([packed_keys(key[x]) for x in at], pa.binary()),
             pa.array([packed(*[c[x] for c in counts]) if counts else None for x in at], pa.binary())],
            names=["part", "slice", "keys", "counts"])

    def answered(self, rows: pa.Table, key: np.ndarray) -> list[np.ndarray]:
        """What the answers to a slice say of its sorted keys."""
        by_round: dict[int, list[tuple[int, bytes]]] = {}
        for number, part, data in zip(*[rows.column(c).to_pylist() for c in ("round", "part", "data")]):
            by_round.setdefault(number, []).append((part, data))
        out: list[np.ndarray] = []
        for number, pieces in by_round.items():
            place = np.flatnonzero(self.of_round(key, number))
            for k, x in enumerate(zip(*[unpacked(data) for _, data in sorted(pieces)])):
                if k == len(out):
                    out.append(np.zeros(len(key), np.int64))
                out[k][place] = np.concatenate(x)
        return out


REQUEST = "part int, slice long, keys binary, counts binary"


def totals(requests: DataFrame, number: int, values: list[np.ufunc],
           census: Callable[[list[np.ndarray]], list[int]],
           decide: Callable[[list[np.ndarray]], list[np.ndarray]] | None = None) -> DataFrame:
    """Per part and slice what all counts of its keys come to, by these functions, or what is decided
    from that, and whether it owns each key; with a slice of -1 the census of a part's keys."""

    def answer(key: tuple, rows: pa.Table) -> pa.Table:
        part = key[0].as_py()
        found = sorted(zip(*[rows.column(c).to_pylist() for c in ("slice", "keys", "counts")]))
        learned = [(s, unpacked_keys(k), unpacked(c)) for s, k, c in found if c is not None]
        out = []
        if learned:
            every = np.concatenate([k for _, k, _ in learned])
            order = np.argsort(every, kind="stable")        # sorted runs, of which the first owns
            ordered = every[order]
            new = np.ones(len(every), bool)
            new[1:] = ordered[1:] != ordered[:-1]
            starts, known = np.flatnonzero(new), ordered[new]
            kind = np.empty(len(every), np.int64)
            kind[order] = np.cumsum(new) - 1
            sums = []
            for k, add in enumerate(values):
                x = np.concatenate([c[k] for _, _, c in learned])[order]
                sums.append(add.reduceat(x if x.dtype.kind == "f" else x.astype(np.int64), starts))
            sums = decide(sums) if decide else sums
            owns = np.zeros(len(every), np.int64)
            owns[order[new]] = 1
            at = 0
            for s, k, _ in learned:
                own = slice(at, at + len(k))
                out.append((s, packed(*[x[kind[own]] for x in sums], owns[own])))
                at += len(k)
        else:
            known, sums = np.zeros(0, U64), [np.zeros(0, np.int64)] * len(values)
            sums = decide(sums) if decide else sums
        none = np.zeros(0, np.int64)
        for s, k in [(s, unpacked_keys(k)) for s, k, c in found if c is None]:
            if len(known):
                at = np.minimum(np.searchsorted(known, k), len(known) - 1)
                hit = known[at] == k
                out.append((s, packed(*[np.where(hit, x[at], 0) for x in sums], np.zeros(len(k), np.int64))))
            else:
                out.append((s, packed(*[np.zeros(len(k), np.int64)] * (len(sums) + 1))))
        out.append((-1, packed(np.array(census(sums), np.int64), none)))
        return pa.table({"slice": pa.array([s for s, _ in out], pa.int64()),
                         "round": pa.array([number] * len(out), pa.int32()),
                         "part": pa.array([part] * len(out), pa.int32()),
                         "data": pa.array([d for _, d in out], pa.binary())})

    return requests.groupBy("part").applyInArrow(answer, ANSWER)


def in_rounds(asked: Callable[[int], DataFrame], values: list[np.ufunc], rounds: int, name: str,
              census: Callable[[list[np.ndarray]], list[int]],
              decide: Callable[[list[np.ndarray]], list[np.ndarray]] | None = None) -> tuple[DataFrame, np.ndarray]:
    """(the answers to what is asked in each round, the sum of all censuses)."""
    made, counted = [], None
    for number in range(rounds):
        rows = materialize(totals(asked(number), number, values, census, decide), name)
        release(rows.sparkSession)
        for r in rows.where("slice = -1").select("data").toLocalIterator():
            x = unpacked(bytes(r["data"]))[0].astype(np.int64)
            counted = x if counted is None else counted + x
        made.append(rows.where("slice >= 0"))
    return functools.reduce(DataFrame.unionAll, made), np.zeros(8, np.int64) if counted is None else counted


def _once(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and their times."""
    key = np.sort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    return key[new], np.diff(np.append(np.flatnonzero(new), len(key)))


def asked_by(found: DataFrame, keys: Callable[[bytes], np.ndarray], number: int, plan: Plan) -> DataFrame:
    """What slices ask in a round for their keys; those that are learned from count their times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, learned, data in zip(*[batch.column(c).to_pylist() for c in ("slice", "learned", "data")]):
                key = keys(data)
                key, times = _once(key[plan.of_round(key, number)])
                yield plan.pieces(row, key, [times] if learned else [])
    return found.select("slice", "learned", "data").mapInArrow(run, REQUEST)


def with_answers(found: DataFrame, answers: DataFrame, run: Callable, schema: str | T.StructType, name: str,
                  parts: int, by: str | None = None) -> DataFrame:
    """run(key, slice, its answers) of every slice, for a part of the slices at a time: what is
    shuffled for one is gone before the next."""
    made = []
    for part in range(parts):
        some = found.where(F.pmod(F.xxhash64("slice"), F.lit(parts)) == part)
        mine = answers.join(F.broadcast(some.select("slice")), "slice", "left_semi")
        made.append(materialize(some.groupBy("slice").cogroup(mine.groupBy("slice")).applyInArrow(run, schema), name, by))
        release(found.sparkSession)
    return functools.reduce(DataFrame.unionAll, made)
