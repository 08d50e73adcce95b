"""Similarity self-join of documents on word shingles, exact at a Jaccard bound.

A document is the set of its distinct shingles, as 64-bit hashes. Equal sets are one class and
are joined by their representative. Two sets of similarity t share a shingle among the first
|x| - ceil(t |x|) + 1 of each, in any common order; the order used puts frequent shingles
last, so that what many documents share seldom makes candidates. Documents that share such a
prefix shingle form a tile, cut into size bands (a partner's size lies between t and 1/t of
one's own, hence in the same or the next band).

Within a tile, first every member meets a few leaders: a fixed number of pairs a member. Verified
links are contracted to components, and only pairs from different components, which no
leader has settled, meet after that. So a large group of near copies makes pairs in
proportion to its size, and no link between different components is missed.

A pair is verified in two steps: parity bitmaps of hashed shingles, whose differing bits bound
the overlap from above, and the exact intersection of the sorted arrays.

Cases: texts without words, empty or NULL have an empty set and link with nothing. Fewer
words than a shingle make one shingle of all. NULL ids are documents of their own and never
name a component unless all its ids are NULL. Repeated rows are linked like other copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, release
from .common import U64, Tally, as_i64, encoded, lists, mix, shingle_hashes, ship, slices, texts_of, word_hashes
from .components import connected


@dataclass(frozen=True)
class Settings:
    width: int = 5                # words a shingle
    percent: int = 80             # least similarity, in percent
    leaders: int = 4              # members of a tile that every other member meets first
    small_tile: int = 16          # members of a tile whose pairs are met without a bitmap first
    task_count: int = 8           # a shingle of so many documents in one task may be frequent
    total_count: int = 32         # and with so many in all it is
    frequent_most: int = 1_000_000   # only the most frequent are told apart; bounds a broadcast
    filter_most: int = 2_000_000  # ids or class keys that may be broadcast; more go by a join


def shingle_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of every text, flat, with the bounds of each text."""
    words, bounds, _, _ = word_hashes(encoded(texts))
    runs, cuts = shingle_hashes(words, bounds, width)
    parts = [np.unique(runs[a:b]) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    flat = np.concatenate(parts) if parts else np.zeros(0, U64)
    return flat, np.concatenate(([0], np.cumsum(sizes)))


def set_keys(flat: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for each set: two sums of differently mixed shingles."""
    out = []
    for salt in (U64(0x243F6A8885A308D3), U64(0x13198A2E03707344)):
        total = np.concatenate((np.zeros(1, U64), np.cumsum(mix(flat ^ salt), dtype=U64)))
        out.append(as_i64(total[bounds[1:]] - total[bounds[:-1]]))
    return out[0], out[1]


def bitmap(shingles: np.ndarray) -> bytes:
    """The parity of the shingles that share a bit, in as many bits or more, a power of two."""
    bits = max(64, 1 << int(len(shingles) - 1).bit_length()) if len(shingles) else 64
    flags = np.bincount((shingles & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flags.astype(np.uint8), bitorder="little").tobytes()


def short_bitmaps(flat: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """1,024 bits per set, as 16 longs, for use inside a join condition."""
    count = len(bounds) - 1
    flags = np.zeros((count, 1024), dtype=bool)
    owner = np.repeat(np.arange(count), np.diff(bounds))
    flags[owner, (flat >> U64(20) & U64(1023)).astype(np.int64)] = True
    longs = np.packbits(flags, axis=1, bitorder="little").view(np.int64).ravel()
    return lists(longs, np.arange(count + 1) * 16, pa.int64())


def overlap_bound(left: bytes, right: bytes, n_left: int, n_right: int) -> int:
    """No more shingles than this are in both: what both have cancels out, so every bit that
    differs is one shingle at least that only one side has."""
    a, b = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
    size = min(len(a), len(b))
    a = np.bitwise_xor.reduce(a.reshape(-1, size), axis=0)     # fold to the shorter map
    b = np.bitwise_xor.reduce(b.reshape(-1, size), axis=0)
    return (n_left + n_right - int(np.bitwise_count(a ^ b).sum())) // 2


def enough(shared: int, n_left: int, n_right: int, percent: int) -> bool:
    return 100 * shared >= percent * (n_left + n_right - shared)


# --- passes over the texts -------------------------------------------------------------

def frequent_shingles(texts: DataFrame, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, document counts) of shingles that many documents share, most of them first
    counted within a task. They only order the prefixes: leaving one out costs time, never a link."""
    width, least = settings.width, settings.task_count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(U64, 1, drop_singles=True)
        for batch in slices(batches, "t"):
            flat, _ = shingle_sets(texts_of(batch, "t"), width)
            tally.add(flat, np.ones(len(flat), np.int64))
        tally.merge()
        keep = tally.sums[0] >= least
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(as_i64(tally.keys[keep])), pa.array(tally.sums[0][keep])], names=["token", "n"])

    found = (texts.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
             .where(F.col("n") >= settings.total_count)
             .orderBy(F.desc("n"), "token").limit(settings.frequent_most).toArrow())
    token = found.column("token").to_numpy().astype(np.int64).view(U64)
    times = found.column("n").to_numpy().astype(np.int64)
    order = np.argsort(token)
    return token[order], times[order]


def _features(texts: DataFrame, frequent, settings: Settings) -> DataFrame:
    """(uid, doc_id, n, s1, s2, bits, short, rare, hot): set size, key and bitmaps, and the prefix,
    parted into shingles that are not known as frequent and those that are."""
    shared = texts.sparkSession.sparkContext.broadcast(frequent)
    width, percent = settings.width, settings.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, times = shared.value
        uid = TaskContext.get().partitionId() << 33
        for batch in slices(batches, "t"):
            flat, bounds = shingle_sets(texts_of(batch, "t"), width)
            s1, s2 = set_keys(flat, bounds)
            at = np.minimum(np.searchsorted(token, flat), max(0, len(token) - 1))
            hot = token[at] == flat if len(token) else np.zeros(len(flat), bool)
            count = np.where(hot, times[at], 0) if len(token) else np.zeros(len(flat), np.int64)
            size = np.diff(bounds)
            length = np.where(size > 0, size - (percent * size + 99) // 100 + 1, 0)
            rare_parts, hot_parts = [], []
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                order = np.argsort(count[a:b], kind="stable")[:length[i]] + a
                rare_parts.append(flat[order[~hot[order]]])
                hot_parts.append(flat[order[hot[order]]])
            bits = [bitmap(flat[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(uid, uid + batch.num_rows)), batch.column("d"), pa.array(size),
                 pa.array(s1), pa.array(s2), pa.array(bits, pa.binary()), short_bitmaps(flat, bounds),
                 _ragged(rare_parts), _ragged(hot_parts)],
                names=["uid", "doc_id", "n", "s1", "s2", "bits", "short", "rare", "hot"])
            uid += batch.num_rows

    return texts.mapInArrow(run, "uid long, doc_id long, n long, s1 long, s2 long, bits binary, "
                                 "short array<long>, rare array<long>, hot array<long>")


def _ragged(parts: list[np.ndarray]) -> pa.Array:
    bounds = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    return lists(as_i64(np.concatenate(parts) if parts else np.zeros(0, U64)), bounds, pa.int64())


def _sets(texts: DataFrame, wanted: DataFrame, settings: Settings) -> DataFrame:
    """(s1, s2, shingles) of the wanted classes (uid, s1, s2), and maybe of others that share an
    s1 with them, made again from the texts."""
    keys = None
    if wanted.count() <= settings.filter_most:            # else every text passes on to the join
        keys = np.sort(wanted.select("s1").toArrow().column(0).to_numpy())
    shared = texts.sparkSession.sparkContext.broadcast(keys)
    width = settings.width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = shared.value, set()
        for batch in slices(batches, "t"):
            flat, bounds = shingle_sets(texts_of(batch, "t"), width)
            s1, s2 = set_keys(flat, bounds)
            rows = np.arange(len(s1)) if known is None else np.flatnonzero(
                known[np.minimum(np.searchsorted(known, s1), len(known) - 1)] == s1) \
                if len(known) else np.zeros(0, int)
            out = []
            for i in rows.tolist():
                if (s1[i], s2[i]) in seen:
                    continue
                if len(seen) < 1 << 20:
                    seen.add((s1[i], s2[i]))
                out.append(i)
            parts = [flat[bounds[i]:bounds[i + 1]] for i in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(s1[out]), pa.array(s2[out]), _ragged(parts)], names=["s1", "s2", "shingles"])

    made = texts.mapInArrow(run, "s1 long, s2 long, shingles array<long>")
    return made.groupBy("s1", "s2").agg(F.first("shingles").alias("shingles"))


# --- pairs -----------------------------------------------------------------------------

def _verified(pairs: DataFrame, rows: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """Those of the pairs (a, b) that are similar. Shingles are fetched only for pairs whose
    bitmaps leave it open."""
    percent = settings.percent

    def side(df: DataFrame, name: str, *columns: str) -> DataFrame:
        return df.select(F.col("uid").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("bits_a", "bits_b", "n_a", "n_b")))
            keep = [enough(max(0, overlap_bound(x, y, n, m)), n, m, percent) for x, y, n, m in rows]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(c) for c in ("shingles_a", "shingles_b"))
            sides = []
            for column in (left, right):
                cut = column.offsets.to_numpy()
                flat = column.values.to_numpy()
                sides.append([flat[x:y] for x, y in zip(cut[:-1], cut[1:])])
            keep = [enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent)
                    for x, y in zip(*sides)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    near = (pairs.join(side(rows, "b", "n", "bits"), "b").join(side(rows, "a", "n", "bits"), "a")
            .mapInArrow(bounded, "a long, b long"))
    near = materialize(near, "near")
    ends = near.select(F.explode(F.array("a", "b")).alias("uid")).distinct()
    wanted = materialize(ends.join(rows.select("uid", "s1", "s2"), "uid"), "wanted")
    sets = _sets(texts, wanted, settings)
    keyed = near
    for end in ("a", "b"):
        keyed = keyed.join(side(wanted, end, "s1", "s2"), end)
    # The arrays stay where the aggregate has them, by (s1, s2), and are shuffled with the pairs once.
    for end in ("b", "a"):
        keyed = keyed.join(sets.select(*[F.col(c).alias(f"{c}_{end}") for c in sets.columns]), [f"s1_{end}", f"s2_{end}"])
    return keyed.mapInArrow(exact, "a long, b long")


def _tiles(reps: DataFrame, leaders: int) -> DataFrame:
    """(token, uid, n, leaders) of prefix shingles that two classes or more share. The leaders
    are the first members in so many different orders; different tokens of one group name
    different leaders, since their members differ."""
    heads = [F.min(F.struct((F.xxhash64("uid", F.lit(k)) if k else F.col("uid")).alias("o"), "uid", "n"))
             for k in range(leaders)]
    # Dealt out before the orders are worked out, so that a row is shuffled with three numbers.
    rare = reps.select(F.explode("rare").alias("token"), "uid", "n").repartition("token")
    over = Window.partitionBy("token")                     # few documents each, by construction
    rare = rare.select("token", "uid", "n", F.max("uid").over(over).alias("last"),
                       *[h.over(over).alias(f"l{k}") for k, h in enumerate(heads)])
    hot = reps.select(F.explode("hot").alias("token"), "uid", "n")
    named = hot.groupBy("token").agg(F.max("uid").alias("last"),
                                     *[h.alias(f"l{k}") for k, h in enumerate(heads)])
    hot = hot.join(named, "token").select(*rare.columns)
    every = F.array_distinct(F.array(*[F.struct(F.col(f"l{k}.uid").alias("uid"), F.col(f"l{k}.n").alias("n"))
                                       for k in range(leaders)]))
    return rare.unionAll(hot).where(F.col("l0.uid") != F.col("last")).select(
        "token", "uid", "n", every.alias("leaders"))


def _across(rows: DataFrame, percent: int, extra: list[str], condition) -> DataFrame:
    """Pairs (a, b) of one tile, in the same or the next size band, whose roots differ."""
    low = rows.select("token", "band", *[F.col(c).alias(f"{c}_a") for c in ("uid", "n", "root", *extra)])
    high = rows.select("token", F.explode(F.array(F.col("band"), F.col("band") - 1)).alias("band"),
                       *[F.col(c).alias(f"{c}_b") for c in ("uid", "n", "root", *extra)])
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("uid_a") < F.col("uid_b")))
    pairs = low.withColumnRenamed("token", "at").withColumnRenamed("band", "in").join(
        high, (F.col("at") == F.col("token")) & (F.col("in") == F.col("band")) & ordered
        & (F.col("root_a") != F.col("root_b")) & _alike("n_a", "n_b", percent) & condition)
    return pairs.select(F.col("uid_a").alias("a"), F.col("uid_b").alias("b"))


def _alike(small: str, large: str, percent: int):
    return 100 * F.col(small) >= percent * F.col(large)


def similar_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                   settings: Settings = Settings()) -> DataFrame:
    """(uid, doc_id, n_shingles, component_id): each row's set size, and the smallest doc_id
    that links reach from it."""
    ship(docs.sparkSession)
    percent = settings.percent
    texts = docs.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t"))
    frequent = frequent_shingles(texts.select("t"), settings)
    rows = materialize(_features(texts, frequent, settings), "sets")

    thin = rows.select("uid", "doc_id", "n", "s1", "s2")
    copies = (thin.where("n > 0").groupBy("n", "s1", "s2")
              .agg(F.min("uid").alias("rep"), F.count(F.lit(1)).alias("c")).where("c > 1").drop("c"))
    members = materialize(
        thin.join(copies, ["n", "s1", "s2"], "left").withColumn("rep", F.coalesce("rep", "uid")),
        "members")
    others = members.where("uid <> rep").select("uid")
    if others.count() <= settings.filter_most:
        others = F.broadcast(others)
    reps = rows.where("n > 0").join(others, "uid", "left_anti")
    tiles = materialize(_tiles(reps, settings.leaders), "tiles")
    release(docs.sparkSession)

    led = tiles.select("uid", "n", F.explode("leaders").alias("l")).where(
        (F.col("l.uid") != F.col("uid")) & (100 * F.col("n") >= percent * F.col("l.n"))
        & (100 * F.col("l.n") >= percent * F.col("n")))
    first = led.select(F.least("uid", "l.uid").alias("a"), F.greatest("uid", "l.uid").alias("b")).distinct()
    labels = connected(_verified(first, rows, texts.select("t"), settings))
    release(docs.sparkSession)

    placed = tiles.join(labels.withColumnRenamed("node", "uid"), "uid", "left").withColumn(
        "root", F.coalesce("root", "uid"))
    open_tiles = placed.groupBy("token").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"),
        (F.count(F.lit(1)) > settings.small_tile).alias("large")).where("lo <> hi").select("token", "large")
    settled = F.exists("leaders", lambda l: l["uid"] == F.col("uid"))
    rest = placed.where(~settled).join(open_tiles, "token").withColumn(
        "band", F.floor(F.log(100.0 / percent, F.col("n"))).cast("long"))
    rest = materialize(rest.select("token", "large", "band", "uid", "n", "root"), "open")
    small = _across(rest.where("NOT large"), percent, [], F.lit(True))
    large = rest.where("large")
    some = large.groupBy("uid").agg(F.slice(F.sort_array(F.collect_set("token")), 1, 8).alias("t"))
    large = large.join(some, "uid").join(rows.select("uid", F.col("short").alias("f")), "uid")
    # A pair is met in one tile only where both name it, and only if the bitmaps allow a link.
    once = F.expr("coalesce(array_min(array_intersect(t_a, t_b)), token) = token")
    miss = "aggregate(zip_with(f_{0}, f_{1}, (x, y) -> bit_count(x & ~y)), 0, (s, v) -> s + v)"
    shared = F.expr(f"least(n_a - {miss.format('a', 'b')}, n_b - {miss.format('b', 'a')})")
    allowed = 100 * shared >= percent * (F.col("n_a") + F.col("n_b") - shared)
    across = small.unionAll(_across(large, percent, ["t", "f"], allowed & once)).distinct()
    found = _verified(across, rows, texts.select("t"), settings)
    for end in ("a", "b"):
        found = found.join(labels.withColumnRenamed("node", end), end, "left").withColumn(
            end, F.coalesce("root", end)).drop("root")
    second = connected(found.select("a", "b"))

    final = labels.join(second.select(F.col("node").alias("root"), F.col("root").alias("top")),
                        "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    alone = second.join(labels.select("node"), "node", "left_anti").select("node", "root")
    rooted = members.join(final.unionAll(alone).withColumnRenamed("node", "rep"), "rep", "left").select(
        "uid", "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "rep").alias("root"))
    rooted = materialize(rooted, "rooted")
    groups = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("c"))
    named = rooted.join(groups.where("c > 1").drop("c"), "root", "left")
    return named.select("uid", "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
