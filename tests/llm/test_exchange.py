"""Counts exchanged as arrays, and what uses them, on small inputs."""

import collections
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import exchange, kneser_ney, suffix_tree
from barloom.llm.common import U64
from barloom.session import collecting


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string")


@pytest.mark.parametrize("n", [0, 1, 5, 3000])
def test_arrays_come_back_from_bytes(n):
    rng = np.random.default_rng(n)
    key = np.unique(np.append(rng.integers(0, 1 << 63, n).astype(U64) * U64(2), np.array([0, 2**64 - 1][:n], U64)))
    assert exchange.unpacked_keys(exchange.packed_keys(key)).tolist() == key.tolist()
    numbers = [rng.integers(0, 1 << k, n) for k in (1, 9, 17, 40)]
    assert [x.tolist() for x in exchange.unpacked(exchange.packed(*numbers))] == [x.tolist() for x in numbers]
    token = rng.integers(0, 900, n + 1).astype(U64)
    words, _, kind = exchange.distinct(token)
    words, kind, size = exchange.token_arrays(exchange.token_data(words, kind, np.array([n + 1])))
    assert words[kind].tolist() == token.tolist() and size.tolist() == [n + 1]


def test_totals_are_those_of_all_slices_that_learn(spark):
    random.seed(2)
    plan = exchange.Plan(3, 2)
    asked = {s: collections.Counter(random.choices(range(1 << 62, 1 << 64, (1 << 56) + 1), k=150)) for s in range(6)}
    learned = {0, 2, 5}

    def requests(number):
        rows = []
        for s, c in asked.items():
            key = np.array(sorted(c), U64)
            key = key[plan.of_round(key, number)]
            counts = [np.array([c[int(k)] for k in key])] if s in learned else []
            rows += plan.pieces(s, key, counts).to_pylist()
        return spark.createDataFrame(rows, exchange.REQUEST)

    answers, census = exchange.in_rounds(requests, [np.add], plan.rounds, "totals", lambda sums: [len(sums[0]), sums[0].sum()])
    want = sum((asked[s] for s in sorted(learned)), collections.Counter())
    assert census.tolist() == [len(want), want.total()]
    owners = collections.Counter()
    for s, c in asked.items():
        key = np.array(sorted(c), U64)
        total, own = plan.answered(answers.where(F.col("slice") == s).toArrow(), key)
        assert total.tolist() == [want[int(k)] for k in key]
        owners.update(key[own > 0].tolist())
        assert s in learned or not own.any()
    assert owners == collections.Counter(want.keys())


def test_nested_blocks_collect_folders_of_their_own():
    with collecting() as outer:
        with collecting() as inner:
            pass
        assert outer == [] and inner == []


def test_large_models_leave_no_counts_on_disk(spark):
    """The counts of all trigrams, pairs and words were kept as tables until the session ended."""
    random.seed(7)
    texts = [" ".join(random.choice("abcdefgh") * random.randint(1, 3) for _ in range(40)) for _ in range(50)]
    docs = frame(spark, [*texts, "a b unseen c d e", "unseen", "", None])
    settings = kneser_ney.Settings(broadcast_entries=0, rounds=2)
    with collecting() as folders:
        got = kneser_ney.classify(docs, docs.select("doc_id").limit(30), settings=settings).collect()
    near = kneser_ney.classify(docs, docs.select("doc_id").limit(30)).collect()
    want = {r["doc_id"]: r["perplexity"] for r in near}
    assert {r["doc_id"]: r["perplexity"] for r in got} == pytest.approx(want, rel=1e-4)
    left = {name for folder in folders if os.path.isdir(folder) for name in os.listdir(folder)}
    assert left <= {"chosen", "scores", "thresholds"}


def test_trees_are_the_same_by_many_slices_and_leave_no_counts_on_disk(spark):
    """Counts of words, grams and states were kept as tables until the session ended."""
    texts = [" ".join(random.Random(i).choice(["a b c", "c d", "x b d", f"e{i % 7}"]) for _ in range(40))
             for i in range(80)]
    docs = frame(spark, [*texts, "", None, "never seen"])
    got = []
    for most in (1 << 20, 300):
        with collecting() as folders:
            rows = suffix_tree.score(docs, F.col("doc_id") % 3 > 0, settings=suffix_tree.Settings(slice_tokens=most))
            got.append({r["doc_id"]: (r["n_known"], r["base_score"], r["score"]) for r in rows.collect()})
        left = {name for folder in folders if os.path.isdir(folder) for name in os.listdir(folder)}
        assert left == {"kept"}
    assert all(got[1][i] == pytest.approx(row, rel=1e-9) for i, row in got[0].items()) and len(got[0]) == 83
