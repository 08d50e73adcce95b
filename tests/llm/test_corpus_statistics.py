"""Spelling variants, quality rules and resampling against brute force on small inputs."""

import collections
import dataclasses
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from conftest import rows
from pyspark.sql import functions as F

from barloom.llm import quality_rules, spelling_variants, target_resampling
from barloom.llm.ngram_table import Runs

DOCS = "doc_id long, text string, lang string, word string, row long, t string, score long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, texts, ids=None, langs=None):
    ids = range(len(texts)) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    return spark.createDataFrame([(i, t, g, "x", 1, "y", 2) for i, t, g in zip(ids, texts, langs)], DOCS)


def sample_texts(n, seed, letters="abcdeé", extra=("Ü9", "x-y", "\t", "\n", "$$", "×÷", "ÀÉ", "日本", "\x00", "\x85")):
    rng = random.Random(seed)
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    return [" ".join(rng.choice(words if rng.random() < 0.9 else extra) for _ in range(rng.randint(0, 60)))
            for _ in range(n)]


# --- interned n-grams ------------------------------------------------------------------

@pytest.fixture(scope="module")
def stretches():
    rng = random.Random(1)
    size = [0, 1, 2, 3, 4, 5, 7, 8, 9, 12, 15, 16, 17, 24, 31, 32, 33, 40, 100]
    words = [bytes(rng.randrange(256) for _ in range(rng.choice(size))) for _ in range(500)]
    chosen = [rng.choice(words) for _ in range(4000)]
    length = np.array([len(c) for c in chosen])
    return chosen, Runs(np.frombuffer(b"".join(chosen), dtype=np.uint8)), np.cumsum(length) - length, length


def test_hashes_of_stretches_equal_the_libraries(stretches):
    chosen, runs, start, length = stretches
    assert runs.xxh64(start, length).tolist() == [xxhash.xxh64_intdigest(c) for c in chosen]
    own = runs.crc32(start, length)
    assert own.tolist() == [zlib.crc32(c) for c in chosen]
    before = [f"{i}:".encode() for i in range(len(chosen))]
    after = runs.crc32_after(np.array([zlib.crc32(b) for b in before], dtype=np.uint32), own, start, length)
    assert after.tolist() == [zlib.crc32(b + c) for b, c in zip(before, chosen)]


@pytest.mark.parametrize("key", [None, 0, 3])
def test_equal_bytes_share_a_slot_even_if_all_keys_collide(stretches, key):
    chosen, runs, start, length = stretches
    keys = None if key is None else np.full(len(chosen), key, dtype=np.uint64)
    slot, holder = runs.intern(start, length, keys)
    seen = {}
    assert all(seen.setdefault(c, s) == s for c, s in zip(chosen, slot.tolist()))
    assert len(seen) == len(set(seen.values())) == len(holder)
    assert [chosen[i] for i in holder] == [next(c for c, s in seen.items() if s == k) for k in range(len(holder))]


# --- resampling ------------------------------------------------------------------------

def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def features_of(text):
    words = words_of(text)
    return words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def drawn(docs, targets, settings=target_resampling.Settings()):
    k = settings.buckets
    bucket = lambda f: zlib.crc32(f.encode()) % k
    s = collections.Counter(bucket(f) for _, t in docs for f in features_of(t))
    t = collections.Counter(bucket(f) for x in targets for f in features_of(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + k) / ((s[b] + 1) * (all_t + k))))
    out, able = [], []
    for i, text in docs:
        found = features_of(text)
        weight = sum(gain(bucket(f)) for f in found) // max(1, len(found))
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{settings.seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if len(words_of(text)) >= settings.least_words:
                able.append((-score, i))
        out.append([i, len(found), weight, score])
    take = settings.share * len(able) // 100
    place = {i: n + 1 for n, (_, i) in enumerate(sorted(able)[:take])}
    return sorted(((*row, place.get(row[0])) for row in out), key=lambda r: [(v is not None, str(v)) for v in r])


def resampled(docs, targets, **settings):
    return rows(target_resampling.resample(docs, targets, settings=target_resampling.Settings(**settings)).select(
        "doc_id", "n_features", "weight", "score", "rank"))


def test_resampling_equals_brute_force(spark):
    texts = [*sample_texts(300, 1), None, "", "...", "a", "ab " * 30, "É" * 50, "word " * 9000]
    targets = [*sample_texts(20, 2), None, ""]
    got = resampled(frame(spark, texts).repartition(5), spark.createDataFrame([(t,) for t in targets], "text string"))
    assert got == drawn(list(enumerate(texts)), targets)
    assert 40 < sum(r[4] is not None for r in got) < 80


def test_resampling_of_ties_and_odd_rows(spark):
    few = target_resampling.Settings(buckets=3, share=50, least_words=2)
    texts = ["one two three"] * 40 + [None, "two"]
    ids = [*range(38), None, None, 40, 41]
    got = resampled(frame(spark, texts, ids), spark.createDataFrame([("two",)], "text string"),
                    **dataclasses.asdict(few))
    assert got == drawn(list(zip(ids, texts)), ["two"], few)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 20))


def test_resampling_of_empty_tables(spark):
    nothing = frame(spark, ["x"]).where("false")
    some = frame(spark, ["a b c " * 10] * 8)
    assert resampled(nothing, some) == []
    got = resampled(some, nothing)
    assert len(got) == 8 and sum(r[4] is not None for r in got) == 2


def test_rows_that_repeat_an_id_are_ranked_each(spark):
    got = resampled(frame(spark, ["a b c " * 10] * 8, [1] * 8), frame(spark, ["a"]))
    assert sorted(r[4] or 0 for r in got) == [0] * 6 + [1, 2]


# --- spelling variants -----------------------------------------------------------------

def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) < len(b):
        a, b = b, a
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def vocabulary_of(docs, settings):
    counts = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if settings.typo_modulus and h % settings.typo_modulus == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= settings.least_length and n >= settings.least_count}


def variants(docs, settings):
    words = vocabulary_of(docs, settings)
    form, out = {}, []
    for w, n in words.items():
        close = sorted((-words[v], v) for v in words if near(w, v))
        if close and -close[0][0] >= settings.ratio * n:
            form[w] = close[0][1]
        out.append([w, n, len(close)])
    for row in out:
        root = row[0]
        while root in form:
            root = form[root]
        f = form.get(row[0])
        row += [f, words[f] if f else None, root]
    return sorted(map(tuple, out), key=lambda t: [(v is not None, str(v)) for v in t])


def varied_texts(seed, n=400):
    """Words of few letters with copies of all ranks of frequency, many one edit apart."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("aÀb") for _ in range(rng.randint(5, 7))) for _ in range(250)]
    weights = [1 / (k + 1) ** 1.3 for k in range(len(words))]
    return [" ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w
                     for w in rng.choices(words, weights, k=rng.randint(0, 80))) for _ in range(n)]


@pytest.mark.parametrize("settings", [
    {}, {"typo_modulus": 7, "ratio": 2}, {"typo_modulus": 0, "ratio": 2, "held": 5},
    {"typo_modulus": 5, "filter_bytes": 256}, {"least_length": 2, "filter_bytes": 256, "bits": 4}])
def test_variants_equal_brute_force(spark, settings):
    settings = spelling_variants.Settings(**settings)
    texts = [*varied_texts(3), None, "", "a" * 3000, "12 - \n", "a×÷b" * 3]
    ids = [*range(len(texts) - 1), None]
    docs = frame(spark, texts, ids).repartition(3)
    got = rows(spelling_variants.group_variants(docs, settings=settings).select(
        "word", "n", "n_near", "form", "form_n", "root"))
    assert got == variants(list(zip(ids, texts)), settings)
    assert sum(r[3] is not None for r in got) > 4 and max(r[2] for r in got) > 2


def test_chains_of_forms_are_followed_to_the_end(spark):
    words = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb"]
    texts = [" ".join([w] * (5 * 5 ** k)) for k, w in enumerate(words)]
    got = spelling_variants.group_variants(frame(spark, texts), settings=spelling_variants.Settings(typo_modulus=0))
    assert {r.word: r.root for r in got.collect()} == dict.fromkeys(words, "aabbbb")


def test_ties_between_near_words_go_to_the_smallest(spark):
    texts = ["aaaaaa " * 5, "aaaaaz " * 50, "aaaaaé " * 50, "aaaaa " * 99]
    got = spelling_variants.group_variants(frame(spark, texts), settings=spelling_variants.Settings(typo_modulus=0))
    assert {(r.word, r.form, r.n_near) for r in got.collect()} == {
        ("aaaaaa", "aaaaaz", 2), ("aaaaaz", None, 2), ("aaaaaé", None, 2)}


def test_a_long_word_has_all_its_neighbours(spark):
    long = "ab" * 20_000
    texts = [f"{long} {long}c {'z' + long[1:]} {long[:300]}b{long[300:]} " * 5]
    got = spelling_variants.group_variants(frame(spark, texts), settings=spelling_variants.Settings(typo_modulus=0))
    assert {(len(r.word), r.n_near) for r in got.collect()} == {(40_000, 3), (40_001, 1), (40_000, 1)}


def test_no_words_no_rows(spark):
    for docs in (frame(spark, ["short words 123", None]), frame(spark, ["x"]).where("false")):
        assert spelling_variants.group_variants(docs).count() == 0


def test_passes_divide_the_lengths():
    settings = spelling_variants.Settings(filter_bytes=800)
    alphabet = np.arange(3, dtype=np.uint8)
    passes = spelling_variants.plan([(9, 300, alphabet), (6, 1000, alphabet), (7, 10, alphabet)], settings)
    assert all(sum(s.blocks for s in p.values()) <= 100 for p in passes)
    parts = collections.Counter(n for p in passes for n in p)
    assert parts == {6: 3, 7: 1, 9: 1}
    assert sorted(p[6].part for p in passes if 6 in p) == [0, 1, 2]


# --- quality rules ---------------------------------------------------------------------

def base_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered))


def test_counted_rules_equal_brute_force():
    texts = [*sample_texts(200, 5, extra=("$$", "\n", "\n\n", "a b c", "|", "日本", "\x85", "\x1c", "é\r")), "", " ",
             "a", "a a", "a a a", "a a a a", "A a A a A", "x\nx\n x\nx", "\n\n", "a b\na b\na b"]
    got = quality_rules.counted([t.encode() for t in texts])
    assert list(zip(*[c.tolist() for c in got])) == [base_of(t) for t in texts]


def model_of(texts, order=5):
    """Interpolated modified Kneser-Ney from its definition."""
    edge = quality_rules.EDGE
    counts = {order: collections.Counter()}
    for t in texts:
        padded = edge * (order - 1) + t + edge
        counts[order].update(padded[i:i + order] for i in range(len(t) + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = collections.Counter(g[1:] for g in counts[n + 1])
    discount, context = {}, {}
    for n, c in counts.items():
        d = quality_rules.discounts([sum(v == k for v in c.values()) for k in (1, 2, 3, 4)])
        discount[n] = lambda v, d=d: d[min(v, 3) - 1]
        context[n] = collections.defaultdict(lambda: [0, 0.0])
        for g, v in c.items():
            context[n][g[:-1]][0] += v
            context[n][g[:-1]][1] += discount[n](v)

    def p(gram):
        n = len(gram)
        if n == 0:
            return 1 / (len(counts[1]) + 1)
        if gram[:-1] not in context[n]:
            return p(gram[1:])
        total, taken = context[n][gram[:-1]]
        v = counts[n].get(gram, 0)
        return (v - discount[n](v) if v else 0.0) / total + taken / total * p(gram[1:])

    def perplexity(t):
        padded = edge * (order - 1) + t + edge
        return math.exp(-sum(math.log(p(padded[i:i + order])) for i in range(len(t) + 1)) / (len(t) + 1))
    return p, perplexity


@pytest.mark.parametrize("entries", [10 ** 9, 0])
def test_perplexity_equals_brute_force(spark, entries):
    learn, asked = sample_texts(40, 6), [*sample_texts(30, 7, "abxy日é"), None, "", "🙂" * 9, quality_rules.EDGE]
    settings = quality_rules.Settings(broadcast_entries=entries, held=50)
    tables = quality_rules.fit(frame(spark, [*learn, None]).repartition(3), settings=settings)
    got = quality_rules.measure(frame(spark, asked).repartition(3), tables, settings=settings)
    assert got.columns == ["doc_id", "lang", *quality_rules.BASE, "perplexity"]
    _, want = model_of([*learn, ""])
    assert {r.doc_id: r.perplexity for r in got.collect()} == pytest.approx(
        {i: want(t or "") for i, t in enumerate(asked)}, rel=1e-9)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 500])
def test_hashes_are_found_by_their_leading_bits(n):
    rng = np.random.default_rng(n)
    last = np.uint64(0xFFFFFFFFFFFFFFFF)
    near = np.arange(n // 2, dtype=np.uint64) + np.uint64(1 << 63)               # all with the same leading bits
    keys = rng.permutation(np.concatenate([near, rng.integers(0, last, n - n // 2, np.uint64)]))
    for held in (keys, np.append(keys, [last, np.uint64(0)])):
        want = {int(k): i + 0.5 for i, k in enumerate(held)}
        asked = np.concatenate([held, near + np.uint64(n), rng.integers(0, last, 50, np.uint64), [last, np.uint64(0)]])
        found = quality_rules.Lookup(held, np.arange(len(held)) + 0.5).get(asked, -1.0)
        assert found.tolist() == [want.get(int(k), -1.0) for k in asked]


def test_only_grams_that_the_model_lacks_go_through_the_lower_orders(spark):
    learn = sample_texts(40, 6)
    arrays = quality_rules.Arrays.of(quality_rules.fit(frame(spark, learn)))
    asked = []
    for n, table in [*list(arrays.p.items())[:-1], *arrays.mass.items()]:
        table.get = lambda key, default, table=table: asked.append(len(key)) or type(table).get(table, key, default)
    _, want = model_of(learn)
    got = lambda texts: np.exp(-arrays.log_p(texts) / [len(t) + 1 for t in texts]).tolist()        # noqa: E731
    assert got(learn) == pytest.approx([want(t) for t in learn], rel=1e-9) and sum(asked) == 0
    other = [learn[0] + "\U0001F600"] * 9                 # two new grams, nine times each
    assert got(other) == pytest.approx([want(t) for t in other], rel=1e-9) and set(asked) == {0, 2}


def test_probabilities_sum_to_one():
    texts = sample_texts(30, 8, "abc")
    p, _ = model_of(texts)
    known = set("".join(texts)) | {quality_rules.EDGE}
    for context in ("", "a", "ab", "b ca", "zzzz"):
        assert sum(p(context + c) for c in known) + p(context + "\U0001F600") == pytest.approx(1)


def prose(n, seed, letters="abcdeg"):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(80))
            for _ in range(n)]


def test_bands_reject_by_language_and_leave_clean_text_alone(spark):
    clean, other = prose(60, 1), prose(60, 2, "mnopqr")
    junk = [t.replace(" ", "$$$ ") for t in prose(5, 3)]
    easy = [" ".join(f"a{'a' * (i % 7)}" * (1 + k % 3) for k in range(90)) for i in range(3)]
    odd = [None, "", "too short", "a b c " * 40]
    texts = [*clean, *other, *junk, *easy, *odd, prose(1, 9)[0]]
    langs = ["x"] * 60 + ["y"] * 60 + ["x"] * 5 + [None] * 3 + ["x"] * 4 + ["new"]
    docs = frame(spark, texts, langs=langs).repartition(4)
    trusted = spark.createDataFrame([(i, "z") for i in [*range(0, 120, 2), None, 0, 9999]], "doc_id long, word string")
    got = {r.doc_id: r for r in quality_rules.judge(docs, trusted).collect()}
    assert len(got) == len(texts)
    assert all(got[i].kept for i in [*range(120), len(texts) - 1])
    assert not any(got[i].kept for i in range(120, 128 + len(odd)))
    assert [got[i].base_failed for i in range(128, 132)] == [True] * 4
    assert not any(got[i].base_failed for i in range(125))
    assert got[0].upper != got[60].upper and got[len(texts) - 1].upper > 0


@pytest.mark.parametrize("words", [1, 4, 1 << 20])
def test_chosen_documents_are_exactly_those_named(spark, words):
    docs = spark.range(200).selectExpr("CASE WHEN id > 0 THEN id % 150 END AS doc_id", "'x' AS text")
    ids = spark.range(3, 400, 7)
    got = [r.doc_id for r in quality_rules.chosen(docs, ids, words).collect()]
    assert sorted(got) == sorted(i % 150 for i in range(1, 200) if i % 150 in range(3, 400, 7))


def test_without_trusted_text_every_band_is_open(spark):
    docs = frame(spark, [*prose(3, 1), None])
    nobody = spark.createDataFrame([], "doc_id long")
    got = {r.doc_id: r.kept for r in quality_rules.judge(docs, nobody).collect()}
    assert got == {0: True, 1: True, 2: True, 3: False}
    assert quality_rules.judge(docs.where("false"), nobody).count() == 0


def test_repeated_rows_are_judged_each(spark):
    docs = frame(spark, prose(1, 1) * 4, [1, 1, None, None])
    got = quality_rules.judge(docs, spark.createDataFrame([(1,)], "doc_id long"))
    assert got.where("kept").count() == 4 and got.where(F.col("doc_id").isNull()).count() == 2
