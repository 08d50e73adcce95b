"""Token counts, language, packing, decontamination, suffix tree and Kneser-Ney on small inputs."""

import collections
import itertools
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
import public_tokenizers
import tokenizers
from pyspark.sql import functions as F

from barloom.llm import (bpe, decontaminate, kneser_ney, language_id, packing, suffix_tree, token_counts)
from barloom.session import collecting

DOCS = "doc_id long, text string, lang string, _text string, n_tokens string"
ODD = ["'s", "'t", "'re", "'ve", "'ll", "'d", "'m", "'r", "'", "''", " ", "  ", "\n", "\n\n", "\t", "\x1c", "\x85", "a",
       "S", "'RE", "9", "42", "é", "é", "ß", "Σ", "İ", "中", "!", "..", "<|endoftext|>", "🙂", "e", "l", "v", "r",
       "\x00", "½", "_"]


def odd_texts(n):
    random.seed(3)
    return ["".join(random.choice(ODD) for _ in range(random.randint(0, 12))) for _ in range(n)]


def frame(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "x", "y") for i, t in enumerate(texts)], DOCS)


# --- token counts ----------------------------------------------------------------------

@pytest.fixture(scope="module")
def byte_file():
    return public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts_equal_the_library(byte_file):
    library = tokenizers.Tokenizer.from_file(byte_file)
    texts = odd_texts(4000) + [c * n for c in "a =1.é" for n in range(1, 60)]
    got = token_counts.Counter(byte_file).count(texts)
    assert got.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_chunk_maps_give_the_states_of_one_run():
    rng = np.random.default_rng(1)
    kinds = rng.integers(0, token_counts.CLASSES, 5000)
    step, _ = token_counts.splitter()
    state, states = 0, []
    for i, k in enumerate(kinds):
        if i % 100 == 0:
            states.append(state)
        state = int(step[state * token_counts.CLASSES + k])
    grid = np.ascontiguousarray(kinds.reshape(50, 100).T)
    assert token_counts.entry_states(grid).tolist() == states


def test_token_counts_on_odd_rows(spark, byte_file):
    df = frame(spark, ["hello world", None, "", "x" * 30_000, "hello world"])
    df = df.unionAll(spark.createDataFrame([(None, "one two", None, None, None)], DOCS))
    out = token_counts.count_tokens(df, byte_file)
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"]) for r in out.collect())
    assert [n for _, n in got][:4] == [2, 2, 0, 0] and got[4][1] > 100 and got[5][1] == 2
    assert out.columns == ["doc_id", "text", "lang", "_text", "n_tokens"]
    assert token_counts.count_tokens(df.limit(0), byte_file).count() == 0


# --- language --------------------------------------------------------------------------

def test_language_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language_id.fit_on(docs, ~held)
    rows = language_id.identify(docs.where(held), model).collect()
    right = sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows)
    assert right >= 0.9 and all(0 <= r["score"] <= 1 for r in rows)


def test_language_on_odd_rows(spark):
    learn = frame(spark, ["the of and", "that is the"] * 30).unionAll(
        frame(spark, ["der die das", "und der ist"] * 30, "de")).unionAll(frame(spark, ["x y"], None))
    model = language_id.fit_on(learn, F.lit(True))
    assert model.classes == ["de", "en"]
    texts = [None, "", "123 !?", "the and of", "und die das", "the " * 20_000]
    got = language_id.identify(frame(spark, texts), model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in got] == ["und", "und", "und", "en", "de", "en"]
    assert [r["accepted"] for r in got][:3] == [False] * 3
    none = language_id.fit_on(learn.limit(0), F.lit(True))
    assert [r["lang_pred"] for r in language_id.identify(frame(spark, ["a"]), none).collect()] == ["und"]


def test_language_sample_is_bounded(spark):
    df = frame(spark, [f"text {i}" for i in range(500)])
    assert len(language_id.labelled_sample(df, F.lit(True), "text", "lang", "doc_id", 20)) == 20


# --- packing ---------------------------------------------------------------------------

@pytest.fixture(scope="module")
def word_file():
    return public_tokenizers.path("word_bpe_49k.json")


def test_word_ids_equal_the_library(word_file):
    library = tokenizers.Tokenizer.from_file(word_file)
    texts = odd_texts(4000) + ["supercalifragilistic" * 20]
    got = packing.WordTokenizer(word_file).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("histogram", [
    {}, {1: 1}, {4096: 5, 1: 3}, {2049: 10, 2048: 3, 2047: 9}, {1: 20_000},
    {n: 3 for n in range(1, 4097, 7)}, {700: 100_000, 1300: 50_000, 33: 7},
])
def test_plan_holds_every_item_in_few_sequences(histogram):
    kinds = packing.plan(histogram)
    held = collections.Counter()
    for k in kinds:
        assert k.free >= 0 and sum(n * c for n, c in k.parts) + k.free == 4096
        for n, c in k.parts:
            held[n] += c * k.count
    assert held == {n: c for n, c in histogram.items() if c}
    plain = packing.plan(histogram, settings=packing.Settings(shortest=1))      # best fit alone
    assert sum(k.count for k in kinds) <= sum(k.count for k in plain)


def test_packed_pieces(spark, sf_dir, word_file):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionAll(spark.createDataFrame([(None, None), (900_000, "")], "doc_id long, text string"))
    library = tokenizers.Tokenizer.from_file(word_file)
    rows = packing.pack(docs, word_file).collect()
    whole = {r["doc_id"]: library.encode(r["text"] or "", add_special_tokens=False).ids + [1]
             for r in docs.collect()}
    by_seq = collections.defaultdict(list)
    for r in rows:
        ids = whole[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["start"] == 4096 * r["piece"] and len(ids) == r["length"]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(r["length"] for r in rows) == sum(map(len, whole.values()))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(docs.limit(0), word_file).count() == 0


# --- decontamination -------------------------------------------------------------------

def test_overlaps_are_found_and_clean_texts_left(spark):
    random.seed(8)
    words = [f"w{i}" for i in range(400)]
    items = [" ".join(random.choice(words) for _ in range(30)) for _ in range(20)]
    items += ["five small words stand here", "two words", None, ""]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    filler = lambda n: " ".join(random.choice(words) for _ in range(n))              # noqa: E731
    changed = items[3].split()
    changed[4], changed[13], changed[22] = "x", "y", "z"
    texts = [filler(100) + " " + items[0].upper().replace(" ", ", ") + " " + filler(50),
             filler(20) + " " + " ".join(changed) + " " + filler(20),
             filler(3000), None, "", "and five small words, stand here. so", "two words", items[5] + " " + items[6]]
    df = frame(spark, texts)
    got = {r["doc_id"]: [(o["item_id"], o["matches"]) for o in r["overlaps"]]
           for r in decontaminate.find_overlaps(df, bench).collect()}
    assert got == {0: [("0", 30)], 1: [("3", 27)], 2: [], 3: [], 4: [], 5: [("20", 5)], 6: [],
                   7: [("5", 30), ("6", 30)]}
    blocks = decontaminate.find_overlaps(df, bench, settings=decontaminate.Settings(block_seeds=300))
    again = {r["doc_id"]: sorted((o["item_id"], o["matches"]) for o in r["overlaps"]) for r in blocks.collect()}
    assert again == {k: sorted(v) for k, v in got.items()}
    assert decontaminate.find_overlaps(df, bench.limit(0)).where(F.size("overlaps") > 0).count() == 0
    assert decontaminate.find_overlaps(df.limit(0), bench).count() == 0


@pytest.mark.parametrize("size", [8, 9, 10, 12, 15, 18, 20, 25])
def test_substitutions_anywhere_leave_an_overlap(size):
    """Every placement that keeps the stated share of an item is found and counted whole."""
    settings = decontaminate.Settings()
    item = [f"w{i}" for i in range(size)]
    block = decontaminate.Block(["a"], [" ".join(item).encode()], settings)
    for places in itertools.combinations(range(size), min(3, size // 5)):
        words = [f"x{i}" if i in places else w for i, w in enumerate(item)]
        text = " ".join(["o1 o2 o3", *words, "o4 o5"]).encode()
        own, bounds, _, _ = decontaminate.word_hashes([text], decontaminate._CODES)
        found = [block.overlap(own, i, shift) for _, i, shift in block.hits(own, bounds)]
        first, last = min(set(range(size)) - set(places)), max(set(range(size)) - set(places))
        assert (first + 3, last + 4, size - len(places)) in found, places
    # One substitution more than the share allows is no overlap of a short item.
    if size < 15:
        words = [f"x{i}" if i % 4 == 1 else w for i, w in enumerate(item)][:size]
        own, bounds, _, _ = decontaminate.word_hashes([" ".join(words).encode()], decontaminate._CODES)
        if sum(i % 4 == 1 for i in range(size)) > size // 5:
            assert not any(block.overlap(own, i, s) for _, i, s in block.hits(own, bounds))


def test_a_fragmented_passage_is_found(spark):
    item = [f"w{i}" for i in range(20)]
    text = " ".join("x" if i in (5, 10, 15) else w for i, w in enumerate(item))
    bench = spark.createDataFrame([("a", " ".join(item))], "item_id string, text string")
    found = decontaminate.find_overlaps(frame(spark, [f"so {text} on"]), bench).first()["overlaps"]
    assert [(o["item_id"], o["first_word"], o["end_word"], o["matches"]) for o in found] == [("a", 1, 21, 17)]


# --- suffix tree -----------------------------------------------------------------------

def test_base_score_and_counts_against_python(spark):
    random.seed(2)
    words = [f"v{int(random.paretovariate(0.7))}" for _ in range(4000)]
    rows = [(i, " ".join(words[i * 20:i * 20 + random.randint(0, 20)])) for i in range(200)]
    rows += [(500, None), (501, ""), (7, rows[7][1]), (None, "v1 V2")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 != 2, F.lit(True))
    settings = suffix_tree.Settings(head=8, symbol_share=0.02)
    got = suffix_tree.score(df, train, settings=settings).collect()
    tokens = [((i, t), re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower()) + ["\0"]) for i, t in rows]
    learn = [i is None or zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    c = collections.Counter(w for (_, ws), ok in zip(tokens, learn) if ok for w in ws)
    n, v = sum(c.values()), len(c)
    want = collections.Counter(
        (i, len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
        for (i, _), ws in tokens)
    assert want == collections.Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"],
                                        round(r["base_score"], 6)) for r in got)
    assert all(r["score"] < 0 for r in got)


def test_tree_states_are_distributions():
    rng = np.random.default_rng(0)
    words = np.sort(rng.integers(1, 1 << 60, 50).astype(np.uint64))
    head = suffix_tree.Head(words, np.full(50, 20), 1500, 200, 40, words[:4])
    counts = [((0 * 5 + u) * 5 + w, int(500 * (w == (u % 4) + 1) + 3)) for u in range(1, 5) for w in range(5)]
    tree = suffix_tree.grow(counts, head, suffix_tree.Settings())
    assert len(tree.ratio) > 1                       # the divergent contexts were kept
    unseen = suffix_tree.unknown_mass(head)
    root = np.array([0, 20, 20, 20, 20]) / 1500 * (1 - unseen)
    root[0] = 1 - root.sum()
    for row in tree.ratio:
        assert abs((root * 10 ** row).sum() - 1) < 1e-9


def test_tree_learns_word_order(spark):
    random.seed(1)
    text = lambda: " ".join(random.choice(["a b c", "d e f"]) for _ in range(60))     # noqa: E731
    df = spark.createDataFrame([(i, text()) for i in range(60)], "doc_id long, text string")
    train = F.col("doc_id") < 50
    held = suffix_tree.score(df, train).where("NOT train").collect()
    assert all(r["score"] > 0.6 * r["base_score"] for r in held)      # log10: much more likely
    assert suffix_tree.score(df.limit(0), train).count() == 0
    none = suffix_tree.score(df, F.lit(False)).collect()
    assert len(none) == 60 and all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in none)


def test_tree_keeps_on_disk_only_what_scores_need(spark):
    texts = [" ".join(random.Random(i).choice(["a b", "c d", f"e{i % 7}"]) for _ in range(40)) for i in range(60)]
    with collecting() as folders:
        rows = suffix_tree.score(frame(spark, texts), F.col("doc_id") % 3 > 0,
                                 settings=suffix_tree.Settings(head=3, hot_grams=1)).collect()
    assert len(rows) == len(texts)
    left = [name for folder in folders if os.path.isdir(folder) for name in os.listdir(folder)]
    assert "kept" in left and not {"grams", "totals"} & set(left)


# --- Kneser-Ney ------------------------------------------------------------------------

def test_tree_scores_equal_a_walk_in_python(spark):
    """Rare words as contexts and symbols, states deeper than two words, and joins instead of broadcasts."""
    random.seed(6)
    common = [f"c{i}" for i in range(300)]
    phrases = [[f"r{k}", f"s{k}", f"t{k}"] for k in range(6)]

    def text():
        out = []
        for _ in range(60):
            out += random.choice([[random.choice(common)], ["p", "q", "a", "one"], ["y", "q", "a", "two"],
                                  ["y", "z", "a", "three"]])
        if random.random() < 0.5:
            out += random.choice(phrases)
        return " ".join(out)

    rows = [(i, text()) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    settings = suffix_tree.Settings(head=40, hot_grams=20, hot_states=5, flush=500)
    got = {r["doc_id"]: r for r in suffix_tree.score(df, F.col("doc_id") < 600, settings=settings).collect()}

    tokens = {i: t.split() + ["\0"] for i, t in rows}
    c = collections.Counter(w for i, ws in tokens.items() if i < 600 for w in ws)
    n, once = sum(c.values()), sum(k == 1 for k in c.values())
    unseen = (once + 1) / (n + 2)
    seen = collections.defaultdict(collections.Counter)
    for i in range(600):
        ws = tokens[i]
        for at in range(len(ws)):
            for d in range(1, min(at, 8) + 1):
                seen[tuple(ws[at - d:at])][ws[at]] += 1

    def p(context, w):
        if not context:
            return c[w] / n * (1 - unseen) if c[w] else unseen
        total = sum(seen[context].values())
        return (seen[context][w] + settings.prior * p(context[1:], w)) / (total + settings.prior)

    def is_state(context, memo={(): True}):
        if context not in memo:
            s, memo[context] = seen[context], False
            total = sum(s.values())
            if total >= settings.context_least and is_state(context[1:]):
                e = {w: total * p(context[1:], w) for w in s}
                big = [w for w in s if e[w] >= 5]
                a = sum(s[w] * math.log(s[w] / e[w]) for w in big)
                rest = total - sum(s[w] for w in big)
                left = rest * math.log(rest / max(total - sum(e[w] for w in big), 1e-12 * total)) if rest else 0
                rare = max([s[w] * math.log(s[w] / e[w]) - s[w] + e[w]
                            for w in s if e[w] < 5 and s[w] > e[w]], default=0)
                bound = suffix_tree._chi_square(np.array(max(1.0, len(big))))
                memo[context] = bool(2 * (a + left) > bound or rare > math.log(len(c)) + 5.4)
        return memo[context]

    deepest = 0
    for i, ws in tokens.items():
        total = 0
        for at, w in enumerate(ws):
            d = 0
            while d < at and is_state(tuple(ws[at - d - 1:at])):
                d += 1
            deepest = max(deepest, d)
            total += math.log10(p(tuple(ws[at - d:at]), w))
        assert abs(total - got[i]["score"]) < 1e-6
    assert deepest >= 3 and is_state(("r0",))
    assert c["r0"] < n / 1000


def test_kneser_ney_is_a_distribution(spark):
    random.seed(5)
    vocabulary = [f"k{i}" for i in range(30)]
    texts = [" ".join(random.choice(vocabulary[:int(random.paretovariate(1)) % 29 + 1]) for _ in range(30))
             for _ in range(40)]
    model = kneser_ney.fit(frame(spark, texts))
    known = sorted({w for t in texts for w in t.split()})
    for before in ("k0 k0", "k1 k2", "never seen"):
        # What follows two given words: every known word, an unknown one, or the end.
        p = np.exp(_log_terms(model, [f"{before} {w}" for w in [*known, "unseen"]]))
        end = np.exp(_log_terms(model, [before]))[2]
        assert abs(p[2::4].sum() + end - 1) < 1e-3


def _log_terms(model, texts):
    two, one, token, _ = kneser_ney.trigrams(texts)
    context = kneser_ney.pair_key(two, one)
    p = model.look("word", token, model.unknown)
    p = model.look("pair", kneser_ney.pair_key(one, token), 0) + model.look("pair_mass", one, 1) * p
    return np.log(model.look("triple", kneser_ney.pair_key(context, token), 0)
                  + model.look("triple_mass", context, 1) * p)


def test_many_pieces_are_merged_as_one_by_one():
    machine = bpe.Transducer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    random.seed(8)
    pieces = [bytes(random.choices(b"aaathenoingrs'1\xc3\xa9\xe4", k=random.randint(1, 39))) for _ in range(3000)]
    expected = [[machine.ids[t] for t in machine.merge(p[:-1].decode("latin-1") + chr(256 + p[-1]))] for p in pieces]
    merges = bpe.Merges(machine)
    assert [np.frombuffer(b, "<u4").tolist() for b in merges.encode(pieces)] == expected
    assert merges.encode([]) == []


def test_pieces_beyond_the_memo_and_a_batch_keep_their_ids():
    path = public_tokenizers.path("word_bpe_49k.json")
    random.seed(9)
    texts = [" ".join("".join(random.choices("abcdehinorst", k=random.randint(1, 50))) for _ in range(5000))
             for _ in range(4)]
    library = tokenizers.Tokenizer.from_file(path)
    made = packing.WordTokenizer(path, memo=3000).encode(texts)
    assert [np.frombuffer(b, "<u4").tolist() for b in made] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]


def test_quality_learns_from_all_trusted_documents(spark):
    texts = [" ".join(f"d{i}w{k % 6}" for k in range(24)) for i in range(1300)]
    docs = frame(spark, texts).withColumn("lang", F.lit("xx"))
    out = kneser_ney.classify(docs, docs.select("doc_id"))
    read = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    most, least = out.agg(F.max(F.when(read, F.col("perplexity"))),
                          F.min(F.when(~read, F.col("perplexity")))).first()
    assert most < least / 10                     # each has words of its own, known only if it was read


def test_quality_is_the_same_by_broadcast_and_by_joins(spark):
    random.seed(6)
    texts = [" ".join(random.choice("abcdefgh") * random.randint(1, 3) for _ in range(random.randint(1, 40)))
             for _ in range(60)]
    docs = frame(spark, [*texts, "", None, "never seen", texts[0]]).withColumn("lang", F.lit("xx"))
    near, *far = [sorted(tuple(r) for r in kneser_ney.classify(
        docs, docs.select("doc_id").limit(40), settings=kneser_ney.Settings(**s)).collect())
        for s in ({}, {"broadcast_entries": 0, "hot_entries": 50}, {"broadcast_entries": 0, "hot_entries": 0})]
    for other in far:
        for x, y in zip(near, other, strict=True):
            assert x[:2] == y[:2] and x[4] == y[4] and x[2:4] == pytest.approx(y[2:4], rel=1e-4)


def test_quality_keeps_good_and_rejects_junk(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = docs.unionByName(spark.createDataFrame(
        [(None, None, None, None, None), (800_000, "", "xx", "s", 0)], docs.schema))
    settings = kneser_ney.Settings(trusted_most=40)
    out = kneser_ney.classify(docs, labels.where("quality = 1"), settings=settings)
    rows = out.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("k")).collect()
    kept = {r["quality"]: r["k"] for r in rows}
    assert kept[1] >= 0.95 and kept[0] <= 0.6
    assert out.count() == docs.count()
    everything = kneser_ney.classify(docs, labels.limit(0), settings=settings)
    assert everything.where("NOT keep").count() == 0
