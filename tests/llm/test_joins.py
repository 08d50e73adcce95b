"""The n-gram join, components, the WARC round trip, the permutation index and the pipeline."""

import collections
import random
import re

import numpy as np
import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import components, ngram_join, permutation_index, queries, warc

# --- n-gram join -----------------------------------------------------------------------


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    names = collections.defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        names[find(i)].append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in names.items()}
    return collections.Counter((doc, len(sets[i]), least[find(i)] if least[find(i)] is not None else doc)
                               for i, (doc, _) in enumerate(rows))


def copies(seed):
    """A base text with chains of ever more changed copies, shared passages, short texts."""
    random.seed(seed)
    words = [f"w{i}" for i in range(300)]
    passage = " ".join(random.choice(words) for _ in range(40))
    rows = []
    for group in range(6):
        text = [random.choice(words) for _ in range(random.choice([12, 60, 150]))]
        for _ in range(14):
            text = list(text)
            for _ in range(random.randint(0, 3)):
                text[random.randrange(len(text))] = random.choice(words)
            rows.append(" ".join(text))
    rows += [" ".join(random.choice(words) for _ in range(random.randint(5, 80))) + " " + passage for _ in range(40)]
    rows += ["a b c", "A  b\tC", "a b", None, "", "   ", "x", rows[0], rows[0].upper(), "é à ü"]
    random.shuffle(rows)
    return list(enumerate(rows))


def test_join_shuffles_plain_prefix_rows_and_keyed_arrays_once(spark):
    """Prefix shingles are dealt out as (token, uid, n), without the orders worked out from them,
    and arrays of shingles meet their pairs without being dealt out by uid."""
    reps = spark.createDataFrame([(1, 3, [5, 6], [9]), (2, 3, [5, 7], [9])],
                                 "uid long, n long, rare array<long>, hot array<long>")
    plan = ngram_join._tiles(reps, 4)._jdf.queryExecution().executedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(plan) if " Window " in line)
    at = next(i for i in range(at, len(plan)) if "Exchange hashpartitioning(token" in plan[i])
    assert "xxhash64" not in "".join(plan[at:at + 4]).split("Union")[0]
    ngram_join.ship(spark)
    texts = spark.createDataFrame([("a b c d e f",), ("a b c d e f",), ("g h",)], "t string")
    rows = ngram_join._features(texts.selectExpr("1L AS d", "t"), ngram_join.frequent_shingles(
        texts, ngram_join.Settings()), ngram_join.Settings()).select("uid", "s1", "s2")
    sets = ngram_join._sets(texts, rows, ngram_join.Settings())
    assert sets.columns == ["s1", "s2", "shingles"]
    assert sorted(len(r.shingles) for r in sets.collect()) == [1, 2]


@pytest.mark.parametrize("seed,frequent,small,leaders", [(1, 2, 16, 4), (2, 1000, 2, 1), (3, 5, 0, 2)])
def test_groups_equal_brute_force(spark, seed, frequent, small, leaders):
    rows = copies(seed) + [(None, "a b c"), (None, None), (3, "w1 w2 w3 w4 w5 w6")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("uid", F.lit("x")).repartition(5)
    settings = ngram_join.Settings(task_count=frequent, total_count=frequent, small_tile=small, leaders=leaders)
    got = ngram_join.similar_groups(df, settings=settings).collect()
    assert collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == brute_force(rows)


def test_groups_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.similar_groups(empty).count() == 0


def test_a_group_of_near_copies_makes_few_pairs(spark):
    """Pairs that are looked at grow with the group, not with its square."""
    random.seed(9)
    base = [f"w{random.randrange(900)}" for _ in range(150)]
    texts = []
    for _ in range(400):
        text = list(base)
        text[random.randrange(150)] = f"n{random.random()}"
        texts.append(" ".join(text))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = ngram_join.similar_groups(df).groupBy("component_id").count().collect()
    assert [r["count"] for r in got] == [400]


def test_bitmaps_bound_the_overlap_from_above():
    rng = np.random.default_rng(0)
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
        a = np.unique(rng.choice(pool, rng.integers(1, 200)))
        b = np.unique(rng.choice(pool, rng.integers(1, 200)))
        bound = ngram_join.overlap_bound(ngram_join.bitmap(a), ngram_join.bitmap(b), len(a), len(b))
        assert bound >= len(np.intersect1d(a, b))


def test_bitmaps_are_short_and_reject_pairs_well_below_the_bound():
    rng = np.random.default_rng(1)
    for n in (100, 256, 400, 2000):
        pool = np.unique(rng.integers(0, 1 << 63, 3 * n).astype(np.uint64))
        a, b = pool[:n], pool[n // 3:n // 3 + n]                   # a similarity of one half
        x, y = ngram_join.bitmap(a), ngram_join.bitmap(b)
        assert len(x) <= n / 4 and ngram_join.overlap_bound(x, x, n, n) == n
        assert not ngram_join.enough(ngram_join.overlap_bound(x, y, n, n), n, n, 80)


def test_components_of_paths_and_stars(spark):
    random.seed(2)
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5, 5), (3000, 2999)]
    random.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    groups = collections.defaultdict(set)
    for r in components.connected(df).collect():
        groups[r["root"]].add(r["node"])
    assert sorted(map(len, groups.values())) == [2, 60, 201]


# --- WARC ------------------------------------------------------------------------------

def test_archives_round_trip(spark, tmp_path):
    nasty = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "http://a/\r\nX: y", nasty), (2, None, None), (3, "http://b", "é🙂" * 1000), (4, "u", ""),
            (5, "u", "same"), (9, "u", "same"), (7, "u", "same"), (None, "n", "same"), (None, "n", "other"),
            (10, "u", "x" * 200_000), (11, "u", "\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("size", F.lit("clash"))
    path = str(tmp_path / "warc")
    warc.write_archives(warc.plan_captures(pages), path, file_bytes=5000)
    captures = warc.assemble(warc.read_archives(spark, path)).collect()
    assert len(captures) == len(rows)
    by_id = {c["capture_id"].split(":")[-1].rstrip(">"): c for c in captures}
    text = {str(i): h or "" for i, _, h in rows}
    for key, c in by_id.items():
        assert c["request"]["concurrent_to"] == c["metadata"]["concurrent_to"] == c["capture_id"]
        if c["response"]["record_type"] == "response" and key in text:
            assert c["response"]["payload"].decode() == text[key]
            assert c["response"]["payload_digest"] == "sha1:" + c["response"]["computed_digest"]
    kinds = {k: c["response"]["record_type"] for k, c in by_id.items() if not k.startswith("null")}
    assert kinds == {"1": "response", "2": "revisit", "3": "response", "4": "response", "5": "revisit",
                     "7": "revisit", "9": "response", "10": "response", "11": "response"}
    assert by_id["2"]["response"]["refers_to"].endswith(":4>")
    assert sum(k.startswith("null") for k in by_id) == 2


def test_pages_that_share_an_id_all_come_back(spark, tmp_path):
    rows = [(1, "a", "x"), (1, "a", "y"), (1, "b", "x"), (2, "a", "x"), (2, "a", "x"), (3, "a", "y"), (3, "a", None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = queries.op2_warc(spark, str(tmp_path)).toArrow()
    want = connect(str(tmp_path)).sql(queries.SQL["op2_warc"].replace(
        "FROM pages", f"FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")).to_arrow_table()
    assert differences(got, want) == [] and got.num_rows == len(rows)


def test_archives_of_nothing(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = str(tmp_path / "none")
    warc.write_archives(warc.plan_captures(pages), path)
    assert warc.assemble(warc.read_archives(spark, path)).count() == 0


def test_records_without_partners_and_with_many(spark):
    rows = [("r1", "response", None), ("q1", "request", "r1"), ("q0", "request", "r1"), ("m9", "metadata", "r9")]
    df = spark.createDataFrame(rows, "record_id string, record_type string, concurrent_to string")
    for f in warc.RECORD.fields[3:]:
        df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    got = {c["capture_id"]: c for c in warc.assemble(df).collect()}
    assert got["r1"]["request"]["record_id"] == "q0" and got["r1"]["copies"]["request"] == 2
    assert got["r9"]["response"] is None and got["r9"]["metadata"]["record_id"] == "m9"


def test_a_cut_record_is_an_error():
    with pytest.raises(ValueError):
        list(warc.parse_records(b"WARC/1.1\r\nWARC-Type: request\r\nContent-Length: 10\r\n\r\nabc"))


# --- permutation index -----------------------------------------------------------------

@pytest.mark.parametrize("table, queries", [("sf0.01", 25), ("sf0.1", 100)])
def test_index_recall_and_scores(spark, table, queries):
    """The registered settings against all inner products."""
    df = spark.read.parquet(f"/root/testdata/{table}/embeddings.parquet")
    rows = df.collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in rows}
    ids = np.array(sorted(vectors))
    every = np.stack([vectors[i] for i in ids])
    found = collections.defaultdict(list)
    for r in permutation_index.search(df, lambda k: k % 20 == 0).collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    for q, got in found.items():
        got.sort()
        score = every @ vectors[q]
        best = [i for i in ids[np.lexsort((ids, -score))] if i != q][:20]
        assert [g[0] for g in got] == list(range(1, 21)) and q not in [g[1] for g in got]
        assert all(abs(g[2] - float(vectors[q] @ vectors[g[1]])) < 1e-12 for g in got)
        assert [(-g[2], g[1]) for g in got] == sorted((-g[2], g[1]) for g in got)
        hits += len({g[1] for g in got} & set(best))
    assert len(found) == queries and hits / (queries * 20) >= 0.95


def test_vectors_of_another_length_change_no_other_result(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    odd = spark.createDataFrame([(100_000 + 20 * i, [1.0 + i] * (1 + i % 2)) for i in range(6)], df.schema)
    search = lambda d: {tuple(r) for r in permutation_index.search(d, lambda k: k % 20 == 0).collect()}
    alone, both = search(df), search(df.unionAll(odd))
    assert alone <= both
    assert {r[:3] for r in both - alone} == {
        (100_000, 1, 100_080), (100_000, 2, 100_040), (100_040, 1, 100_080), (100_040, 2, 100_000),
        (100_080, 1, 100_040), (100_080, 2, 100_000), (100_020, 1, 100_100), (100_020, 2, 100_060),
        (100_060, 1, 100_100), (100_060, 2, 100_020), (100_100, 1, 100_060), (100_100, 2, 100_020)}


def test_index_on_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (7, [float("inf"), 1.0]), (20, [0.0, 2.0]), (1, [5.0, 1.0]), (None, [1.0, 1.0]), (20, [0.0, 2.0]), (40, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit(1))
    got = permutation_index.search(df, lambda k: k % 20 == 0).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [
        (0, 1, 5.0), (0, 1, 1.0), (0, 2, 1.0), (0, 20, 0.0), (0, 20, 0.0),
        (20, 20, 4.0), (20, 20, 4.0), (20, 1, 2.0), (20, 1, 2.0), (20, 0, 0.0), (20, 0, 0.0),
        (20, 1, 0.0), (20, 1, 0.0), (20, 2, 0.0), (20, 2, 0.0)]
    assert permutation_index.search(df.limit(0), lambda k: k % 20 == 0).count() == 0


# --- pipeline --------------------------------------------------------------------------

def test_pipeline_stages(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    passage = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    body = docs.where("n_chars BETWEEN 800 AND 3000 AND lang = 'en'").first()["text"]
    extra = [(10_000, body, "en", "s", 1), (10_001, body + " the end", "en", "s", 1),
             (10_002, "the and of " + passage + " in that", "en", "s", 1),
             (10_003, "the and of in write to ab.c@mail.example.com that is the of", "en", "s", 7),
             (10_004, "12345 !!", "en", "s", 1), (10_005, None, None, None, None), (None, "the and that of", "en", "s", 1),
             (10_006, "repeated the row and of it", "en", "s", 1), (10_006, "repeated the row and of it", "en", "s", 1)]
    docs = docs.unionAll(spark.createDataFrame(extra, docs.schema)).repartition(3)
    for name in ("_lang", "_score", "_accepted", "_overlaps", "_spans", "_text", "_n_chars", "Spans"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "sequences":
            break
        assert docs.columns == before.columns
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        assert docs.where("_lang <> concat('_lang', doc_id) OR _spans <> concat('_spans', doc_id)").isEmpty()
        if name == "language":
            assert not {10_004, 10_005} & set(ids) and None in ids
        if name == "near_duplicates":
            assert not {10_000, 10_001} & set(ids) and ids.count(10_006) == 1 and None in ids
        if name == "benchmark_passages":
            assert 10_002 not in ids and 10_003 in ids
        if name == "private":
            row = docs.where("doc_id = 10003").first()
            assert "<EMAIL>" in row["text"] and row["n_chars"] == len(row["text"])
            final = len(ids)
    left = sum(corpus_pipeline._scratch.values(), [])
    assert left and len(left) < 12                  # of the last stage only
    assert docs.where("piece = 0").count() == final and docs.where("length > 4096").count() == 0
