"""The fixed patterns against Python's matches, and discovery on a small corpus."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from barloom.llm import personal_data as P

FIXED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def expected(text):
    out = []
    for rank, (kind, pattern) in enumerate(FIXED.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                  "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), rank, kind, m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))


def texts():
    random.seed(4)
    bits = ["a", "b.c", "@", ".", "..", "-", " ", "  ", "1", "23", "256", "255", "0", "007", "+", "+1", "(", ")", "é",
            "🙂", "\n", "x@y.zz", "_", "%", "1.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112",
            "+1 (283) 555-6500", "378282246310005", "\t"]
    out = ["".join(random.choice(bits) for _ in range(random.randint(0, 14))) for _ in range(3000)]
    return [*out, None, "", "a" * 50_000, "1" * 50_000, "1 " * 20_000, "a@b" + ".c" * 20_000, "+" * 5000, "1." * 5000]


def test_fixed_patterns_match_python(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = P.seed_spans(F.coalesce("text", F.lit("")))
    got = dict(df.select("doc_id", P.digest(spans)).collect())
    wrong = [(t, got[i], expected(t)) for i, t in rows if got[i] != expected(t)]
    assert wrong == []


def corpus(spark):
    rows = []
    for i in range(30):
        rows.append((i, f"one two contact user{i}.x@mail{i % 4}.example.com three {i}", "k"))
    rows.append((100, "write to contact odd.name@localhost now", "k"))       # no fixed pattern reads this
    rows += [(101, None, None), (102, "", None), (None, "plain words", "k"), (103, "call +1 (283) 555-6500", "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string")


def test_patterns_discover_and_base_spans_stay(spark):
    df = corpus(spark)
    got = {r["doc_id"]: r for r in P.find_spans(df, out="found").collect()}
    assert [(s["kind"], s["start"], s["end"]) for s in got[103]["found"]] == [("phone", 5, 22)]
    assert got[101]["found"] == got[102]["found"] == got[None]["found"] == []
    assert got[0]["found"][0]["kind"] == "email" and got[0]["spans"] == "k"
    assert len(got) == df.count()


def test_discovery_needs_a_reliable_pattern(spark):
    rows = [(i, f"contact user@mail{i}.example.com") for i in range(10)]
    rows += [(50, "contact user@localhost end")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    settings = P.Settings(pattern_least=0.7)
    found = {r["doc_id"]: r["spans"] for r in P.find_spans(df, settings=settings).collect()}
    # "contact a@a" holds one unseen instance and no seed, so it finds nothing.
    assert found[50] == []
    mixed = [(i, f"contact user{i}@mail.example.com") for i in range(10)]
    mixed += [(50, "contact user9@mail.example.c_m")]
    found = {r["doc_id"]: r["spans"] for r in P.find_spans(
        spark.createDataFrame(mixed, "doc_id long, text string"), settings=settings).collect()}
    assert found[0][0]["kind"] == "email"


def test_unseen_identifiers_are_found(spark):
    """Both words beside it find one, its shape then others, and those a context without seeds."""
    rows = [(i, f"pay to user{i}@mail.example.com today") for i in range(12)]
    rows += [(20 + i, f"pay to AB-{100 + i}-X today") for i in range(8)]     # a form of no fixed pattern
    rows += [(30 + i, f"send to CD-{200 + i}-Y then") for i in range(3)]      # one context, and the shape
    rows += [(40 + i, f"account CD-{200 + i}-Y closed") for i in range(3)]
    rows += [(50, "account EF-900-Z closed"), (60, "page 17 of 20"), (61, "room 5-B here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [s["match"] for s in r["spans"] if s["kind"] == P.FOUND]
           for r in P.find_spans(df, settings=P.Settings(pattern_least=0.5)).collect()}
    assert all(got[20 + i] == [f"AB-{100 + i}-X"] for i in range(8))
    assert all(got[30 + i] == [f"CD-{200 + i}-Y"] for i in range(3))
    assert got[60] == got[61] == []


def test_neighbours_are_instances_and_contexts(spark):
    rows = [(1, "foo 123 456 789"), (2, "a@x.org  b@y.org\nc@z.org"), (3, "4111 1111 x  5"), (4, "7"),
            (5, "a" * 50_000 + " 1"), (6, "See 12 (34) 5-6, 8")]
    df = spark.createDataFrame(rows, "uid long, t string").withColumn("s", P.seed_spans(F.col("t")))
    got = {}
    for r in P._edges(df, "t", "s", "uid").collect():
        text = dict(rows)[r["uid"]]
        got.setdefault(r["uid"], set()).add((text[r["start"]:r["end"]], r["pattern"], r["seed"]))
    assert got[1] == {("123", "foo 9", False), ("456", "9 9", False), ("789", "9 9", False),
                      ("123 456 789", "foo 9 9 9", False)}
    assert got[2] == {("a@x.org", " a@a.a", True), ("b@y.org", "a@a.a a@a.a", True), ("c@z.org", "a@a.a a@a.a", True)}
    assert got[3] == {("4111", " 9", False), ("1111", "9 9", False), ("5", "x 9", False),
                      ("4111 1111", " 9 9", False)}
    assert got[4] == {("7", " 9", False)} and len(got[5]) == 1
    assert ("12 (34) 5-6,", "see 9 (9) 9-9,", False) in got[6] and ("8", "9-9, 9", False) in got[6]


def test_masked_text(spark):
    df = spark.createDataFrame([(1, "mail a.b@c.de or 1.2.3.4 é🙂 x@y.zz"), (2, "nothing"), (3, None)],
                               "doc_id long, text string")
    spans = P.find_spans(df)
    got = dict(spans.select("doc_id", P.masked(F.col("text"), F.col("spans"))).collect())
    assert got == {1: "mail <EMAIL> or <IP> é🙂 <EMAIL>", 2: "nothing", 3: None}


def test_empty_digest_is_the_hash_of_nothing(spark):
    df = spark.createDataFrame([(1, "no data")], "doc_id long, text string")
    row = P.find_spans(df).select(F.sha2(P.digest(F.col("spans")), 256)).first()
    assert row[0] == hashlib.sha256(b"").hexdigest()


def test_no_python_in_the_plan(spark):
    plan = P.find_spans(corpus(spark), out="found")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert P.find_spans(spark.createDataFrame([], "doc_id long, text string")).count() == 0
