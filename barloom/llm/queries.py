"""The registered queries of the dealt operators, op1 to op13, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_token_counts(spark, sf):
    from .token_counts import count_tokens
    docs = table(spark, sf, "documents").select("doc_id", "text")
    counted = count_tokens(docs, tokenizer_path("byte_bpe_50k.json"))
    return counted.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op2_warc(spark, sf):
    from . import warc as W
    path = scratch_path(spark, "warc")
    W.write_archives(W.plan_captures(table(spark, sf, "pages")), path)
    captures = W.assemble(W.read_archives(spark, path, payloads=False)).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies.response"))))
    page = F.regexp_extract("capture_id", ":([0-9-]+)>$", 1)
    fields = F.map_from_entries("metadata.fields")
    return captures.select(
        F.when(page != "", page).cast("long").alias("page_id"),
        F.element_at(fields, "payloadLength").cast("long").alias("payload_bytes"),
        F.coalesce("response.computed_digest", F.regexp_replace("response.payload_digest", "^sha1:", ""))
        .alias("payload_digest"),
        F.col("response.record_type").alias("record_type"),
        F.when(F.col("response.record_type") == "revisit",
               F.regexp_extract("response.refers_to", ":([0-9-]+)>$", 1).cast("long"))
        .alias("refers_to"))


def op3_language_id(spark, sf):
    from . import language_id as L
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold("doc_id", 4) == 2, F.lit(False))
    model = L.fit_on(docs, ~held_out)
    return L.identify(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op4_kneser_ney(spark, sf):
    from .kneser_ney import classify
    good = table(spark, sf, "labels").where("quality = 1")
    return classify(table(spark, sf, "documents"), good)


def op5_permutation_index(spark, sf):
    from .permutation_index import search
    return search(table(spark, sf, "embeddings"), lambda key: key % 20 == 0)


def op6_personal_data(spark, sf):
    from . import personal_data as P
    docs = P.find_spans(table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["rank"] < len(P.KINDS))
    kinds = F.transform("spans", lambda s: s["kind"])
    return docs.select(
        "doc_id",
        *[(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}")
          for kind in P.KINDS],
        F.sha2(P.digest(base), 256).alias("base_sha256"), P.digest(F.col("spans")).alias("spans"))


def op7_ngram_join(spark, sf):
    from .ngram_join import similar_groups
    return similar_groups(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_best_fit(spark, sf):
    from .packing import pack
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pack(docs, tokenizer_path("word_bpe_49k.json"))


def op9_decontaminate(spark, sf):
    """Per document the benchmark items found in it, as ids, and the best match."""
    from .decontaminate import find_overlaps
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = find_overlaps(docs, table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", (F.size("overlaps") > 0).alias("contaminated"),
        F.size("overlaps").cast("long").alias("n_items"),
        F.concat_ws(",", F.transform("overlaps", lambda o: o["item_id"])).alias("item_ids"),
        F.array_max(F.transform("overlaps", lambda o: o["matches"])).alias("most_matches"))


def op10_suffix_tree(spark, sf):
    from .suffix_tree import score
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold("doc_id", 7) == 2, F.lit(False))
    return score(docs, ~held_out).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op11_spelling_variants(spark, sf):
    from .spelling_variants import group_variants
    return group_variants(table(spark, sf, "documents").select("doc_id", "text")).select(
        "word", "form", "root", "n", "n_near", "form_n")


def op12_quality_rules(spark, sf):
    from .quality_rules import judge
    good = table(spark, sf, "labels").where("quality = 1")
    return judge(table(spark, sf, "documents"), good).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "kept", "lang", "perplexity", "lower", "upper")


def op13_target_resampling(spark, sf):
    from .target_resampling import resample
    drawn = resample(table(spark, sf, "documents").select("doc_id", "text"),
                     table(spark, sf, "benchmark").select("text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_warc, op3_language_id, op4_kneser_ney,
                                    op5_permutation_index, op6_personal_data,
                                    op7_ngram_join, op8_best_fit, op9_decontaminate,
                                    op10_suffix_tree, op11_spelling_variants,
                                    op12_quality_rules, op13_target_resampling)}

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_FIVE = " + ".join(f"{2 ** (4 - j)} * CAST(substr(bits, 1 + 5 * i + {j}, 1) AS INTEGER)" for j in range(5))

def _crc32(text: str) -> str:
    """CTEs that end in crc(v, h): the unsigned CRC-32 of the UTF-8 bytes of each v of `text`."""
    return f"""
bits(b, c, k) AS (
  SELECT b, b, 0 FROM range(256) r(b)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), steps AS MATERIALIZED (
  SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8
), crc AS MATERIALIZED (
  SELECT v, xor(4294967295, list_reduce(
      [CAST(('0x' || substr(x, 2 * i - 1, 2)) AS BIGINT) FOR i IN range(1, length(x) // 2 + 1)],
      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]), 4294967295)) AS h
  FROM (SELECT v, hex(encode(v)) AS x FROM ({text})), steps
)"""


SQL = {
    "op11_spelling_variants": rf"""
WITH RECURSIVE r AS MATERIALIZED (
  SELECT run, v, count(*) AS n FROM (
    SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS v FROM (
      SELECT doc_id, unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run
      FROM documents))
  GROUP BY ALL
), {_crc32("SELECT v FROM r GROUP BY v")}, w AS MATERIALIZED (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS INT))
                                    || substr(run, CAST(h % length(run) AS INT) + 2) ELSE run END AS word,
         CAST(sum(n) AS BIGINT) AS n
  FROM r JOIN crc USING (v) GROUP BY 1 HAVING length(word) >= 6 AND sum(n) >= 5
), cuts AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b USING (i, cut) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN w b ON a.cut = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN w b ON a.cut = b.word
), best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1
), formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 5 * w.n THEN near END AS form, CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
  FROM w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL
  SELECT walk.word, formed.word, formed.form FROM walk JOIN formed ON walk.next = formed.word
)
SELECT formed.word, formed.form, walk.at AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN walk ON walk.word = formed.word AND walk.next IS NULL""",
    "op13_target_resampling": rf"""
WITH RECURSIVE w AS (
  SELECT part, doc_id, words, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM (
    SELECT part, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM (SELECT 's' AS part, doc_id, text FROM documents
          UNION ALL SELECT 't', row_number() OVER (), text FROM benchmark))
), f AS MATERIALIZED (
  SELECT part, doc_id, v, count(*) AS n FROM (
    SELECT part, doc_id, word AS v FROM w
    UNION ALL SELECT part, doc_id, word || ' ' || words[pos + 1] FROM w WHERE pos < len(words))
  GROUP BY ALL
), {_crc32("SELECT DISTINCT v FROM f")}, b AS (
  SELECT h % 10000 AS bucket, sum(n) FILTER (part = 's') AS s, sum(n) FILTER (part = 't') AS t
  FROM f JOIN crc USING (v) GROUP BY 1
), g AS (
  SELECT bucket, floor(1000 * ln(
      CAST(coalesce(t, 0) + 1 AS DOUBLE) * CAST(coalesce(sum(s) OVER (), 0) + 10000 AS DOUBLE)
      / (CAST(coalesce(s, 0) + 1 AS DOUBLE) * CAST(coalesce(sum(t) OVER (), 0) + 10000 AS DOUBLE)))) AS gain
  FROM b
), sums AS (
  SELECT doc_id, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * CAST(gain AS BIGINT)) AS BIGINT) AS total
  FROM f JOIN crc USING (v) JOIN g ON g.bucket = h % 10000 WHERE part = 's' GROUP BY doc_id
), scored AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features,
         coalesce(CAST(floor(total / n_features) AS BIGINT), 0) AS weight,
         CAST(('0x' || substr(sha256('7:' || d.doc_id), 1, 8)) AS BIGINT) AS h
  FROM documents d LEFT JOIN sums USING (doc_id)
), final AS (
  SELECT doc_id, n_features, weight,
         weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM scored
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
  FROM final WHERE n_features >= 39
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM final LEFT JOIN ranked USING (doc_id)""",
    "op2_warc": f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages
), d AS (
  SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
         CAST(CAST(unhex(sha1(html)) AS BIT) AS VARCHAR) AS bits
  FROM p
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY bits, payload_bytes) AS first_id FROM d
)
SELECT page_id, payload_bytes,
       array_to_string([substr('{_BASE32}', 1 + {_FIVE}, 1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM g""",
    "op7_ngram_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS words
  FROM documents
), x AS (
  SELECT doc_id, len(words) AS k, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM w
), u AS (
  SELECT DISTINCT doc_id, shingle FROM (
    SELECT doc_id, k, pos, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o,
                                     lead(word, 3) OVER o, lead(word, 4) OVER o) AS shingle
    FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY pos))
  WHERE pos = 1 OR pos <= k - 4
), n AS (
  SELECT d.doc_id, CAST(count(u.shingle) AS BIGINT) AS n_shingles
  FROM documents d LEFT JOIN u ON u.doc_id = d.doc_id GROUP BY d.doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM u a JOIN u b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n_shingles, y.n_shingles
  HAVING 100 * count(*) >= 80 * (x.n_shingles + y.n_shingles - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM n
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT n.doc_id, n.n_shingles, min(reach.b) AS component_id
FROM n JOIN reach ON reach.a = n.doc_id GROUP BY n.doc_id, n.n_shingles""",
}
