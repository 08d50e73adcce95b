"""The corpus pipeline: language, near duplicates, benchmark passages, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last return the columns of `documents`.
Since a stage begins when the one before is written, it first drops the scratch tables of that
one, except what its own docs are read from.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import language_id, ngram_join, packing, personal_data
from barloom.llm.common import hidden
from barloom.llm.decontaminate import find_overlaps
from barloom.session import collecting, drop_scratch, materialize

TOKENIZER = "word_bpe_49k.json"
BROADCAST_IDS = 1_000_000
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_scratch: dict[str, list[str]] = {}              # of the stage before, by application


def tidy(stage: Stage) -> Stage:
    """The stage, dropping what the one before has left in the scratch folder."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        drop_scratch(spark, _scratch.pop(app, []), keep=docs)
        with collecting() as paths:
            out = stage(spark, docs, sf_dir)
        _scratch[app] = paths
        return out
    return run


@tidy
def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognized; the others, and those without a letter, go."""
    model = language_id.fit_on(docs, F.lit(True))
    names = hidden(docs, "lang", "score", "accepted")
    return language_id.identify(docs, model, **names).where(names["accepted"]).select(*docs.columns)


@tidy
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one of smallest id.

    Rows without an id cannot be named and stay. Of rows that repeat an id, equal ones stay
    once; different ones stay or go with their id.
    """
    groups = materialize(ngram_join.similar_groups(docs), "groups")
    stay = F.col("doc_id") == F.col("component_id")
    ids = materialize(groups.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(stay).alias("stay"), F.count(F.lit(1)).alias("rows")), "ids")
    go = ids.where("NOT stay").select("doc_id")
    if go.count() <= BROADCAST_IDS:
        go = F.broadcast(go)
    kept = docs.join(go, "doc_id", "left_anti")
    again = ids.where("stay AND rows > 1").select("doc_id")
    if not again.isEmpty():
        once = kept.join(again, "doc_id", "left_anti")
        kept = once.unionByName(kept.join(again, "doc_id", "left_semi").dropDuplicates())
    return kept.select(*docs.columns)


@tidy
def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    out = hidden(docs, "overlaps")["overlaps"]
    return find_overlaps(docs, benchmark, out=out).where(F.size(out) == 0).select(*docs.columns)


@tidy
def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data replaced by its kind."""
    names = hidden(docs, "spans", "text", "n_chars")
    spans = names["spans"]
    found = personal_data.find_spans(docs, out=spans)
    text = personal_data.masked(F.col("text"), F.col(spans))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.size(spans) > 0, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return found.select("*", *[c.alias(names[n]) for n, c in changed.items()]).select(
        *[F.col(names[c]).alias(c) if c in changed else F.col(f"`{c}`") for c in docs.columns])


@tidy
def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequence and offset."""
    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("private", private),
    ("sequences", sequences),
]
# Language scores, exact similarity joins and tokenizing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
