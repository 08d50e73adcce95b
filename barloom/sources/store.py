"""Stored tables: Parquet folders under one root, partitioned for the reads that follow.

A job stages its rows as new folders of the tables, checks them there, and publishes all of
them in one commit; readers see the folders that the newest commit names. A job that dies
leaves every table as it was.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BASE_TABLES, HIGH_WATER, METADATA, PRIMARY_KEYS, TABLES
from .commits import CommitConflict, CommitLog, State

# Bars and features are read by date range, macro by series.
_COMMIT = T.StructField("commit", T.StringType(), True)
_YEAR = T.StructField("year", T.IntegerType(), True)
_PARTITION = {"raw_prices": "year", "raw_macro": "series_id", "features": "year"}


class ConstraintError(Exception):
    """Staged rows break a constraint of their table; nothing was committed."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    # --- reading -----------------------------------------------------------------------

    def read(self, name: str) -> DataFrame:
        return self._read(name, self.log.latest())

    def _read(self, name: str, state: State) -> DataFrame:
        return self._stored(name, state).select(*TABLES[name].names)

    def _stored(self, name: str, state: State) -> DataFrame:
        """The rows of a table with the columns that its folders are named by."""
        schema = T.StructType([*TABLES[name].fields, _COMMIT])
        if _PARTITION.get(name) == "year":
            schema = schema.add(_YEAR)
        folders = state.tables.get(name)
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(
            *[f"{self.path(name)}/{folder}" for folder in folders])

    def read_between(self, name: str, start: date | None = None, end: date | None = None,
                     last: date | None = None) -> DataFrame:
        """Rows with start <= date, date < end and date <= last, as far as they are given.

        The year bounds prune folders, the date bounds prune row groups.
        """
        return self._between(name, self.log.latest(), start, end, last)

    def _between(self, name: str, state: State, start: date | None, end: date | None,
                 last: date | None) -> DataFrame:
        df = self._stored(name, state)
        years = _PARTITION.get(name) == "year"
        day, year = F.col("date"), F.col("year")
        for bound, inside in ((start, lambda c, v: c >= v), (last, lambda c, v: c <= v)):
            if bound is not None:
                df = df.where(inside(day, F.lit(bound)))
                df = df.where(inside(year, bound.year)) if years else df
        if end is not None:
            df = df.where(day < F.lit(end))
            df = df.where(year <= end.year) if years else df
        return df.select(*TABLES[name].names)

    def declared(self, name: str) -> T.StructType:
        """The schema that the table was created with."""
        return T.StructType.fromJson(json.loads(self.log.latest().schemas[name]))

    def stored_types(self, name: str) -> dict[str, str]:
        """Column types as the table's files have them."""
        folders = [f"{self.path(name)}/{folder}" for folder in self.log.latest().tables[name]]
        return dict(self.spark.read.option("basePath", self.path(name)).parquet(*folders).dtypes)

    def high_water(self, name: str) -> DataFrame:
        """(key, newest): the newest stored date of every key of a table, from the state table
        that each commit brings up to date. The table itself is not read."""
        key = PRIMARY_KEYS[name][0]
        return self.read("high_water").where(F.col("table_name") == name).select(
            F.col("key").alias(key), "newest")

    # --- writing -----------------------------------------------------------------------

    def begin(self, run: str | None = None) -> Commit:
        return Commit(self, run)

    def done(self, run: str) -> bool:
        return run in self.log.latest().runs

    def create_missing(self, names: Iterable[str] = BASE_TABLES) -> None:
        """Create the base tables that do not exist; existing ones stay as they are."""
        state = self.log.latest()
        missing = [name for name in names if name not in state.tables]
        if missing:
            tables = {**state.tables, **{name: [] for name in missing}}
            schemas = {**state.schemas, **{name: TABLES[name].json() for name in missing}}
            self.log.publish(State(state.version + 1, tables, state.runs, schemas))

    def append(self, name: str, df: DataFrame) -> None:
        """Append rows, stamping ingested_at where the table has it. Keys must be new."""
        with self.begin() as commit:
            commit.add(name, df)

    def replace_features(self, features: DataFrame) -> None:
        """Rebuild the features table, stamping computed_at; the old one is read until then."""
        with self.begin() as commit:
            commit.add("features", features, replace=True)

    def compact(self, name: str) -> None:
        """Rewrite a table's folders as one."""
        with self.begin() as commit:
            commit.add(name, commit.read(name), replace=True)

    def sweep(self, older_than_hours: float = 24) -> list[str]:
        """Delete folders that no table has any more and that are older than any running job or
        reader; returns them."""
        state, gone = self.log.latest(), []
        before = 1000 * (time.time() - 3600 * older_than_hours)
        for name in TABLES:
            for status in self.log.children(self.path(name)):
                folder = status.getPath().getName()
                if folder not in state.tables.get(name, []) and status.getModificationTime() <= before:
                    self.log.delete(f"{self.path(name)}/{folder}")
                    gone.append(f"{name}/{folder}")
        return gone

    def write_drift(self, report: DataFrame, run_date: date) -> None:
        """Keep one drift report per run date; a rerun replaces its own date only."""
        report.write.mode("overwrite").parquet(
            f"{self.path('drift_report')}/run_date={run_date:%Y-%m-%d}")

    def read_drift(self) -> DataFrame:
        return self.spark.read.parquet(self.path("drift_report"))

    def write_metadata(self, stage: str, **fields) -> None:
        """Write the one-row metadata document of a stage (`trained`, `evaluated`)."""
        row = self.spark.createDataFrame([{n: fields.get(n) for n in METADATA.names}], METADATA)
        row.coalesce(1).write.mode("overwrite").json(f"{self.path('metadata')}/{stage}")

    def update_metadata(self, source: str, target: str, **fields) -> None:
        """Merge fields into a stage's document and write it as another stage.

        The source document is left alone, so a failed write loses nothing.
        """
        known = self.read_metadata(source).first().asDict()
        self.write_metadata(target, **{**known, **fields})

    def read_metadata(self, stage: str) -> DataFrame:
        return self.spark.read.schema(METADATA).json(f"{self.path('metadata')}/{stage}")

    def _writer(self, name: str, df: DataFrame):
        column = _PARTITION.get(name)
        if not column:
            return df.write
        if column == "year":
            df = df.withColumn("year", F.year("date"))
        # One file per folder and advisory size, in key order, however many tasks made the rows.
        order = dict.fromkeys([column, *(c for c in ("ticker", "series_id", "date") if c in df.columns)])
        return df.hint("rebalance", column).sortWithinPartitions(*order).write.partitionBy(column)


def _observed(metrics: Observation) -> dict[str, int]:
    """What was counted during a write; nothing if Spark found that there were no rows, in
    which case the row of metrics is empty and `get` cannot name its columns."""
    return metrics.get if metrics._jo.getRow().size() else {}


class Commit:
    """Rows staged for several tables, published together.

    As a context manager it publishes at the end, or drops what it staged if the block or
    the commit fails. It reads the state that it started from; if another writer commits
    in between, publishing raises CommitConflict.
    """

    def __init__(self, store: Store, run: str | None = None):
        self.store, self.run = store, run
        self.base = store.log.latest()
        if run is not None and run in self.base.runs:
            raise CommitConflict(f"run {run} is committed already")
        self.tables = {name: list(folders) for name, folders in self.base.tables.items()}
        self.staged: list[tuple[str, str]] = []

    def __enter__(self) -> Commit:
        return self

    def __exit__(self, kind, error, trace) -> None:
        try:
            if kind is None:
                self.publish()
        except Exception:
            self.drop()
            raise
        if kind is not None:
            self.drop()

    def read(self, name: str) -> DataFrame:
        """A table as it was when the commit began."""
        return self.store._read(name, self.base)

    def read_between(self, name: str, start: date | None = None, end: date | None = None,
                     last: date | None = None) -> DataFrame:
        return self.store._between(name, self.base, start, end, last)

    def add(self, name: str, df: DataFrame, replace: bool = False, known_new: bool = False) -> DataFrame:
        """Stage rows of a table and check its constraints on them; returns the staged rows.

        NULLs in NOT NULL columns are counted while the rows are written. Keys are counted
        over the staged rows, and compared with the stored ones unless the caller has made
        the rows from keys that the table lacks (known_new) or replaces the table.
        """
        schema = TABLES[name]
        for stamp in ("ingested_at", "computed_at"):
            if stamp in schema.names and stamp not in df.columns:
                df = df.withColumn(stamp, F.current_timestamp())
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        required = [f.name for f in schema if not f.nullable]
        nulls = Observation(f"nulls_{uuid.uuid4().hex}")
        df = df.observe(nulls, *[F.count_if(F.col(c).isNull()).alias(c) for c in required])
        folder = f"commit={self.base.version + 1:012d}-{uuid.uuid4().hex[:12]}"
        path = f"{self.store.path(name)}/{folder}"
        self.staged.append((name, path))
        self.store._writer(name, df).parquet(path)
        counts = _observed(nulls)
        broken = [c for c in required if counts.get(c)]
        if broken:
            raise ConstraintError(f"{name}: NULL in {', '.join(broken)}")
        self.tables[name] = [folder] if replace else [*self.tables.get(name, []), folder]
        rows = self.store._read(name, State(tables={name: [folder]}))
        if name in PRIMARY_KEYS:
            self._check_keys(name, rows, replace, known_new)
        return rows

    def _check_keys(self, name: str, rows: DataFrame, replace: bool, known_new: bool) -> None:
        """Refuse repeated keys, and stage the table's new high-water marks by the way."""
        keys = list(PRIMARY_KEYS[name])
        per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
        fresh = per_key.groupBy(F.col(keys[0]).alias("key")).agg(
            F.max("date").alias("newest"), F.max("copies").alias("copies"))
        marks = self._marks()
        others = marks.where(F.col("table_name") != name) if replace else marks
        repeats = Observation(f"copies_{uuid.uuid4().hex}")
        merged = others.withColumn("copies", F.lit(1).cast("long")).unionByName(
            fresh.withColumn("table_name", F.lit(name))).groupBy("table_name", "key").agg(
            F.max("newest").alias("newest"), F.max("copies").alias("copies")).observe(
            repeats, F.max("copies").alias("copies"))
        self.add("high_water", merged.select(*HIGH_WATER.names), replace=True)
        if (_observed(repeats).get("copies") or 0) > 1:
            raise ConstraintError(f"{name}: a key ({', '.join(keys)}) is repeated")
        if not known_new and not replace:
            stored = self.read(name).select(*keys)
            if not rows.select(*keys).join(stored, keys, "left_semi").isEmpty():
                raise ConstraintError(f"{name}: a key ({', '.join(keys)}) is stored already")

    def _marks(self) -> DataFrame:
        """The marks as this commit has them so far."""
        return self.store._read("high_water", State(tables=self.tables))

    def publish(self) -> None:
        runs = [*self.base.runs, self.run] if self.run is not None else self.base.runs
        schemas = {name: self.base.schemas.get(name) or TABLES[name].json() for name in self.tables}
        self.store.log.publish(State(self.base.version + 1, self.tables, runs, schemas))

    def drop(self) -> None:
        """Delete what was staged."""
        for _, path in self.staged:
            self.store.log.delete(path)
