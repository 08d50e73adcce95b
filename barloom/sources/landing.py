"""Landing folders: files of bars or macro observations, one scan for all entities."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import date

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BAR_COLS, MACRO_COLS, RAW_MACRO, RAW_PRICES

BARS = T.StructType([RAW_PRICES[c] for c in BAR_COLS])
MACRO = T.StructType([RAW_MACRO[c] for c in MACRO_COLS])
TEXT_FORMATS = ("csv", "json")
CORRUPT = "_corrupt"
UNREADABLE = "unreadable line"
DAMAGED = "unreadable file"


def as_text(names: Sequence[str]) -> T.StructType:
    """Text columns of these names, and one for lines that are no record."""
    return T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, CORRUPT]])


def parse_text(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast text columns to the schema's types, with the failures of a row in `_bad`.

    A value that does not parse becomes NULL and its column is named in `_bad`; a line that
    is no record, or has the wrong number of fields, is named as such. The row stays, with
    its text in `_raw`, so that the load can report it against its entity.
    """
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in schema}
    failed = [
        F.when(F.col(name).isNotNull() & cast.isNull(), F.lit(name)) for name, cast in typed.items()
    ]
    text = F.to_json(F.struct(*schema.names))
    if CORRUPT in df.columns:
        failed = [F.when(F.col(CORRUPT).isNotNull(), F.lit(UNREADABLE)), *failed]
        text = F.coalesce(F.col(CORRUPT), text)
    bad = F.concat_ws(",", *failed)
    return df.withColumns({**typed, "_bad": bad, "_raw": F.when(bad != "", text)})


def _text_source(spark: SparkSession, reader, path: str, fmt: str, schema: T.StructType,
                 options: dict[str, str]) -> DataFrame:
    """A folder of text files with every column as text.

    CSV files with a header are read by its names, in whatever order; Spark checks every
    file against them and fails on one that differs. Without a header, columns go by position.
    """
    names = schema.names
    if fmt == "csv" and str(options.get("header", "false")).lower() == "true":
        # Partition columns come from the folders, not from the header.
        names = (spark.read.options(**options).option("recursiveFileLookup", "true")
                 .csv(path).columns)
        options = {**options, "enforceSchema": "false"}
    if fmt == "csv":
        options = {**options, "columnPruning": "false"}
    return (reader.format(fmt).options(**{"mode": "PERMISSIVE", **options})
            .option("columnNameOfCorruptRecord", CORRUPT).schema(as_text(names)).load(path))


def read_landing(spark: SparkSession, path: str, fmt: str, schema: T.StructType,
                 **options: str) -> DataFrame:
    """Read a folder in the table's schema plus `_bad` (empty where the row parsed) and `_raw`.

    A `ticker=X/` folder level supplies the key column of files that lack it. A Parquet file
    whose footer cannot be read makes one row of the entity its folder names, with the
    file's path in `_raw`; without such a folder the entity is NULL. Files without a byte
    are passed over, as Spark does.
    """
    if fmt in TEXT_FORMATS:
        return _parsed(_text_source(spark, spark.read, path, fmt, schema, options), schema)
    if fmt != "parquet":
        return _typed(spark.read.format(fmt).options(**options).schema(schema).load(path), schema)
    damaged = [r["path"] for r in damaged_files(spark, path, schema).collect()]
    reader = spark.read.schema(schema).options(**options)
    if not damaged:
        return _typed(reader.parquet(path), schema)
    every = _files(spark, path).select("path").where(~F.col("path").isin(damaged)).collect()
    good = (_typed(reader.option("basePath", path).parquet(*[r["path"] for r in every]), schema) if every
            else _typed(spark.createDataFrame([], schema), schema))
    key = schema.names[0]
    folder = F.regexp_extract("path", f"/{key}=([^/]+)/", 1)
    named = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    rows = spark.createDataFrame([(p,) for p in damaged], "path string")
    return good.unionByName(rows.select(
        F.when(folder != "", named).alias(key),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name != key],
        F.lit(DAMAGED).alias("_bad"), F.col("path").alias("_raw")))


def stream_landing(spark: SparkSession, path: str, fmt: str, schema: T.StructType,
                   **options: str) -> DataFrame:
    """`read_landing` as a stream of newly arrived files; a damaged Parquet file stops it."""
    if fmt in TEXT_FORMATS:
        return _parsed(_text_source(spark, spark.readStream, path, fmt, schema, options), schema)
    return _typed(spark.readStream.format(fmt).options(**options).schema(schema).load(path), schema)


def _parsed(raw: DataFrame, schema: T.StructType) -> DataFrame:
    return parse_text(raw, schema).select(*schema.names, "_bad", "_raw")


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*schema.names, F.lit("").alias("_bad"), F.lit(None).cast("string").alias("_raw"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(path, file) of every file below a folder; the contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", F.col("_metadata.file_path").alias("file")))


def damaged_files(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(path) of the Parquet files whose footer cannot be read.

    A scan without columns opens the footers in tasks and counts the rows of each file.
    Files that gave none are empty or damaged; only these are read, to tell which.
    """
    opened = (spark.read.schema(schema).option("recursiveFileLookup", "true")
              .option("ignoreCorruptFiles", "true").parquet(path)
              .select(F.col("_metadata.file_path").alias("file")).groupBy("file").count())
    silent = [r["path"] for r in _files(spark, path).join(opened, "file", "left_anti").collect()]
    if not silent:
        return spark.createDataFrame([], "path string")

    def without_footer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bad = []
            for name, content in zip(*(batch.column(c).to_pylist() for c in ("path", "content"))):
                try:
                    pq.read_metadata(pa.BufferReader(content))
                except (pa.ArrowException, OSError):
                    bad.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(bad, pa.string())], names=["path"])

    contents = spark.read.format("binaryFile").load(silent).select("path", "content")
    return contents.mapInArrow(without_footer, "path string")


def plant_damaged_file(spark: SparkSession, folder: str) -> None:
    """Put a copy of the folder's first Parquet file there that lacks its end; for trials."""
    first = spark.read.format("binaryFile").load(folder).select("path", "content").orderBy("path").first()
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(folder, "cut.parquet")
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    out.write(first["content"][:len(first["content"]) // 2])
    out.close()


def select_bars(bars: DataFrame, tickers: Sequence[str], start: date | None = None,
                end: date | None = None) -> DataFrame:
    """Bars of the configured tickers with start <= date < end, in table order.

    All three conditions are plain comparisons, so they reach the file scan.
    """
    out = bars.where(F.col("ticker").isin(list(tickers)))
    if start is not None:
        out = out.where(F.col("date") >= F.lit(start))
    if end is not None:
        out = out.where(F.col("date") < F.lit(end))
    return out.select(*BAR_COLS)


def select_macro(macro: DataFrame, series: Sequence[str], start: date | None = None) -> DataFrame:
    """Observations of the configured series from `start` on; no upper end."""
    out = macro.where(F.col("series_id").isin(list(series)))
    if start is not None:
        out = out.where(F.col("date") >= F.lit(start))
    return out.select(*MACRO_COLS)


def macro_series(macro: DataFrame, series_id: str, name: str) -> DataFrame:
    """One series as (date, name)."""
    return macro.where(F.col("series_id") == series_id).select("date", F.col("value").alias(name))
