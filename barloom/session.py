"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What the jobs rely on. Partition counts are left to AQE: start wide, coalesce by size.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A ticker's history fits in memory; the default spills window groups above 4,096 rows.
    "spark.sql.windowExec.buffer.in.memory.threshold": "65536",
    # Plans here have hundreds of columns; recording the Python line of each is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_local_scratch: dict[str, str] = {}
_collecting: list[list[str]] = []


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("barloom")
    conf = {**JOB_CONF, "spark.sql.shuffle.partitions": str(partitions),
            "spark.driver.memory": "8g", **extra}
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir.

    Only a local session may do without it: there one machine holds every task, so a
    temporary folder is as good. On a cluster the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/barloom"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="barloom-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the scratch folder that no other run uses."""
    folder = f"{scratch_root(spark)}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    for paths in _collecting:
        paths.append(folder)
    return f"{folder}/{name}"


@contextmanager
def collecting() -> Iterator[list[str]]:
    """The scratch folders that the block asks for, so that they can be dropped once nothing
    reads them any more."""
    paths: list[str] = []
    _collecting.append(paths)
    try:
        yield paths
    finally:
        _collecting[:] = [p for p in _collecting if p is not paths]       # equal lists may be nested


def drop_scratch(spark: SparkSession, paths: Iterable[str], keep: DataFrame | None = None) -> None:
    """Delete scratch folders, but for those that `keep` reads."""
    used = [] if keep is None else keep.inputFiles()
    for folder in paths:
        if not any(f"{folder.rsplit('/', 1)[-1]}/" in file for file in used):
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files that no plan refers to any more.

    It does so when the driver collects its garbage, which for a small driver heap may be
    long after the jobs that wrote them. Listeners that have not been told yet of the end of a
    query still hold it.
    """
    gc.collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    for _ in range(2):                # what is found unused first can hold others; deleting takes a moment
        spark._jvm.System.gc()
        time.sleep(0.15)


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df once and read it back, for plans that scan the same rows several times. `by` is a
    column whose values get folders of their own.

    Parquet in the shared folder keeps column pruning and pushdown for the later scans
    and, unlike cached blocks, outlives the executors that wrote it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, partitionBy=by)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
