"""Load files as they arrive in a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import PRICES, Feed, run_load
from ..settings import Settings
from ..sources.landing import BARS, MACRO, stream_landing
from ..sources.store import Store


def load_arrivals(spark: SparkSession, path: str, fmt: str, store: Store, settings: Settings,
                  checkpoint: str, feed: Feed = PRICES, **options: str) -> StreamingQuery:
    """Load every file that the checkpoint has not seen, then stop.

    Each micro-batch is one run of the batch load without the date watermark: the file
    log decides what is new. A batch that is repeated after a failure changes nothing, since
    a run is committed once. Good rows of an entity that failed are held
    and join the next micro-batch, since their files will not be read again. Within a micro-batch the first copy of a
    key is the one from the oldest file, the lowest file name among equals, and the
    earliest line in it.
    """
    schema = BARS if feed is PRICES else MACRO
    arrivals = stream_landing(spark, path, fmt, schema, **options)

    def held_at(batch_id: int) -> str:
        return f"{checkpoint.rstrip('/')}_held/batch={batch_id}"

    def load(batch: DataFrame, batch_id: int) -> None:
        in_order = F.struct("_modified", "_file", "_block",
                            F.monotonically_increasing_id().alias("_line"))
        batch = batch.withColumn("ingest_seq", in_order)
        if batch_id:
            held = spark.read.parquet(held_at(batch_id - 1))
            batch = batch.unionByName(held.withColumn("_bad", F.lit("")), allowMissingColumns=True)
        # The stream's id is kept in its checkpoint, so a repeated batch is the same run and
        # another stream's batch another.
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        run_load(store, feed, batch, settings, run_id=f"stream_{stream}_{batch_id}", incremental=False,
                 pending=held_at(batch_id))

    return (
        arrivals.withColumns({
            "_modified": F.col("_metadata.file_modification_time"),
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start")})
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
