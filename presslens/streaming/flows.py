"""Streams: intake, de-duplication across overlapping pulls, run windows, scoring, counts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from presslens.session import materialise, new_path

# Fixed value: the longest lookback, and so the longest time a duplicate may arrive later.
DEDUPE_DELAY = "240 minutes"
# Fixed value: the shortest time between two scheduled runs.
RUN_EVERY = "40 minutes"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", ts: str = "ts", per_trigger: int | None = None
) -> DataFrame:
    """Feed files as they arrive; the time column becomes an instant so that it can carry a watermark.

    All files that wait are one batch: with `per_trigger`, the watermark moves between parts of a
    backlog, and what then comes late by more than the delay is dropped. Set it only for files that
    come in time order.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    stream = reader.load(path)
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def dedupe_stream(
    df: DataFrame, keys: list[str], ts: str = "ts", delay: str = DEDUPE_DELAY, salts: int = 0, salt_on=None
) -> DataFrame:
    """One row per key within the delay.

    With `salts`, copies of a hot key are first reduced in several tasks, shared out by another
    column, before the last step brings what is left of the key together.
    """
    rows = df.withWatermark(ts, delay)
    if salts:
        salt = F.pmod(F.xxhash64(salt_on or ts), F.lit(salts))
        rows = rows.withColumn("_salt", salt).dropDuplicatesWithinWatermark([*keys, "_salt"]).drop("_salt")
    return rows.dropDuplicatesWithinWatermark(keys)


def window_counts(df: DataFrame, ts: str = "ts", width: str = "1 hour", delay: str = DEDUPE_DELAY) -> DataFrame:
    """Articles per tumbling window, emitted when the watermark has passed it."""
    rows = df.withWatermark(ts, delay) if df.isStreaming else df
    counted = rows.groupBy(F.window(ts, width)).agg(F.count("*").alias("articles"))
    return counted.select(F.col("window.start").alias("window_start"), "articles")


def run_to_table(stream: DataFrame, name: str, out: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Process all that is there now into a Parquet table and return that table."""
    spark = stream.sparkSession
    out = out or new_path(spark, name)
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    query = writer.option("checkpointLocation", checkpoint or new_path(spark, f"{name}-log")).start(out)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def start_table(stream: DataFrame, out: str, checkpoint: str, every: str = RUN_EVERY, rocksdb: bool = True) -> StreamingQuery:
    """Keep a Parquet table up to date as files arrive, one batch per `every`, until the query is stopped.

    State is kept in RocksDB on the executors' disks, with its changes in the checkpoint, so that it may
    outgrow their memory. A batch whose commit was lost is run again from the same files and state; the
    table's own log knows it, so its rows are not doubled.
    """
    spark = stream.sparkSession
    before = spark.conf.get(STATE_STORE)
    if rocksdb:
        spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        writer = stream.writeStream.format("parquet").outputMode("append").trigger(processingTime=every)
        return writer.option("checkpointLocation", checkpoint).start(out)
    finally:
        spark.conf.set(STATE_STORE, before)


def score_stream(
    stream: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    reject: Callable[[DataFrame], tuple[DataFrame, DataFrame]] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score each micro-batch: positives, negatives and rejects go to tables partitioned by batch.

    Documents that get no prediction are rejects too, so the three tables hold every input row. A batch that is run again after a failure replaces its own partition, so nothing is doubled.
    """

    def put(df: DataFrame, batch_id: int, table: str) -> None:
        rows = df.withColumn("batch_id", F.lit(batch_id)).write.partitionBy("batch_id").mode("overwrite")
        rows.option("partitionOverwriteMode", "dynamic").parquet(f"{out}/{table}")

    def handle(batch: DataFrame, batch_id: int) -> None:
        kept, rejects = reject(batch) if reject else (batch, None)
        scored = materialise(score(kept), "scored-batch")  # read by all three sinks
        put(scored.filter("prediction = '1'"), batch_id, "positives")
        put(scored.filter("prediction = '0'"), batch_id, "negatives")
        unscored = scored.filter("prediction IS NULL").select(*kept.columns, F.lit("not scored").alias("reason"))
        put(unscored if rejects is None else rejects.unionByName(unscored), batch_id, "rejects")

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
