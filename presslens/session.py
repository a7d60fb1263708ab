"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"

# A lookup table is broadcast only up to this many rows and bytes; beyond it the join shuffles.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 64 << 20

# Text of documents that one task gets where documents are dealt out by id.
TASK_BYTES = 8 << 20

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName("presslens")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode, where none is named."""
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="presslens-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


_handed_out: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    path = os.path.join(shared_dir(spark), "presslens", f"{name}-{uuid.uuid4().hex}")
    _handed_out.append(path)
    return path


def discard(table: DataFrame) -> None:
    """Remove the scratch table that `table` reads, which nothing will read again."""
    spark, files = table.sparkSession, table.inputFiles()
    folders = {file.rsplit("/", 1)[0] for file in files}
    for name in [path for path in list(_handed_out) if any(folder.endswith(path) for folder in folders)]:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _handed_out.remove(name)


def release(spark: SparkSession) -> None:
    """Remove every scratch table of this session; call it once a result has been used."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    while _handed_out:
        path = hadoop(_handed_out.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write once, read back: cuts lineage and gives Catalyst the table's real size."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str, size: Column | None = None) -> DataFrame:
    """Hash-partition documents by id so that every later per-document step stays in its task.

    `size` gives the bytes of a row's text. The number of tasks then grows with their sum, and with it
    what a task's aggregates hold stays the same for any input.
    """
    columns = [F.col(k) for k in keys]
    return df.repartition(*columns) if size is None else df.repartition(tasks_for(df, size), *columns)


def tasks_for(df: DataFrame, size: Column) -> int:
    """As many tasks as the rows have TASK_BYTES of text, `size` bytes a row; one a core at least."""
    total = df.agg(F.sum(size.cast("bigint")).alias("total")).first()["total"] or 0
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
