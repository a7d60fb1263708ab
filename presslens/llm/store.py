"""Scratch tables in the shared folder: written once, read back, removed when nothing needs them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.session import new_path

CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Texts, or sets of whole texts, that a Python worker gets at once.
BATCH_ROWS = 500
#: Bytes of a row group: a file can be read by as many tasks as it has row groups.
ROW_GROUP = 16 << 20


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings for the jobs that run inside, then as they were."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


class Scratch:
    """Written tables of one operator call.

    `put` cuts the lineage: a lost executor costs a read of the shared folder, not a recomputation.
    Shuffle files of the job that wrote a table are removed as soon as it is written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def put(self, df: DataFrame, step: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
        path = new_path(self.spark, f"{self.name}-{step}")
        with settings(self.spark, **{CLEAN: "true", BATCH: str(batch_rows)}):
            df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
        self.paths[step] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *steps: str) -> None:
        for step in steps:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(step))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text as UTF-8 bytes); a null text is empty. Other columns, clashing or not, are left out."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))


def row_key(id_col: str, text_col: str) -> Column:
    """64 bits of id and text, nulls being no empty values; rows are told apart by it among rows of one id.

    Rows with the same id and key are repeated rows; every operator gives them the same result.
    """
    return F.xxhash64(F.col(id_col).isNull(), F.col(id_col), F.col(text_col).isNull(), F.col(text_col))
