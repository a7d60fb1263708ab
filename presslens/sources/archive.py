"""Snapshot archive and metric history, whose headers drift from file to file."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.operators.dedupe import keep_first, latest
from presslens.session import materialise
from presslens.sinks.tables import MANIFEST

# Columns of metric files that are text, and those that are whole numbers.
TEXT = {"metric", "model", "date", "file_name", "last_changed", "splitrule", "model_type", "fitted_on"}
WHOLE = {"train_n", "sample_size", "mtry", "n_tree", "min_node_size", "model_n", "tp", "fp", "fn", "tn"}
# The archive's CSV dialect.
CSV = {"multiLine": True, "escape": '"', "nullValue": "NA", "header": True}


def stack(*dfs: DataFrame) -> DataFrame:
    """Union by name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _listed(spark: SparkSession, path) -> list:
    """Header groups, or none when no file matches."""
    try:
        return header_groups(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []


def header_groups(spark: SparkSession, path) -> list[tuple[str, list[str]]]:
    """Files by header line, found by a distributed scan that keeps one row per file.

    The driver gets the few distinct headers, then the names of one group at a time, which it lists
    for the read of that group anyway; no task holds the names of a group together.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    )
    lines = lines.filter("block = 0").withColumn("row", F.monotonically_increasing_id())
    first = materialise(lines.groupBy("path").agg(F.min_by("value", "row").alias("header")), "headers")
    headers = [r["header"] for r in first.select("header").distinct().orderBy("header").collect()]
    return [(h, sorted(r["path"] for r in first.filter(F.col("header") == h).select("path").toLocalIterator())) for h in headers]


def read_drifting_csv(spark: SparkSession, path, with_mtime: bool = False) -> DataFrame:
    """All files as one table of strings: one read per distinct header, then a union by name."""
    parts = []
    for header, paths in _listed(spark, path):
        names = [n.strip().strip('"') for n in header.split(",")]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        part = spark.read.schema(schema).options(**CSV).csv(paths)
        file = [F.col("_metadata.file_name").alias("file_name")]
        if with_mtime:
            file.append(F.col("_metadata.file_modification_time").alias("last_changed"))
        parts.append(part.select("*", *file))
    if not parts:
        raise ValueError(f"no file at {path}")
    return stack(*parts)


def read_snapshots(spark: SparkSession, path) -> DataFrame:
    return read_drifting_csv(spark, path)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """An archive with a manifest as one table of strings, with `snapshot` and `file_name`.

    The manifest gives the few distinct headers; each is one folder and one scan, whatever the number
    of files, so no file is read for its header and no list of files is held.
    """
    runs = spark.read.schema("header string, columns array<string>, snapshot string, written_at timestamp").parquet(f"{path}/{MANIFEST}")
    headers = runs.groupBy("header").agg(F.first("columns").alias("columns")).orderBy("header").collect()
    if not headers:
        raise ValueError(f"no snapshot at {path}")
    parts = []
    for row in headers:
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*row["columns"], "snapshot"]])
        part = spark.read.schema(schema).options(**CSV).csv(f"{path}/header={row['header']}")
        parts.append(part.select("*", F.col("_metadata.file_name").alias("file_name")))
    return stack(*parts)


def archive(snapshots: DataFrame, key: str = "url", order: str = "file_name") -> DataFrame:
    """One row per article: the earliest snapshot's."""
    return keep_first(snapshots, [key], [order])


def read_metrics(spark: SparkSession, path, with_mtime: bool = False) -> DataFrame:
    """Metric files as one table; numbers are typed, older files may lack columns."""
    df = read_drifting_csv(spark, path, with_mtime)
    kind = {c: "bigint" if c in WHOLE else "double" for c in df.columns if c not in TEXT}
    return df.withColumns({c: F.col(c).cast(k) for c, k in kind.items()})


def latest_metrics(history: DataFrame) -> DataFrame:
    return latest(history, "last_changed", "file_name")
