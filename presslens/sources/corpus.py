"""Labelled corpus: JSON files, labels from file names, rejects, and the stored corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.functions.scalars import (
    LEAD_MIN_CHARS,
    choose_text,
    label01,
    label_from_path,
    unite,
)
from presslens.operators.dedupe import keep_first_by_text

# Fields of a labelled file, and the label's name there and here.
RAW_FIELDS = ["doc_id", "headlines", "leading_paragraph", "remaining_content"]
RAW_LABEL, LABEL = "has_corona_label", "is_covid"


@dataclass
class Labelled:
    rows: DataFrame
    rejects: DataFrame


def _unlist(field: Column) -> Column:
    """A field that may hold a JSON list of strings: its elements, joined."""
    items = F.from_json(field, T.ArrayType(T.StringType()))
    # Text that only looks like a list, such as a headline `[VIDEO] ...`, stays as it is.
    return F.when(field.startswith("["), F.coalesce(F.array_join(items, " "), field)).otherwise(field)


def load_labelled(spark: SparkSession, path: str, multi_line: bool = True) -> Labelled:
    """Labelled JSON files as one table, and the files without records.

    A missing label is taken from the file's name.
    """
    fields = [T.StructField(f, T.StringType()) for f in [*RAW_FIELDS, RAW_LABEL]]
    raw = spark.read.schema(T.StructType(fields)).option("multiLine", multi_line).json(path)
    raw = raw.select("*", F.col("_metadata.file_path").alias("path"))
    some = F.coalesce(*[F.col(f) for f in [*RAW_FIELDS, RAW_LABEL]]).isNotNull()
    label = F.coalesce(_unlist(F.col(RAW_LABEL)).cast("boolean"), label_from_path(F.col("path")))
    rows = raw.filter(some).select(*[_unlist(F.col(f)).alias(f) for f in RAW_FIELDS], label.alias(LABEL))
    listing = spark.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"))
    used = raw.filter(some).select("path").distinct()
    rejects = listing.join(used, "path", "left_anti").withColumn("reason", F.lit("no records"))
    return Labelled(rows, rejects)


def prepare_corpus(
    raw: DataFrame, threshold: int = LEAD_MIN_CHARS, label: str = LABEL, id_col: str = "doc_id"
) -> DataFrame:
    """(doc_id, text, label): headline + lead or body, one row per (text, label), labels 1/0."""
    lead = choose_text(F.col("leading_paragraph"), F.col("remaining_content"), threshold)
    flag = F.col(label).cast("boolean")
    rows = raw.filter(flag.isNotNull()).select(
        id_col, unite(F.col("headlines"), lead).alias("text"), label01(flag).cast("int").alias("label")
    )
    return keep_first_by_text(rows, "text", ["label"], [id_col])


def write_corpus(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_corpus(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
