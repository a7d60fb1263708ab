"""The corpus pipeline: quality rules, near-duplicates, repeated spans, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read back as the
next one's `docs`. All but the last return the columns of `docs`. Decisions are joined back to whole
rows by a key of id and text, so extra columns pass through and repeated rows share a decision;
nulls, empty texts and empty tables are handled as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm import decontaminate, nearcopy, packing, quality, sentences
from presslens.llm.catalog import table, tokenizer
from presslens.llm.lines import without_rows
from presslens.llm.store import Scratch, row_key

# Rows of the sequences are pieces of documents; a stage's decisions hold for all its input.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor a certified cutoff reject."""
    rows = docs.select(
        "doc_id", row_key("doc_id", "text").alias("key"), F.col("lang").alias("stratum"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    scratch = Scratch(spark, "quality")
    measured = scratch.put(quality.measure(rows, "text"), "measured")
    labels = table(spark, sf_dir, "labels").select("doc_id", (F.col("quality") == 1).alias("good"))
    found = quality.verdicts(measured, labels, "stratum")
    gone = scratch.put(found.filter("NOT kept").select("doc_id", "key").distinct(), "gone")
    scratch.drop("measured")
    return without_rows(docs, gone)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id.

    A document without an id comes after all ids, by its text; rows that share an id are one document.
    """
    spare = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    own = F.coalesce(F.col("doc_id").cast("long"), spare)
    groups = nearcopy.near_duplicates(docs.select(own.alias("doc_id"), "text"), width=5)
    gone = groups.groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("NOT kept").select("doc_id")
    gone = Scratch(spark, "near").put(gone, "gone")
    rows = docs.select(own.alias("doc_id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    kept = rows.join(gone, "doc_id", "left_anti")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the sentences of spans that an earlier document or place has."""
    return sentences.drop_repeated_spans(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark passages."""
    found = decontaminate.Index(docs, table(spark, sf_dir, "benchmark")).contamination()
    gone = found.filter(decontaminate.contaminated()).select("doc_id", "key").distinct()
    return without_rows(docs, Scratch(spark, "benchmark").put(gone, "gone"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequence and place."""
    return packing.pack(docs, tokenizer())


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated spans", repeated_spans),
    ("benchmark passages", benchmark_passages),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; every stage but the last is written and read back."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for n, (name, stage) in enumerate(STAGES[:-1]):
        docs = scratch.put(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if n:
            scratch.drop(STAGES[n - 1][0].replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
