"""Model bundles: fitted model, vocabulary with idf, model card and options, under one versioned path."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from presslens.operators.tfidf import TfidfModel


@dataclass
class Bundle:
    model: PipelineModel
    tfidf: TfidfModel
    card: DataFrame
    size: int
    options: dict = field(default_factory=dict)


def save_bundle(bundle: Bundle, path: str) -> None:
    spark = bundle.card.sparkSession
    bundle.model.write().overwrite().save(f"{path}/model")
    bundle.tfidf.save(f"{path}/vocabulary")
    bundle.card.write.mode("overwrite").parquet(f"{path}/card")
    options = [(bundle.size, json.dumps(bundle.options))]
    spark.createDataFrame(options, "size int, options string").write.mode("overwrite").parquet(f"{path}/options")


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    row = spark.read.parquet(f"{path}/options").first()
    return Bundle(
        PipelineModel.load(f"{path}/model"),
        TfidfModel.load(spark, f"{path}/vocabulary"),
        spark.read.parquet(f"{path}/card"),
        row["size"],
        json.loads(row["options"]),
    )


def point_to(spark: SparkSession, root: str, version: str) -> None:
    """Move the pointer row to a promoted version."""
    spark.createDataFrame([(version,)], "version string").write.mode("overwrite").parquet(f"{root}/current")


def current_bundle(spark: SparkSession, root: str) -> Bundle:
    version = spark.read.parquet(f"{root}/current").first()["version"]
    return load_bundle(spark, f"{root}/{version}")
