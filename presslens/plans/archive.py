"""Archive read and promotion: the parts of a run that work on earlier results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presslens.operators.metrics import promote
from presslens.sinks.bundles import Bundle, point_to, save_bundle
from presslens.sinks.tables import export_json, write_metrics
from presslens.sources.archive import archive, read_metrics, read_snapshots


def published(spark: SparkSession, path, key: str = "url") -> DataFrame:
    """All archived articles, one row per address: the earliest snapshot's."""
    return archive(read_snapshots(spark, path), key)


def publish(spark: SparkSession, path, out: str) -> None:
    export_json(published(spark, path), out)


def challenge(spark: SparkSession, bundle: Bundle, root: str, version: str, baseline: str = "latest") -> bool:
    """Log the attempt; save and promote the bundle if its F1 beats the earlier record's."""
    log = f"{root}/metrics"
    try:
        history = read_metrics(spark, f"{log}/*.csv", with_mtime=True)
    except ValueError:  # no earlier attempt
        history = None
    better = True
    if history is not None:
        decision = promote(bundle.card.select("model_f1"), history, baseline=baseline)
        better = decision.first()["promoted"]
    write_metrics(bundle.card, log)
    if better:
        save_bundle(bundle, f"{root}/{version}")
        point_to(spark, root, version)
    return better
