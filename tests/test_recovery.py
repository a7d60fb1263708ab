"""Streams that run on, stop between write and commit, and start again."""

from __future__ import annotations

import os
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from presslens.streaming import flows

START = datetime(2024, 1, 5)
SCHEMA = "url string, title string, ts timestamp"


def articles(low: int, high: int):
    return [(f"u{i}", f"title {i}", START + timedelta(minutes=i)) for i in range(low, high)]


def put(spark, path, rows, schema=SCHEMA):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def forget_commit(checkpoint: str) -> int:
    """Remove the last batch's commit, as if the driver had died between the write and the commit."""
    numbers = [int(f) for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()]
    for name in (f"{max(numbers)}", f".{max(numbers)}.crc"):
        if os.path.exists(f"{checkpoint}/commits/{name}"):
            os.remove(f"{checkpoint}/commits/{name}")
    return max(numbers)


def test_dedupe_goes_on_after_a_lost_commit(spark, tmp_path):
    src, out, log = (str(tmp_path / name) for name in ("in", "out", "log"))

    def start():
        stream = flows.read_stream(spark, src, spark.createDataFrame([], SCHEMA).schema)
        return flows.start_table(flows.dedupe_stream(stream, ["url"]), out, log, "1 second")

    put(spark, src, articles(0, 100))
    query = start()
    query.processAllAvailable()
    put(spark, src, articles(60, 160))  # the pulls overlap
    query.processAllAvailable()
    assert query.lastProgress["stateOperators"][0]["customMetrics"].get("rocksdbGetCount") is not None
    query.stop()
    lost = forget_commit(log)
    # The batch is run again, from the state before it, then the next one.
    put(spark, src, articles(140, 200))
    query = start()
    query.processAllAvailable()
    query.stop()
    assert {int(f) for f in os.listdir(f"{log}/commits") if f.isdigit()} >= {lost}
    rows = spark.read.parquet(out).collect()
    assert Counter(r.url for r in rows) == Counter(f"u{i}" for i in range(200))


def test_score_sink_goes_on_after_a_failure_between_tables(spark, tmp_path):
    """The second batch fails after its first table is written; started again, it replaces what it wrote."""
    src, out, log = (str(tmp_path / name) for name in ("in", "out", "log"))
    schema = "doc_id long, text string"
    rows = [(i, "x" * (i % 30)) for i in range(90)]
    put(spark, src, rows[:40], schema)
    failing = {"on": False}

    def score(docs):
        long = F.length("text") > 20
        # The column fails only where the second table's rows are read, after the first one is written.
        said = F.when(F.length("text") < 5, None).when(long, "1").otherwise("0")
        return docs.withColumn("prediction", said)

    def reject(batch):
        if failing["on"]:
            partial = score(batch).filter("prediction = '1'").withColumn("batch_id", F.lit(1)).write.partitionBy("batch_id").mode("overwrite")
            partial.option("partitionOverwriteMode", "dynamic").parquet(f"{out}/positives")
            raise RuntimeError("executor lost")
        empty = F.length("text") == 0
        return batch.filter(~empty), batch.filter(empty).withColumn("reason", F.lit("empty"))

    def run():
        stream = spark.readStream.schema(schema).parquet(src)
        return flows.score_stream(stream, score, out, log, reject, {"processingTime": "1 second"})

    query = run()
    query.processAllAvailable()
    query.stop()
    put(spark, src, rows[40:], schema)
    failing["on"] = True
    query = run()
    with pytest.raises(StreamingQueryException):
        query.processAllAvailable()
    failing["on"] = False
    query = run()
    query.processAllAvailable()
    query.stop()
    lost = forget_commit(log)
    assert lost == 1
    query = run()
    query.processAllAvailable()
    query.stop()
    found = {part: Counter(r.doc_id for r in spark.read.parquet(f"{out}/{part}").collect()) for part in ("positives", "negatives", "rejects")}
    assert found["positives"] == Counter(i for i, t in rows if len(t) > 20)
    assert found["negatives"] == Counter(i for i, t in rows if 5 <= len(t) <= 20)
    assert found["rejects"] == Counter(i for i, t in rows if len(t) < 5)
