"""A key with a third or more of all rows must neither change results nor gather in one task."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslens.operators import joins, neighbours, split, tfidf
from presslens.operators.dedupe import keep_first, keep_first_by_text, top_n_with_ties
from presslens.session import materialise


def hot(spark, n=3000):
    key = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50))
    return spark.range(n).select(F.col("id").alias("doc_id"), key.alias("key"))


def test_keep_first_of_a_hot_key(spark):
    rows = hot(spark).repartition(13)
    got = {r["key"]: r["doc_id"] for r in keep_first(rows, ["key"], ["doc_id"]).collect()}
    want = {r["key"]: r["doc_id"] for r in rows.groupBy("key").agg(F.min("doc_id").alias("doc_id")).collect()}
    assert got == want
    again = keep_first(keep_first(rows, ["key"], ["doc_id"]), ["key"], ["doc_id"])
    assert again.count() == len(want)


def test_keep_first_sends_one_row_per_task(spark):
    plan = keep_first(hot(spark), ["key"], ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_keep_first_by_text_with_null_text(spark):
    rows = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, "a", 1), (4, None, 0), (5, None, 0)], "doc_id int, text string, label int")
    got = {tuple(r) for r in keep_first_by_text(rows, "text", ["label"], ["doc_id"]).collect()}
    assert got == {(1, "a", 0), (3, "a", 1), (4, None, 0)}


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_lookup_join_both_ways(spark, max_rows):
    rows = hot(spark)
    table = materialise(rows.groupBy("key").agg(F.count("*").alias("total")).filter("key <> 'k1'"), "lookup")
    joined = joins.lookup_join(rows, table, "key", "doc_id", max_rows=max_rows)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert ("_salt" in plan) == (max_rows == 0)
    got = Counter(r["key"] for r in joined.collect())
    assert got == {r["key"]: r["total"] for r in table.collect()}


def test_natural_left_join_matches_null_keys(spark):
    left = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "a int, k string")
    right = spark.createDataFrame([(None, 10), ("x", 20)], "k string, b int")
    got = sorted((r["a"], r["b"]) for r in joins.natural_left(left, right).collect())
    assert got == [(1, 10), (2, 20), (3, None)]


def test_top_n_keeps_unbounded_ties(spark):
    rows = spark.range(2000).select(F.lit("g").alias("g"), F.col("id").alias("t"), F.lit(1).alias("n"))
    extra = spark.createDataFrame([("g", -1, 9), ("g", -2, 5), ("h", -3, 1)], "g string, t long, n int")
    top = top_n_with_ties(rows.unionByName(extra), "g", 3, "n", "t")
    ranks = Counter((r["g"], r["rank"]) for r in top.collect())
    assert ranks == {("g", 1): 1, ("g", 2): 1, ("g", 3): 2000, ("h", 1): 1}


@pytest.mark.parametrize("p, parts", [(0.7, 1), (0.7, 7), (0.5, 3), (1.0, 2)])
def test_split_sizes_and_independence_of_partitions(spark, p, parts):
    rows = spark.range(997).select(F.col("id").alias("doc_id"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    got = split.stratified_split(rows.repartition(parts), "label", p).collect()
    per_class = Counter(r["label"] for r in got)
    taken = Counter(r["label"] for r in got if r["is_train"])
    assert taken == {c: math.ceil(p * n) for c, n in per_class.items()}
    base = {r["doc_id"] for r in split.stratified_split(rows, "label", p).filter("is_train").collect()}
    assert base == {r["doc_id"] for r in got if r["is_train"]}


def test_folds_are_balanced(spark):
    rows = spark.range(505).select(F.col("id").alias("doc_id"), (F.col("id") % 5 == 0).cast("int").alias("label"))
    sizes = defaultdict(list)
    for r in split.cv_folds(rows, "label").groupBy("label", "fold").count().collect():
        sizes[r["label"]].append(r["count"])
    assert all(len(s) == 10 and max(s) - min(s) <= 1 for s in sizes.values())


def test_neighbours_match_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    queries = spark.createDataFrame([(q, rows[q][1]) for q in (3, 250)], "query_id long, vector array<double>")
    got = neighbours.nearest(df, queries, 12).collect()
    unit = vectors.astype(np.float32).astype(float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    for q in (3, 250):
        cosine = np.round(unit @ (vectors[q] / np.linalg.norm(vectors[q])), 6)
        want = np.lexsort((np.arange(300), -cosine))[:12].tolist()
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] == want
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 1)  # several blocks give the same rows
    assert sorted(neighbours.nearest(df, queries, 12).collect()) == sorted(got)


def test_dense_ids_are_a_permutation(spark):
    vocab = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("term"))
    ids = sorted(r["term_id"] for r in tfidf._dense_ids(vocab).collect())
    assert ids == list(range(5000))


def test_windows_of_words_are_sorted_in_smaller_tasks(spark, sf, monkeypatch):
    """Where a task sorts several rows a word, it gets so much less text; otherwise its sort spills."""
    from presslens import session
    from presslens.catalog import load

    monkeypatch.setattr(session, "TASK_BYTES", 20_000)
    text = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("sum(octet_length(text)) AS n").first()["n"]
    plan = load()[0]["collapse_tokens"](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert re.findall(r"RepartitionByExpression \[doc_id#\d+L?\], (\d+)", plan) == [str(-(-3 * text // 20_000))]
