"""The pipeline against plain Python, stage by stage and as a whole."""

from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from presslens.llm.catalog import tokenizer
from tests.llm import data
from tests.llm.test_operators import BENCH, ROWS, check_packing


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(ROWS, data.SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], i % 2, 0) for i, r in enumerate(ROWS)] + [(1, None, None), (99_999, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(BENCH, "item_id int, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def plain_stages(rows):
    """(doc_id, text) after each filtering stage; a handful of labels certifies no cutoff."""

    def good(text):
        n, _, _, _, again = data.quality_counts(text)
        return n >= 50 and 100 * again <= 50 * n

    rows = [r for r in rows if good(r[1])]
    yield rows
    group = data.groups(dict(rows), width=5)
    rows = [r for r in rows if group[r[0]] == r[0]]
    yield rows
    left = data.without_spans(dict(rows))
    rows = [(d, left[d]) for d, _ in rows]
    yield rows

    def dirty(text):
        n, hit, _ = data.hits(text, BENCH)
        return hit > 0 and 20 * hit >= n

    rows = [r for r in rows if not dirty(r[1])]
    yield rows


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for (name, stage), want in zip(corpus_pipeline.STAGES[:-1], plain_stages([(r[0], r[1]) for r in ROWS]), strict=True):
        path = f"{folder}/{name.replace(' ', '-')}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert docs.columns == columns, name
        assert Counter((r.doc_id, r.text) for r in docs.collect()) == Counter(want), name
    assert want


def test_run(spark, folder):
    from tokenizers import Tokenizer

    *_, want = plain_stages([(r[0], r[1]) for r in ROWS])
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == {d for d, _ in want}
    check_packing(rows, Tokenizer.from_file(tokenizer()), want, 2048)


def test_empty_tables(spark, folder, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_are_as_asked():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "repeated spans", "benchmark passages", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_near_duplicates_take_five_words(spark):
    """One word of 40 changed: 0.805 on four words, 0.756 on five."""
    own = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(own)), (2, " ".join([*own[:20], "changed", *own[21:]])), (3, " ".join(own))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()} == {1, 2}
