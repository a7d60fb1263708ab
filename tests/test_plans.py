"""Retraining, scoring and archive runs from end to end."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from presslens.catalog.models import corpus
from presslens.catalog.registry import gazetteer, table
from presslens.functions.text import clean_delete, ngram_rows
from presslens.operators import counts as ct
from presslens.operators import learners
from presslens.operators.entities import ENTITY_TYPES
from presslens.operators.metrics import METRICS, compare
from presslens.plans import archive, scoring, training
from presslens.session import materialise
from presslens.sources.pages import extract_articles
from presslens.sinks.bundles import current_bundle
from presslens.sinks.tables import write_snapshot_csv
from presslens.streaming import flows


@pytest.fixture(scope="module")
def rows(spark, sf):
    return materialise(corpus(spark, sf), "corpus")


@pytest.fixture(scope="module")
def bundle(spark, rows):
    return training.train(rows, gazetteer(spark), trees=10, language=None, min_count=5, fitted_on="2024-01-31")


@pytest.mark.parametrize("n_min, n_max, slots", [(1, 5, 1 << 22), (2, 5, 1), (3, 4, 1 << 22), (1, 1, 50)])
def test_staged_vocabulary_loses_nothing(spark, sf, n_min, n_max, slots):
    words = ct.tokens_of(table(spark, sf, "documents"))
    got = ct.frequent_vocabulary(words, n_min, n_max, 10, slots=slots)
    want = ct.prune(ct.vocabulary(ct.term_counts(ngram_rows(words, "words", n_min, n_max))), 10)
    want = materialise(want, "want")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(got.columns)).count() == 0


def test_card_describes_the_run(bundle, rows):
    card = bundle.card.first()
    assert card["n_tree"] == 10 and card["fitted_on"] == "2024-01-31"
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    assert card["sample_size"] == sum(-(-n * 7 // 10) for n in sizes.values())
    assert 0.5 < card["model_accuracy"] <= 1


def test_promotion_and_reloaded_scores(spark, sf, bundle, tmp_path):
    root = str(tmp_path / "models")
    assert archive.challenge(spark, bundle, root, "v1")
    assert not archive.challenge(spark, bundle, root, "v2")  # equal F1 is not better
    loaded = current_bundle(spark, root)
    docs = table(spark, sf, "documents").select("doc_id", "text")
    first = scoring.score_batch(docs, bundle, gazetteer(spark)).select("doc_id", "prediction").collect()
    again = scoring.score_batch(docs, loaded, gazetteer(spark)).select("doc_id", "prediction").collect()
    assert sorted(first) == sorted(again) and len(first) == docs.count()
    short = {r["doc_id"] for r in docs.filter("length(text) <= 80").collect()}
    assert short <= {r["doc_id"] for r in first if r["prediction"] is None}


def test_run_with_feed(spark, sf, bundle, tmp_path):
    pages = table(spark, sf, "pages")
    urls = [r["url"] for r in pages.orderBy("page_id").limit(20).collect()]
    # every other article has the page's own title; the others' titles differ and bring no columns
    titles = {r["url"]: r["title"] for r in extract_articles(pages).collect()}
    feed = [(titles.get(u) if i % 2 else f"t{i}", u, datetime(2024, 1, 1)) for i, u in enumerate([*urls, None])]
    feed = spark.createDataFrame(feed, "titleArticle string, urlArticle string, datetimeArticle timestamp")
    out = str(tmp_path / "run")
    scoring.scheduled_run(pages, bundle, out, "2024-01-31 12:00:00", gazetteer(spark), feed)
    positives = spark.read.parquet(f"{out}/positives")
    assert positives.columns[:3] == ["prediction_covid_topic", "title", "description"] and "pred_input" in positives.columns
    assert positives.filter("gdelt_url <> url OR gdelt_title <> title").count() == 0
    assert positives.filter("gdelt_title IS NOT NULL").count() <= 10
    assert 0 < positives.count() <= 20


def test_published_archive_keeps_earliest(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    for hour, urls in ((10, ["a", "b"]), (11, ["b", "c"])):
        df = spark.createDataFrame([(u, f"{u} at\n{hour}") for u in urls], "url string, title string")
        write_snapshot_csv(df.coalesce(1), path, f"2024-01-01 {hour}:00:00")
    rows = archive.published(spark, f"{path}/*/*.csv")
    assert rows.count() == 3


def test_five_baselines(spark, rows):
    matrix = training.training_matrix(rows, None, min_count=5, language=None)
    results = training.baselines(matrix, trees=5, texts=rows.select("doc_id", "text"), epoch=5, dim=8, word_ngrams=2)
    table = compare(results, "2024-01-31", matrix.rows.filter("is_train").count(), 0.8)
    assert table.count() == 5 * len(METRICS)
    accuracy = table.filter(F.col("metric") == "Accuracy").select(F.min("value")).first()[0]
    assert accuracy > 0.3


def test_a_training_document_scores_with_its_training_vector(spark, rows):
    """Entities come from the text as it is in both, and a mention across a line break counts in both."""
    gaz = spark.createDataFrame([("alpha beta", "DBpedia:Person", 0.9), ("COVID-19", "DBpedia:Disease", 0.9)], "surface string, types string, confidence double")
    filler = " ".join(f"word{i} other{i % 7}" for i in range(40))
    docs = [(i, f"{filler} alpha\nbeta, covid 19/alpha beta {i % 3}", i % 2) for i in range(40)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, label int")
    matrix = training.training_matrix(docs, gaz, min_count=2, language=None)
    clean = docs.select("doc_id", "text", clean_delete(F.col("text")).alias("clean"))
    scored = training.matrix_of(clean, "clean", matrix.tfidf, gaz, matrix.options)
    trained = {r["doc_id"]: r["features"] for r in matrix.rows.collect()}
    again = {r["doc_id"]: r["features"] for r in scored.collect()}
    assert trained == again
    kinds = dict(zip(ENTITY_TYPES, trained[0].toArray()[matrix.tfidf.size :], strict=False))
    assert kinds["Person"] == 2 and kinds["Disease"] == 1


def test_stream_scores_lose_nothing(spark, sf, bundle, tmp_path):
    docs = table(spark, sf, "documents")
    stream = spark.readStream.schema(docs.schema).parquet(f"{sf}/documents*.parquet").select("doc_id", "text")
    # raw text long enough, cleaned text too short: neither positive nor negative
    out = str(tmp_path / "scored")
    flows.score_stream(stream, lambda d: scoring.score_batch(d, bundle), out, str(tmp_path / "log")).awaitTermination()
    parts = [spark.read.schema("doc_id long").parquet(f"{out}/{p}") for p in ("positives", "negatives", "rejects")]
    ids = [r["doc_id"] for p in parts for r in p.collect()]
    assert sorted(ids) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_settings_of_the_learners():
    assert learners.linear_svm(50, 2.0).getRegParam() == 1 / 100
    forest = learners.random_forest_research(900)
    assert (forest.getNumTrees(), forest.getFeatureSubsetStrategy(), forest.getMinInstancesPerNode()) == (500, "10", 5)
