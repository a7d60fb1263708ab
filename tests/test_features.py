from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from presslens.functions.text import ngram_rows
from presslens.operators import counts as ct
from presslens.operators import entities as en
from presslens.operators import tfidf as tf
from presslens.session import BROADCAST_ROWS, new_path

DOCS = [(1, "a a b"), (2, "a c"), (3, "b b b b"), (4, "zzz")]


def fit(spark, variant="plus_one_below"):
    docs = spark.createDataFrame(DOCS[:3], "doc_id long, text string")
    grams = ngram_rows(ct.tokens_of(docs), "words", 1, 1)
    return tf.TfidfModel.fit(ct.vocabulary(ct.term_counts(grams)), 3, variant)


def test_idf_variants(spark):
    expected = {
        "plus_one_below": {"a": math.log(3 / 3), "b": math.log(3 / 3), "c": math.log(3 / 2)},
        "plus_one_outside": {"a": math.log(1 + 3 / 2), "b": math.log(1 + 3 / 2), "c": math.log(4)},
        "plain": {"a": math.log(3 / 2), "b": math.log(3 / 2), "c": math.log(3)},
    }
    for variant in tf.IDF_VARIANTS:
        got = {r["term"]: r["idf"] for r in fit(spark, variant).table.collect()}
        assert got == pytest.approx(expected[variant])
    with pytest.raises(ValueError):
        fit(spark, "other")


def test_transform_ignores_unseen_terms_and_survives_saving(spark):
    model = fit(spark, "plain")
    path = new_path(spark, "test-tfidf")
    model.save(path)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    grams = ngram_rows(ct.tokens_of(docs), "words", 1, 1)
    for m in (model, tf.TfidfModel.load(spark, path)):
        got = {(r["doc_id"], r["term"]): r["weight"] for r in m.transform(grams).collect()}
        assert set(d for d, _ in got) == {1, 2, 3}
        assert got[1, "a"] == pytest.approx(2 / 3 * math.log(3 / 2))
        assert got[2, "c"] == pytest.approx(1 / 2 * math.log(3))


def test_tidy_rows_sum_to_one(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    counts = ct.term_counts(ngram_rows(ct.tokens_of(docs), "words", 1, 1))
    with_df = counts.join(ct.min_df(counts, 1), "term")
    sums = tf.tfidf_tidy(with_df).groupBy("doc_id").agg(F.sum("tf").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1) for r in sums) and len(sums) == 4


def test_vectors_of_every_document(spark):
    long = spark.createDataFrame([(1, 0, 0.5), (1, 3, 0.25)], "doc_id long, term_id int, weight double")
    ids = spark.createDataFrame([(1,), (2,)], "doc_id long")
    got = {r["doc_id"]: r["features"] for r in tf.to_vectors(long, 5, ids=ids).collect()}
    assert got[1].toArray().tolist() == [0.5, 0, 0, 0.25, 0] and got[2].numNonzeros() == 0


GAZETTEER = [
    ("porto", "DBpedia:Organisation", 0.9),
    ("porto santo", "DBpedia:Person,DBpedia:Work,Schema:Thing", 0.8),
    ("santo", "DBpedia:Drug", 0.4),
    ("vila", "DBpedia:Place", 0.9),
    ("a b c d e", "DBpedia:Disease", 0.5),
]


def test_longest_match_confidence_and_types(spark):
    gaz = spark.createDataFrame(GAZETTEER, "surface string, types string, confidence double")
    rows = [(1, "O Porto Santo, porto e vila; santo"), (2, "nada"), (3, "x a b c d e"), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = en.annotate(docs, gaz)
    by_gram = en.annotate(docs, gaz, max_rows=0)
    assert sorted(found.collect()) == sorted(by_gram.collect())
    got = {(r["doc_id"], r["start"], r["surfaceForm"]) for r in found.collect()}
    assert got == {(1, 1, "porto santo"), (1, 3, "porto"), (3, 1, "a b c d e")}
    filled = en.with_entity_counts(docs.select("doc_id"), en.entity_counts(found)).collect()
    by_id = {r["doc_id"]: r for r in filled}
    assert by_id[1]["entity_count_Person"] == 1 and by_id[1]["entity_count_Organisation"] == 1
    assert all(v == 0 for k, v in by_id[2].asDict().items() if k != "doc_id")


def test_entity_text_can_be_cut(spark):
    gaz = spark.createDataFrame(GAZETTEER, "surface string, types string, confidence double")
    docs = spark.createDataFrame([(1, "x " * 2500 + "porto")], "doc_id long, text string")
    assert en.annotate(docs, gaz).count() == 1
    assert en.annotate(docs, gaz, max_chars=5000).count() == 0


def test_surfaces_are_words_of_any_number_and_keep_all_types(spark):
    rows = [
        ("COVID-19", "DBpedia:Disease", 0.9), ("Covid 19", "DBpedia:Work", 0.6), ("covid-19", "DBpedia:Person", 0.1),
        ("one two three four five six seven", "DBpedia:Person", 0.9), ("--", "DBpedia:Person", 0.9),
    ]
    gaz = spark.createDataFrame(rows, "surface string, types string, confidence double")
    docs = spark.createDataFrame([(1, "the Covid-19 case; one two three, four five six seven eight")], "doc_id long, text string")
    got = {(r["start"], r["surfaceForm"], r["types"]) for r in en.annotate(docs, gaz).collect()}
    assert got == {(1, "covid 19", "DBpedia:Disease,DBpedia:Work"), (4, "one two three four five six seven", "DBpedia:Person")}


def test_many_surfaces_behind_one_word(spark):
    """A word that begins thousands of surfaces is one row of the trie, and texts find the longest of them."""
    names = [f"north n{i}" + (f" m{i}" if i % 3 == 0 else "") for i in range(5000)] + ["north", "north n7 x y z"]
    gaz = spark.createDataFrame([(n, "DBpedia:Person", 0.9) for n in names], "surface string, types string, confidence double")
    texts = ["north", "to north n7 x y", "north n7 x y z", "North n9 m9 north n9 m8", "n9 north", "north n4999 north n5000", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = []
    for i, text in enumerate(texts):
        words = text.lower().split()
        for a in range(len(words)):
            fits = [" ".join(words[a:b]) for b in range(a + 1, len(words) + 1) if " ".join(words[a:b]) in names]
            if fits:
                want.append((i, a, fits[-1]))
    for rows in (BROADCAST_ROWS, 0):
        got = en.annotate(docs, gaz, max_rows=rows).collect()
        assert sorted((r["doc_id"], r["start"], r["surfaceForm"]) for r in got) == want
    nodes = en.trie(en.wanted_surfaces(gaz))
    assert nodes.filter("level = 1").count() == 1 and nodes.filter("level = 2").count() == 5000
