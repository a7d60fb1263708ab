"""Candidate grams lose no frequent one and are few; tasks over documents grow in number, not in size."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from presslens import session
from presslens.functions import text as tx
from presslens.functions.text import ngram_rows
from presslens.operators import candidates, tfidf
from presslens.operators import counts as ct
from presslens.operators.candidates import Candidates
from presslens.operators.joins import lookup_join
from presslens.session import materialise, spread


def texts(spark, n=300):
    rng = random.Random(5)
    rows = [(i % (n - 9), " ".join(rng.choice(["o", "da", "x", "y", f"w{rng.randrange(400)}"]) for _ in range(rng.randrange(40)))) for i in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "o o da"), (None, "x y x y"), (None, "x y w1")]
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.mark.parametrize("slots", [1, 999, None])
def test_research_terms_in_enough_documents_keep_all_their_rows(spark, slots):
    docs = materialise(texts(spark), "texts")
    want = ct.term_counts(ct.research_grams(docs, ["o", "da"]))
    want = materialise(want.join(ct.min_df(want, 5), "term").select("doc_id", "term", "n"), "want")
    got = ct.frequent_research_counts(docs, ["o", "da"], 5, slots=slots)
    got = materialise(got.join(ct.min_df(got, 5), "term").select("doc_id", "term", "n"), "got")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_rare_grams_are_never_formed(spark):
    words = materialise(ct.tokens_of(texts(spark), partitioned=True), "words")
    formed = Candidates.fit(words, 5, 10).rows(words, 1, 5)
    every = ngram_rows(words, "words", 1, 5)
    rare = formed.groupBy("term").count().filter("count < 10").count()
    assert every.groupBy("term").count().filter("count < 10").count() > 5000
    assert rare < 50


def test_tasks_over_documents_grow_in_number_with_the_text(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_BYTES", 1000)
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("ten bytes ").alias("text"))
    dealt = spread(docs, "doc_id", size=F.octet_length("text"))
    assert dealt.rdd.getNumPartitions() == 20
    plan = ct.term_counts(ngram_rows(ct.tokens_of(docs), "words", 1, 2))._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan and ", 20), REPARTITION_BY_NUM" in plan and plan.count("Exchange") == 1


def test_a_large_vocabulary_is_joined_to_counts_in_tasks_by_text(spark, monkeypatch):
    """Not broadcast: one shuffle of the counts, over as many tasks as the text asks for; a document's repeats are one row."""
    monkeypatch.setattr(session, "TASK_BYTES", 500)
    docs = materialise(texts(spark), "texts")
    tokens = tx.token_rows(ct.tokens_of(docs))
    counts = ct.term_counts(tokens)
    vocab = materialise(ct.min_df(counts, 5), "vocabulary")
    tasks = session.tasks_for(docs, F.octet_length("text"))
    got = ct.restrict(counts, vocab, tasks, max_rows=0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert tasks > 20 and "hashpartitioning(term" in plan and f", {tasks}), REPARTITION_BY_NUM" in plan
    # The documents by id, their counts and the vocabulary by term: nothing is dealt out after the join.
    assert plan.count("Exchange hashpartitioning") == 3 and "ENSURE_REQUIREMENTS" not in plan
    want = materialise(tokens.join(vocab.select("term"), "term").groupBy("doc_id", "term").agg(F.count("*").alias("n")), "want")
    small = ct.restrict(counts, vocab, tasks)
    for found in (got, small):
        found = materialise(found, "found")
        assert found.columns == ["doc_id", "term", "n"] and found.count() == want.count() > 0
        assert found.exceptAll(want).count() == 0


@pytest.mark.parametrize("tasks", [None, 9])
def test_a_table_too_large_to_broadcast_is_never_broadcast_salted(spark, tasks):
    table = materialise(spark.range(500).withColumnRenamed("id", "key"), "table")
    rows = spark.range(2000).select((F.col("id") % 700).alias("key"), F.col("id").alias("by"))
    joined = lookup_join(rows, table, "key", "by", max_rows=499, tasks=tasks)
    assert joined.count() == 1500
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def grams_of(spark, monkeypatch, docs, **limits):
    for name, value in limits.items():
        monkeypatch.setattr(candidates, name, value)
    return ct.frequent_research_grams(materialise(docs, "texts"), ["o", "da"], 5)


def distinct_texts(spark):
    return texts(spark).filter("doc_id IS NOT NULL").dropDuplicates(["doc_id"])


def same(got, want):
    got, want = materialise(got, "got"), materialise(want.select(*got.columns), "want")
    return got.count() == want.count() > 0 and got.exceptAll(want).count() == 0


LIMITS = [{}, {"FILTER_BITS": 1 << 9, "MIN_SLOTS": 1 << 26}, {"HELD_ROWS": 40, "PART_WORDS": 300, "SLICE": 60, "PIECE_TERMS": 7, "PIECES_KEPT": 2}]


@pytest.mark.parametrize("limits", LIMITS)
def test_candidates_are_counted_and_looked_up_inside_their_rows(spark, monkeypatch, limits):
    """No gram is shuffled: neither by document nor by term; the numbers are those of all grams counted."""
    docs = distinct_texts(spark)
    grams = grams_of(spark, monkeypatch, docs, **limits)
    every = materialise(ct.term_counts(ct.research_grams(docs, ["o", "da"])), "every")
    frequent = ct.min_df(every, 5)
    counts = ct.term_counts(grams)
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert same(counts.join(frequent.select("term"), "term"), every.join(frequent.select("term"), "term"))
    vocab = materialise(ct.min_df(grams, 5), "vocabulary")
    assert same(vocab, frequent)
    assert same(ct.vocabulary(grams).filter("doc_count >= 5"), ct.vocabulary(every).filter("doc_count >= 5"))
    rows = tfidf.doc_rows(grams, vocab, ("doc_count",))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    assert same(tfidf.long_form(rows), every.join(frequent, "term"))
    want = tfidf.tfidf_tidy(every.join(frequent, "term")).withColumn("tf_idf", F.round("tf_idf", 9)).drop("tf", "idf")
    assert same(tfidf.tfidf_tidy(rows).withColumn("tf_idf", F.round("tf_idf", 9)).drop("tf", "idf"), want)


def test_documents_of_several_rows_are_counted_by_id(spark, monkeypatch):
    docs = texts(spark)
    grams = grams_of(spark, monkeypatch, docs)
    assert not grams.one_row_each()
    every = materialise(ct.term_counts(ct.research_grams(docs, ["o", "da"])), "every")
    frequent = ct.min_df(every, 5)
    vocab = materialise(ct.min_df(grams, 5), "vocabulary")
    assert same(vocab, frequent)
    assert same(tfidf.long_form(tfidf.doc_rows(grams, vocab, ("doc_count",))), every.join(frequent, "term"))


def test_weights_stay_with_their_documents(spark):
    """Vectors are made of the rows as they come; the weights are those of the grams looked up one by one."""
    words = materialise(ct.tokens_of(distinct_texts(spark), partitioned=True), "words")
    fitted = Candidates.fit(words, 5, 10)
    model = tfidf.TfidfModel.fit(ct.frequent_vocabulary(words, 1, 5, 10, candidates=fitted), words.count())
    grams = candidates.CandidateGrams(words, fitted, 1, 5)
    want = model.transform(ngram_rows(words, "words", 1, 5)).withColumn("weight", F.round("weight", 9))
    assert same(model.transform(grams).withColumn("weight", F.round("weight", 9)), want)
    rows = tfidf.to_entries(model.transform_rows(grams))
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    got = rows.select("doc_id", F.explode("entries").alias("e")).select("doc_id", "e.term_id", F.round("e.weight", 9).alias("weight"))
    assert same(got, want)
    assert rows.filter("entries <> array_sort(entries)").count() == 0


def test_two_terms_of_one_hash_are_joined_by_text(spark, monkeypatch):
    grams = grams_of(spark, monkeypatch, distinct_texts(spark))
    vocab = materialise(ct.min_df(grams, 5), "vocabulary")
    want = materialise(tfidf.long_form(tfidf.doc_rows(grams, vocab, ("doc_count",))), "want")
    monkeypatch.setattr(candidates, "gram_hash", lambda term, sep: F.length(term).cast("bigint"))
    assert candidates.Lookup.build(vocab, ("doc_count",), " ") is None
    assert same(tfidf.long_form(tfidf.doc_rows(grams, vocab, ("doc_count",))), want)
