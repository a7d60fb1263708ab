"""Word and gram vectors: buckets, training against plain loops, nearness, the index, and tuning on all rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from presslens.catalog.registry import table
from presslens.operators import embeddings, learners, neighbours

SCHEMA = "doc_id long, label int, tokens array<string>"


def topics(n: int, seed: int = 1) -> list[tuple]:
    """Texts of two classes with words of their own, shared words, and a few words of the other class."""
    draw = random.Random(seed)
    own = [[f"{name}{k}" for k in range(12)] for name in ("left", "right")]
    shared = [f"word{k}" for k in range(30)]
    rows = []
    for i in range(n):
        label = i % 2
        words = [draw.choice(own[label] if draw.random() < 0.9 else own[1 - label]) if draw.random() < 0.4 else draw.choice(shared) for _ in range(25)]
        rows.append((i, label, words))
    return rows


@pytest.fixture(scope="module")
def rows(spark):
    docs = spark.createDataFrame(topics(240), SCHEMA)
    written = learners.embedding_rows(docs, "tokens", 2, 3).withColumn("is_train", F.col("doc_id") < 160)
    return written.cache()


def test_buckets_and_shares(spark):
    docs = spark.createDataFrame([(1, ["a", "b", "a", "a"]), (2, []), (3, ["b"])], "doc_id long, words array<string>")
    got = {r.doc_id: dict(zip(r.ids, r.shares, strict=True)) for r in embeddings.bucketed(docs).collect()}
    numbers = docs.select(F.explode("words").alias("w")).distinct().select("w", embeddings.bucket_of(F.col("w")).alias("b"))
    bucket = {r.w: r.b for r in numbers.collect()}
    assert got == {1: {bucket["a"]: 0.75, bucket["b"]: 0.25}, 2: {}, 3: {bucket["b"]: 1.0}}
    assert all(0 <= b < embeddings.BUCKETS for b in bucket.values()) and embeddings.BUCKETS >= 1 << 18


def test_training_is_the_plain_loop(rows):
    """One part: the result is that of a loop over texts, word by word; more rounds only cut the epochs."""
    texts = sorted(rows.filter("is_train").collect(), key=lambda r: r.doc_id)
    dim, lr, epoch = 7, 0.5, 6
    known = sorted({b for r in texts for b in r.ids})
    vectors = dict(zip(known, embeddings.first_vectors(np.array(known), dim).astype(float), strict=True))
    output = np.zeros((2, dim))
    for e in range(epoch):
        step = lr * (1 - e / epoch)
        held, before, turn = output.copy(), {b: v.copy() for b, v in vectors.items()}, np.zeros((2, dim))
        for d in np.random.default_rng((embeddings.SEED, e)).permutation(len(texts)):
            row = texts[d]
            hidden = sum(s * vectors[b] for b, s in zip(row.ids, row.shares, strict=True))
            scores = np.exp(held @ hidden)
            error = step * ((np.arange(2) == row.label) - scores / scores.sum())
            for b, s in zip(row.ids, row.shares, strict=True):
                turn += np.outer(error, s * before[b])
                vectors[b] = vectors[b] + s * (error @ held)
        output = held + turn * min(1, max(embeddings.FIRST_STEP, np.linalg.norm(held)) / np.linalg.norm(turn))
    for rounds in (1, 4):
        model = embeddings.train(rows.filter("is_train"), dim, lr, epoch, rounds=rounds, part_rows=10_000)
        got = {r.bucket: np.array(r.vector) for r in model.vectors.collect()}
        assert sorted(got) == known
        assert max(np.abs(got[b] - vectors[b]).max() for b in known) < 1e-3
        assert np.abs(model.output - output).max() < 1e-3


@pytest.mark.parametrize("part_rows", [10_000, 40])
def test_classes_are_told_apart_and_words_lie_together(spark, rows, part_rows):
    model = embeddings.train(rows.filter("is_train"), 20, 1.0, 30, part_rows=part_rows)
    said = model.predict(rows.filter("NOT is_train")).collect()
    assert len(said) == 80 and np.mean([str(r.label) == r.predicted for r in said]) > 0.9
    assert all((r.probability > 0.5) == (r.predicted == "1") for r in said)
    words = spark.createDataFrame([(f"{name}{k}", name) for name in ("left", "right") for k in range(12)], "term string, side string")
    found = model.word_vectors(words).collect()
    assert len(found) == 24
    unit = {r.term: np.array(r.vector) / np.linalg.norm(r.vector) for r in found}
    same = np.mean([unit["left0"] @ unit[f"left{k}"] for k in range(1, 12)])
    other = np.mean([unit["left0"] @ unit[f"right{k}"] for k in range(12)])
    assert same > 0.8 and other < 0


def test_unknown_words_and_empty_texts(spark, rows):
    model = embeddings.train(rows.filter("is_train"), 5, 1.0, 3)
    docs = spark.createDataFrame([(1, 0, ["never", "seen"]), (2, 1, [])], SCHEMA)
    said = model.predict(embeddings.bucketed(docs, "tokens")).collect()
    assert [r.probability for r in said] == [0.5, 0.5]


def test_index_recall_of_the_given_vectors(spark, sf):
    vectors = table(spark, sf, "embeddings")
    asked = neighbours.centroids(vectors, "label")
    exact = {(r.query_id, r.vec_id): r.cosine for r in neighbours.nearest(vectors, asked, 12).collect()}
    found = neighbours.ProjectionIndex.build(vectors).nearest(asked, 12).collect()
    got = {(r.query_id, r.id): r.cosine for r in found}
    assert len(set(exact) & set(got)) >= 0.9 * len(exact)
    assert all(got[pair] == exact[pair] for pair in set(exact) & set(got))


def test_index_recall_of_many_vectors(spark, monkeypatch):
    """Vectors around centres; queries in several blocks; null vectors are left out."""
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(150, 48))
    points = centres[draw.integers(0, 150, 6000)] + 0.6 * draw.normal(size=(6000, 48))
    rows = [(i, p.tolist()) for i, p in enumerate(points)] + [(9999, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    asked = spark.createDataFrame([(k, points[k * 50].tolist()) for k in range(100)], "query_id long, vector array<float>")
    monkeypatch.setattr(neighbours, "BLOCK_QUERIES", 30)
    exact = {(r.query_id, r.vec_id) for r in neighbours.nearest(vectors, asked, 10).collect()}
    index = neighbours.ProjectionIndex.build(vectors)
    found = index.nearest(asked, 10).collect()
    assert len(exact) == 1000 and len({(r.query_id, r.id) for r in found} & exact) >= 900
    ranks = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        ranks.setdefault(r.query_id, []).append((r.rank, -r.cosine))
    assert all(x == sorted(x) and [a for a, _ in x] == list(range(1, len(x) + 1)) for x in ranks.values())
    # A table is asked for a small part of its rows.
    candidates = index.codes.join(spark.createDataFrame(index.probes(points[0], 16), "table int, code int"), ["table", "code"])
    assert candidates.count() < 0.3 * index.codes.count()


def test_tuning_uses_every_row(spark):
    from pyspark.ml.linalg import Vectors

    draw = random.Random(3)
    rows = [(i, float(i % 2), Vectors.dense([draw.gauss(i % 2, 0.7) for _ in range(9)])) for i in range(61)]
    train = spark.createDataFrame(rows, ["doc_id", "label", "features"])
    found = learners.tune(train, [2, 3], folds=5, repeats=2, trees=5).collect()
    assert {r.mtry for r in found} == {2, 3}
    assert all((r.scored, r.repeats, r.folds) == (122, 2, 5) and r.accuracy > 0.6 for r in found)


def test_a_round_moves_the_vectors_to_few_parts(rows, monkeypatch):
    """However many texts, there are few parts, each a task of its own; more only where a part's texts would not fit a task."""
    seen, plain = [], embeddings._round

    def spy(texts, *rest):
        sizes = texts.groupBy("part", F.spark_partition_id().alias("task")).count().collect()
        seen.append((len(sizes), len({r.part for r in sizes}), len({r.task for r in sizes}), sum(r["count"] for r in sizes)))
        return plain(texts, *rest)

    monkeypatch.setattr(embeddings, "_round", spy)
    train = rows.filter("is_train")
    embeddings.train(train, 5, 1.0, 2, part_rows=1)
    assert seen == [(embeddings.MAX_PARTS,) * 3 + (160,)] * 2
    seen.clear()
    entries = train.agg(F.sum(F.size("ids"))).first()[0]
    monkeypatch.setattr(embeddings, "PART_ENTRIES", entries // 6)
    model = embeddings.train(train, 20, 1.0, 30, part_rows=1)
    assert seen[0][3] == 160 and 6 <= seen[0][1] <= 7
    said = model.predict(rows.filter("NOT is_train")).collect()
    assert np.mean([str(r.label) == r.predicted for r in said]) > 0.9


def test_a_round_leaves_no_vectors_behind(spark, rows):
    """The tables of a round go when the next one is written, those of the last with the model's own."""
    from presslens import session

    before = set(session._handed_out)
    model = embeddings.train(rows.filter("is_train"), 5, 1.0, 5)
    left = [path for path in session._handed_out if path not in before]
    assert len(left) == 1 and model.vectors.count() > 0
