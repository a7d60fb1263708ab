"""Learners that are aggregates over the long form, against plain versions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from presslens.operators import bayes, boosting, learners


def table(n: int = 200, terms: int = 12, seed: int = 5):
    """(dense matrix, labels): sparse weights, some terms in one class only, one constant."""
    draw = random.Random(seed)
    x = np.zeros((n, terms))
    y = np.array([draw.random() < 0.4 for _ in range(n)], int)
    for i in range(n):
        for t in range(terms):
            if draw.random() < 0.3 + 0.05 * t * (y[i] if t % 2 else 1 - y[i]):
                x[i, t] = round(draw.random() * (1 + y[i] * (t % 3)), 2)
    x[:, 0] = 0.5
    x[:, 1] *= y
    return x, y


def long_form(spark, x, y):
    rows = [(int(i), f"t{t:02d}", float(x[i, t])) for i in range(len(x)) for t in range(x.shape[1]) if x[i, t] > 0]
    weights = spark.createDataFrame(rows, "doc_id long, term string, weight double").repartition(4)
    labels = spark.createDataFrame([(int(i), int(v)) for i, v in enumerate(y)], "doc_id long, label int")
    return weights, labels


def test_gaussian_predictions(spark):
    x, y = table()
    weights, labels = long_form(spark, x, y)
    train, test = labels.filter("doc_id < 140"), labels.filter("doc_id >= 140")
    got = {r.doc_id: r.predicted for r in bayes.gaussian_predictions(weights, train, test).collect()}
    seen = np.flatnonzero(x[:140].any(axis=0))
    moments = {c: (x[:140][y[:140] == c][:, seen].mean(axis=0), x[:140][y[:140] == c][:, seen].var(axis=0)) for c in (0, 1)}
    extra = bayes.SMOOTHING * max(v.max() for _, v in moments.values())
    for i in range(140, 200):
        scores = []
        for c in (0, 1):
            mean, variance = moments[c][0], moments[c][1] + extra
            density = -0.5 * np.log(2 * math.pi * variance) - (x[i, seen] - mean) ** 2 / (2 * variance)
            scores.append(math.log((y[:140] == c).mean()) + density.sum())
        assert got[i] == str(int(np.argmax(scores))), (i, scores)
    assert len(got) == 60


def test_gaussian_without_terms(spark):
    """A document without any known term gets the class of the baselines; unknown terms don't count."""
    weights = spark.createDataFrame([(1, "a", 1.0), (2, "a", 0.9), (3, "b", 1.0), (4, "b", 1.1), (9, "new", 5.0)], "doc_id long, term string, weight double")
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, 1)], "doc_id long, label int")
    docs = spark.createDataFrame([(9,), (10,)], "doc_id long")
    said = {r.doc_id: r.predicted for r in bayes.gaussian_predictions(weights, labels, docs).collect()}
    assert said[9] == said[10]


def plain_boost(x, y, rounds, bins):
    n, terms = x.shape
    cuts = []
    for t in range(terms):
        values = np.sort(x[:, t][x[:, t] > 0])
        quantiles = [values[max(0, math.ceil(k / bins * len(values)) - 1)] for k in range(1, bins)] if len(values) else []
        cuts.append([0.0, *sorted(set(quantiles))])
    score, stumps = np.zeros(n), []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-2 * score))
        w = np.maximum(p * (1 - p), 1e-10)
        z = np.clip((y - p) / w, -boosting.MOST, boosting.MOST)
        best = None
        for t in range(terms):
            for cut in cuts[t]:
                above = x[:, t] > cut
                wa, wb = w[above].sum(), w[~above].sum()
                if wa <= 1e-9 or wb <= 1e-9:
                    continue
                sa, sb = (w * z)[above].sum(), (w * z)[~above].sum()
                gain = round(sa * sa / wa + sb * sb / wb, 9)
                if best is None or gain > best[0]:
                    best = gain, t, cut, 0.5 * sb / wb, 0.5 * sa / wa
        _, t, cut, below, high = best
        stumps.append((f"t{t:02d}", cut, below, high))
        score += np.where(x[:, t] > cut, high, below)
    return stumps, score


@pytest.mark.parametrize("bins", [4, 64])
def test_logit_boost(spark, bins):
    x, y = table()
    weights, labels = long_form(spark, x, y)
    model = boosting.fit(weights, labels, 8, bins)
    stumps, score = plain_boost(x, y, 8, bins)
    for got, want in zip(model.stumps, stumps, strict=True):
        assert (got.term, got.cut) == want[:2]
        assert abs(got.below - want[2]) < 1e-6 and abs(got.above - want[3]) < 1e-6
    said = {r.doc_id: r for r in model.predict(weights, labels).collect()}
    assert all(abs(said[i].probability - 1 / (1 + math.exp(-2 * score[i]))) < 1e-6 for i in range(200))
    assert np.mean([int(said[i].predicted) == y[i] for i in range(200)]) > 0.75


def test_class_weights_move_the_svm(spark):
    """A heavier topic class is found more often."""
    from pyspark.ml.linalg import Vectors

    draw = random.Random(2)
    rows = [(i, float(i % 4 == 0), Vectors.dense([draw.gauss(i % 4 == 0, 1.5), draw.gauss(0, 1)])) for i in range(200)]
    docs = spark.createDataFrame(rows, ["doc_id", "label", "features"])
    found = []
    for weight in (1.0, 6.0):
        weighted = learners.class_weights(docs, weight)
        model = learners.linear_svm(200, 1.0, "weight").fit(weighted)
        found.append(model.transform(docs).filter("prediction = 1").count())
    assert found[1] > found[0] + 20


def test_boosted_stumps_of_stored_values(spark):
    """Sparse and dense vectors, weights below 0 among them; no row of the width of the vocabulary is made."""
    from pyspark.ml.linalg import Vectors

    x, y = table()
    x[:, 3] -= (x[:, 3] > 0) * 0.8
    x[:, 5] *= -1
    vectors = [Vectors.dense(r) if i % 2 else Vectors.sparse(len(r), [(t, v) for t, v in enumerate(r) if v]) for i, r in enumerate(x.tolist())]
    rows = spark.createDataFrame([(i, float(y[i]), v) for i, v in enumerate(vectors)], ["doc_id", "label", "features"])
    said = {r.doc_id: r for r in learners.boosted_stumps(rows.filter("doc_id < 150"), rows.filter("doc_id >= 150"), rounds=8).collect()}
    both = np.concatenate((np.maximum(x, 0), np.maximum(-x, 0)), axis=1)
    stumps, _ = plain_boost(both[:150], y[:150], 8, boosting.BINS)
    assert sorted(said) == list(range(150, 200)) and any(int(t[1:]) >= x.shape[1] for t, *_ in stumps)
    for i in range(150, 200):
        score = sum(high if both[i, int(t[1:])] > cut else below for t, cut, below, high in stumps)
        assert abs(said[i].probability - 1 / (1 + math.exp(-2 * score))) < 1e-6


def test_baselines_take_no_dense_rows(spark, monkeypatch):
    """MLlib's boosted trees hold one number per row and feature."""
    import pyspark.ml.classification as ml

    from presslens.plans import training
    from presslens.operators.tfidf import TfidfModel

    def never(*_):
        raise AssertionError("dense")

    monkeypatch.setattr(ml.GBTClassifier, "_fit", never)
    x, y = table(120)
    from pyspark.ml.linalg import Vectors

    rows = [(i, float(y[i]), i % 3 > 0, Vectors.sparse(12, [(t, v) for t, v in enumerate(r) if v])) for i, r in enumerate(x.tolist())]
    rows = spark.createDataFrame(rows, ["doc_id", "label", "is_train", "features"])
    found = training.baselines(training.Matrix(rows, TfidfModel(None, 80), 12, {}), trees=3)
    assert list(found) == ["svm\nbaseline", "nb\nbaseline", "logitboost\nbaseline", "random forests\nbaseline"]
    assert all(f.count() == 18 for f in found.values())
