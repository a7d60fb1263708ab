"""The forest on sparse rows, against splits tried one by one and against what its rows say."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from presslens.operators import forest, learners


def matrix(spark, n=240, wide=60, seed=7):
    """Rows of a few entries; feature 3 decides the label, feature 4 tells some of it, feature 5 is below 0 at times."""
    rng, rows = np.random.default_rng(seed), []
    for i in range(n):
        at = sorted({int(f) for f in rng.integers(6, wide, 8)} | ({3} if i % 3 == 0 else set()) | ({4} if i % 4 == 0 else set()) | {5})
        values = [float(rng.normal()) if f == 5 else float(rng.integers(1, 9)) for f in at]
        rows.append((i, float(i % 3 == 0), Vectors.sparse(wide, at, values)))
    return spark.createDataFrame(rows, ["doc_id", "label", "features"])


def test_a_forest_holds_no_number_for_absent_features(spark):
    """400 rows of 4 million features, of which each has two: as one number per feature they take 6.4 GB."""
    wide = 4_000_000
    rows = [(float(i % 2), Vectors.sparse(wide, [7 * i, wide - 2 + i % 2], [1.0, 2.0])) for i in range(400)]
    df = spark.createDataFrame(rows, ["label", "features"])
    chosen = learners.random_forest(wide, 2, wide, 2, depth=2)
    model = forest.fit(df, chosen)
    assert model.transform(df).filter("prediction = label").count() == 400
    assert {int(i) for i in model.featureImportances.indices} <= {wide - 2, wide - 1}


def test_splits_are_those_of_all_cuts_tried(spark):
    """One tree that tries all features and draws every row once: its root is the best of all cuts."""
    df = matrix(spark)
    model = forest.fit(df, learners.random_forest(60, 1, 60, 10, depth=1))
    x = np.array([r["features"].toArray() for r in df.collect()])
    y = np.array([r["label"] for r in df.collect()])
    impurity = lambda part: 1 - ((part == 0).mean() ** 2 + (part == 1).mean() ** 2) if len(part) else 0.0
    gains = []
    for f in range(x.shape[1]):
        for cut in np.unique(x[:, f])[:-1]:
            side = x[:, f] <= cut
            if min(side.sum(), (~side).sum()) >= 5:
                gains.append((impurity(y) - side.mean() * impurity(y[side]) - (~side).mean() * impurity(y[~side]), f))
    assert "feature 3 <= 0.0" in model.trees[0].toDebugString
    assert max(gains)[1] == 3
    assert model.transform(df).filter("prediction = label").count() == df.count()


def test_sums_of_a_level_are_those_of_its_rows(spark):
    """Both ways to read a block's entries give the same counts, absent entries included."""
    df = matrix(spark, wide=30)
    found = {}
    for tried in (1, 29):
        model = forest.fit(df, learners.random_forest(30, 7, tried, 2, depth=6))
        for tree in model.trees:
            assert tree.numNodes == 2 * sum(line.strip().startswith("Predict") for line in tree.toDebugString.splitlines()) - 1
        found[tried] = model.transform(df).filter("prediction = label").count()
    assert found[29] >= 230
    theirs = RandomForestClassifier._fit(learners.random_forest(30, 7, 29, 2, depth=6), df)
    assert abs(theirs.transform(df).filter("prediction = label").count() - found[29]) <= 12


def test_every_node_tries_as_many_features():
    for features in (1, 2, 30, 97):
        step, first = forest.draw(5, 3, 2, 4, features)
        order = np.random.default_rng(5).permutation(features)
        place = order * step % features
        assert sorted(place) == list(range(features))
        at_place = np.argsort(order)
        tried = at_place[(first[:, None] + np.arange(features)) % features * pow(step, -1, features) % features]
        assert all(sorted(t) == list(range(features)) for t in tried)
        assert all(place[t[0]] == f for t, f in zip(tried, first, strict=True))


@pytest.mark.parametrize("dense", [False, True])
def test_same_result_for_the_same_rows_and_left_out_rows_are_not_drawn(spark, dense):
    df = matrix(spark, 90, 12).coalesce(1)
    if dense:
        rows = [(r["doc_id"], r["label"], Vectors.dense(r["features"].toArray())) for r in df.collect()]
        df = spark.createDataFrame(rows, ["doc_id", "label", "features"]).coalesce(1)
    chosen = [learners.random_forest(12, 3, 4, 2, depth=4) for _ in range(2)]
    out = F.when(F.col("label") == 1, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))
    first, again = (forest.fit_all(df, chosen, out) for _ in range(2))
    assert [m.toDebugString.split("\n", 1)[1] for m in first] == [m.toDebugString.split("\n", 1)[1] for m in again]
    assert first[1].transform(df).filter("prediction = 1").count() == 0
    assert first[0].transform(df).filter("prediction = 1").count() > 0


def test_settings_are_kept_by_the_model(spark, tmp_path):
    df = matrix(spark, 60, 12)
    model = forest.fit(df, learners.random_forest(12, 3, 4, 2, depth=3))
    model.save(str(tmp_path / "model"))
    loaded = type(model).load(str(tmp_path / "model"))
    assert (loaded.getNumTrees, loaded.numFeatures, loaded.numClasses) == (3, 12, 2)
    assert (loaded.getOrDefault("minInstancesPerNode"), loaded.getOrDefault("maxDepth")) == (1, 3)
    said = [r["probability"] for r in model.transform(df).orderBy("doc_id").collect()]
    assert said == [r["probability"] for r in loaded.transform(df).orderBy("doc_id").collect()]


def test_a_node_reads_the_fewer_of_its_rows_and_its_features(spark, monkeypatch):
    """One node with most rows beside many small ones: the sums are those of all entries, few of which are read."""
    rng = np.random.default_rng(2)
    rows, wide, active, mtry = 400, 1000, 60, 30
    entries = sorted({(int(f), int(r)) for f, r in zip(rng.integers(0, wide, 8000), rng.integers(0, rows, 8000))})
    feature, row = (np.array(x) for x in zip(*entries))
    block = {"at": np.append(0, np.cumsum(np.bincount(feature, minlength=wide))), "row": row.astype(np.int32), "bin": rng.integers(1, 9, len(row)).astype(np.int8)}
    block |= {"label": rng.integers(0, 2, rows), "weight": np.ones(rows), "draws": rng.integers(1, 3, (2, rows)).astype(np.uint8)}
    nodes = np.where(rng.random((2, rows)) < 0.6, 0, rng.integers(-1, active, (2, rows))).astype(np.int32)
    batch = forest.pa.RecordBatch.from_pydict({"block": [forest.pickle.dumps(block)], "nodes": [nodes.tobytes()]})
    level = type("Held", (), {"value": {"seed": 3, "depth": 2, "features": wide, "classes": 2, "nodes": [active] * 2, "mtry": [mtry] * 2}})
    read, ranges = [], forest._ranges
    monkeypatch.setattr(forest, "_ranges", lambda start, end: read.append(int((end - start).sum())) or ranges(start, end))
    place = np.random.default_rng(3).permutation(wide)
    (said,) = forest.count([batch], level)
    for tree, counts in zip(said.column(0).to_pylist(), said.column(1).to_pylist(), strict=True):
        keys, stats, _ = forest.pickle.loads(counts)
        step, first = forest.draw(3, tree, 2, active, wide)
        at = nodes[tree][row]
        tried = (at >= 0) & ((place[feature] * step - first[at]) % wide < mtry)
        want = (at[tried].astype(np.int64) * wide + feature[tried]) * (2 * forest.BINS) + block["bin"][tried] + forest.BINS
        assert list(keys) == sorted(set(want)) and len(keys) > 10
        assert stats[:, -1].sum() == block["draws"][tree][row[tried]].sum()
    assert said.num_rows == 2 and sum(read) < len(row)
