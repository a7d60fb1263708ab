"""Gaussian naive Bayes as aggregates over the long form: moments, class baselines, and corrections.

The score of a class is the logarithm of its share plus, over all terms, the logarithm of the normal
density of the document's weight. A document lacks most terms, so each class has a baseline, its score
of a document without any term; a term that is there adds the difference to its density at zero, which
is w (2 m - w) / (2 v). No row has the width of the vocabulary, in training or in scoring.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.operators.joins import lookup_join
from presslens.session import materialise

#: What is added to every variance, as a share of the greatest.
SMOOTHING = 1e-9


def class_moments(weights: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, dict]:
    """(term, one struct of mean and variance per class), and the training documents of each class.

    Absent weights count as zeros, also of terms that a class never has; terms that no training
    document has are left out.
    """
    sizes = {r["label"]: r["docs"] for r in labels.groupBy("label").agg(F.count("*").alias("docs")).collect()}
    own = weights.join(labels, id_col)

    def moments(label, docs):
        w = F.when(F.col("label") == label, F.col("weight")).otherwise(0.0)
        mean = F.sum(w) / docs
        return F.struct(mean.alias("mean"), F.greatest(F.sum(w * w) / docs - mean * mean, F.lit(0.0)).alias("variance"))

    columns = [moments(label, docs).alias(f"c{k}") for k, (label, docs) in enumerate(sorted(sizes.items()))]
    return materialise(own.groupBy("term").agg(*columns), "moments"), dict(sorted(sizes.items()))


def gaussian_predictions(weights: DataFrame, labels: DataFrame, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """`docs` with `predicted`; `weights` (id, term, weight) holds training documents and others, `labels` the training ones."""
    table, sizes = class_moments(weights, labels, id_col)
    numbers = range(len(sizes))
    most = table.agg(F.max(F.greatest(*[F.col(f"c{k}.variance") for k in numbers], F.lit(0.0)))).first()[0] or 0.0
    extra, total = SMOOTHING * most or SMOOTHING, sum(sizes.values())

    def variance(k):
        return F.col(f"c{k}.variance") + extra

    mean = [F.col(f"c{k}.mean") for k in numbers]
    absent = [F.sum(-0.5 * F.log(2 * math.pi * variance(k)) - mean[k] * mean[k] / (2 * variance(k))).alias(f"b{k}") for k in numbers]
    base = table.agg(*absent).first()
    found = lookup_join(weights.join(docs.select(id_col), id_col, "left_semi"), table, "term", id_col)
    w = F.col("weight")
    more = [F.sum(w * (2 * mean[k] - w) / (2 * variance(k))).alias(f"s{k}") for k in numbers]
    scored = docs.join(found.groupBy(id_col).agg(*more), id_col, "left")
    scores = [
        F.struct((F.coalesce(f"s{k}", F.lit(0.0)) + (base[f"b{k}"] or 0.0) + math.log(docs_of / total)).alias("score"), F.lit(-k).alias("first"), F.lit(str(label)).alias("label"))
        for k, (label, docs_of) in enumerate(sizes.items())
    ]
    # Of equal scores the first class.
    return scored.select(*docs.columns, F.array_max(F.array(*scores))["label"].alias("predicted"))
