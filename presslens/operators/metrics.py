"""Confusion counts, the 18 classifier metrics, model history and promotion."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Metric names in published order.
OVERALL = [
    "Accuracy", "Kappa", "AccuracyLower", "AccuracyUpper", "AccuracyNull", "AccuracyPValue",
    "McnemarPValue",
]
BY_CLASS = [
    "Sensitivity", "Specificity", "Pos Pred Value", "Neg Pred Value", "Precision", "Recall", "F1",
    "Prevalence", "Detection Rate", "Detection Prevalence", "Balanced Accuracy",
]
METRICS = OVERALL + BY_CLASS
# Metrics on the model card, and those on the learning curve.
CARD_METRICS = ["Accuracy", "Kappa", "F1", "Precision", "Recall"]
CURVE_METRICS = ["F1", "Kappa"]
# The card's columns.
CARD_COLUMNS = [
    "model_accuracy", "model_kappa", "model_f1", "model_precision", "model_recall", "model",
    "sample_size", "train_prop_covid", "mtry", "n_tree", "min_node_size", "splitrule", "model_type",
    "fitted_on",
]


def confusion(df: DataFrame, label: str, pred: str, positive="0", by: tuple[str, ...] = ()) -> DataFrame:
    """tp, fp, fn, tn in one pass. The class "0" (not about the topic) is the positive one."""
    truth = F.col(label).cast("string") == str(positive)
    said = F.col(pred).cast("string") == str(positive)
    return df.filter(F.col(label).isNotNull() & F.col(pred).isNotNull()).groupBy(*by).agg(
        F.count_if(said & truth).alias("tp"),
        F.count_if(said & ~truth).alias("fp"),
        F.count_if(~said & truth).alias("fn"),
        F.count_if(~said & ~truth).alias("tn"),
    )


def _log_choose(n: int, k: int) -> float:
    return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X >= k). Terms are summed outwards from the largest one and stop when they vanish."""
    if k <= 0:
        return 1.0
    if p <= 0.0 or k > n:
        return 0.0
    if p >= 1.0:
        return 1.0
    mode = min(n, math.floor((n + 1) * p))
    if k < mode:
        return 1.0 - binomial_tail(n - k + 1, n, 1.0 - p)
    odds = p / (1.0 - p)
    term = math.exp(_log_choose(n, k) + k * math.log(p) + (n - k) * math.log1p(-p))
    total = 0.0
    for i in range(k, n + 1):
        total += term
        term *= (n - i) / (i + 1) * odds
        if term < total * 1e-18:
            break
    return total


def _solve(rising, target: float) -> float:
    low, high = 0.0, 1.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if rising(mid) < target else (low, mid)
    return (low + high) / 2


def exact_interval(k: int, n: int, level: float = 0.95) -> tuple[float, float]:
    """Exact binomial confidence interval of k successes in n."""
    tail = (1 - level) / 2
    low = 0.0 if k == 0 else _solve(lambda p: binomial_tail(k, n, p), tail)
    high = 1.0 if k == n else _solve(lambda p: binomial_tail(k + 1, n, p), 1 - tail)
    return low, high


def mcnemar_p(b: int, c: int) -> float:
    """Chi-square with continuity correction, one degree of freedom."""
    if b + c == 0:
        return math.nan
    correction = 1 if b != c else 0
    return math.erfc(math.sqrt((abs(b - c) - correction) ** 2 / (b + c) / 2))


EXACT_TYPE = T.StructType([T.StructField(c, T.DoubleType()) for c in ("lower", "upper", "p_null", "p_mcnemar")])


@F.pandas_udf(EXACT_TYPE)
def _exact(tp: pd.Series, fp: pd.Series, fn: pd.Series, tn: pd.Series) -> pd.DataFrame:
    out = []
    for a, b, c, d in zip(tp.tolist(), fp.tolist(), fn.tolist(), tn.tolist()):
        n, right = a + b + c + d, a + d
        if n == 0:
            out.append((math.nan,) * 4)
            continue
        null = max(a + c, b + d) / n
        out.append((*exact_interval(right, n), binomial_tail(right, n, null), mcnemar_p(b, c)))
    return pd.DataFrame(out, columns=["lower", "upper", "p_null", "p_mcnemar"])


def metrics(counts: DataFrame) -> DataFrame:
    """The 18 metrics as columns, next to whatever columns the confusion counts carry."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    right = tp + tn
    chance = ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n)
    ratio = F.try_divide
    sens, spec, ppv, npv = ratio(tp, tp + fn), ratio(tn, fp + tn), ratio(tp, tp + fp), ratio(tn, fn + tn)
    exact = _exact("tp", "fp", "fn", "tn")
    keep = [c for c in counts.columns if c not in ("tp", "fp", "fn", "tn")]
    values = {
        "Accuracy": ratio(right, n),
        "Kappa": ratio(right / n - chance, 1 - chance),
        "AccuracyLower": F.col("_exact.lower"),
        "AccuracyUpper": F.col("_exact.upper"),
        "AccuracyNull": F.greatest(tp + fn, fp + tn) / n,
        "AccuracyPValue": F.col("_exact.p_null"),
        "McnemarPValue": F.col("_exact.p_mcnemar"),
        "Sensitivity": sens,
        "Specificity": spec,
        "Pos Pred Value": ppv,
        "Neg Pred Value": npv,
        "Precision": ppv,
        "Recall": sens,
        "F1": ratio(2 * tp, 2 * tp + fp + fn),
        "Prevalence": ratio(tp + fn, n),
        "Detection Rate": ratio(tp, n),
        "Detection Prevalence": ratio(tp + fp, n),
        "Balanced Accuracy": (sens + spec) / 2,
    }
    rows = counts.withColumn("_exact", exact)
    return rows.select(*keep, *[values[m].alias(m) for m in METRICS])


def melt(wide: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Metric columns to (metric, value) rows."""
    names = names or [m for m in METRICS if m in wide.columns]
    ids = [c for c in wide.columns if c not in names]
    return wide.unpivot(ids, names, "metric", "value")


def pivot_metrics(long: DataFrame, names: list[str], by: list[str] | None = None) -> DataFrame:
    """(metric, value) rows to one column per name; the list is fixed, so no extra job finds it."""
    picked = [F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in names]
    return long.groupBy(*(by or [])).agg(*picked)


def model_card(long: DataFrame, **facts) -> DataFrame:
    """The one-row card: five metrics under their card names, then the run's facts."""
    wide = pivot_metrics(long.filter(F.col("metric").isin(CARD_METRICS)), CARD_METRICS)
    first = [F.col(m).alias(f"model_{m.lower()}") for m in CARD_METRICS]
    rest = [F.lit(facts[c]).alias(c) if c in facts else F.lit(None).alias(c) for c in CARD_COLUMNS[5:]]
    return wide.select(*first, *rest)


def compare(results: dict[str, DataFrame], date: str, train_n: int, share: float) -> DataFrame:
    """Long metrics of several models, stacked and tagged."""
    stacked = None
    for model, long in results.items():
        rows = long.select("metric", "value", F.lit(model).alias("model"))
        stacked = rows if stacked is None else stacked.unionByName(rows)
    return stacked.withColumns(
        {"date": F.lit(date), "train_n": F.lit(train_n), "class_share": F.lit(share)}
    )


def learning_curve(history: DataFrame) -> DataFrame:
    """F1 and Kappa by model and training size."""
    rows = history.filter(F.col("metric").isin(CURVE_METRICS))
    return pivot_metrics(rows, CURVE_METRICS, ["model", "train_n"])


def hamming_loss(df: DataFrame, label: str, pred: str) -> DataFrame:
    """1 - accuracy for one label per row."""
    return df.agg(F.avg(F.when(F.col(label) == F.col(pred), 0.0).otherwise(1.0)).alias("hamming_loss"))


def promote(
    new: DataFrame, history: DataFrame, score: str = "model_f1", order: str = "last_changed", baseline="latest"
) -> DataFrame:
    """The decision row: strictly better than the newest (or the best) earlier record."""
    if baseline == "best":
        before = history.agg(F.max(score).alias("old")).scalar()
    else:
        before = history.agg(F.max_by(score, order).alias("old")).scalar()
    row = new.withColumn("previous", before)
    better = F.coalesce(F.col(score) > F.col("previous"), F.col("previous").isNull())
    return row.withColumn("promoted", better)
