"""Quality rules with risk-controlled cutoffs.

Every text gives five ratios. Half of the labelled rows (by a digest of the id) proposes a ladder of
ever tighter cutoffs per stratum: level k rejects what exceeds the (1 - SHARES[k]) quantile of the
good rows in a ratio that tells bad from good there. The other half, the holdout, tests the levels
in order: the exact binomial probability of so few rejected good rows, if the true share were over
`risk`, must be at most `delta` over the number of strata (Bonferroni); within a stratum the fixed
order needs no further correction, and testing ends at the first level that fails. Of the levels
that passed, the one with the best separation on the first half is used. With probability
1 - `delta`, no stratum rejects more than `risk` of its good rows.

Everything is aggregated before it moves: quantiles and counts per stratum, no labelled rows.

Defined results: a null text has no words and fails the base rule; a null stratum is a stratum of
its own; a stratum without enough labels gets no cutoff and only the base rule holds there; a null
label counts as unlabelled; repeated rows get the same verdict; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm import words as W

#: Shares of the good rows that a level may exceed in one ratio, loosest first.
SHARES = (0.0, 0.0005, 0.001, 0.002, 0.005, 0.01)
RISK, DELTA = 0.01, 0.05
SALTS = 32
RATIOS = ("symbols", "dup_lines", "repeats", "capitals", "marks")
BASE_COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
COUNTS = BASE_COUNTS + ", n_lines long, n_upper long, n_marks long"

_SYMBOLS, _UPPER, _MARKS = W.byte_class("#*$%&|<>"), W.byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), W.byte_class("!?")
_NOT_BREAK = ~W.byte_class("\n")
_CODE_POINT = (np.arange(256) & 0xC0) != 0x80


def counts(data: np.ndarray, offsets: np.ndarray, marks: W.Fingerprint) -> list[np.ndarray]:
    """The columns of COUNTS for the texts of one buffer."""
    n = len(offsets) - 1
    wordy = W.NOT_SPACE[data]
    first, last, row = W.spans(wordy, offsets)
    n_words = np.bincount(row, minlength=n)
    hashes = marks.segments(data, first, last)

    line_first, line_last, line_row = W.spans(_NOT_BREAK[data], offsets)
    in_words = np.concatenate(([0], np.cumsum(wordy, dtype=np.int64)))
    full = in_words[line_last] > in_words[line_first]
    line_first, line_last, line_row = line_first[full], line_last[full], line_row[full]
    lines = W.mix(marks.segments(data, line_first, line_last) ^ W.mix(line_row.astype(W.U)))
    _, kept = np.unique(lines, return_index=True)
    n_lines = np.bincount(line_row, minlength=n)
    n_dup = n_lines - np.bincount(line_row[kept], minlength=n)

    at, windows = W.chained(hashes, row, 3)
    again = at[W.repeats(W.mix(windows ^ W.mix(row[at].astype(W.U))))]
    covered = np.zeros(len(row), bool)
    for k in range(3):
        covered[again + k] = True
    n_repeat = np.bincount(row[covered], minlength=n)

    def of(flags):
        return W.per_row(flags, offsets)

    chars = of(_CODE_POINT[data] & wordy)
    return [n_words, chars, of(_SYMBOLS[data]), n_dup, n_repeat, n_lines, of(_UPPER[data]), of(_MARKS[data])]


def measure(docs: DataFrame, text: str) -> DataFrame:
    """The rows of `docs` with the columns of COUNTS of the binary column `text`, which is dropped."""
    keep = [c for c in docs.columns if c != text]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep] + [COUNTS])
    names = keep + [c.split()[0] for c in COUNTS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = W.Fingerprint()
        for batch in batches:
            for i, j, data, offsets in W.slices(batch.column(batch.schema.get_field_index(text))):
                rows = batch.select(keep).slice(i, j - i)
                yield pa.RecordBatch.from_arrays(rows.columns + [pa.array(c, pa.int64()) for c in counts(data, offsets, marks)], names)

    return docs.mapInArrow(W.tidy(run), schema)


def base_failed(min_words: int = 50) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _ratio(above: str, below: str) -> Column:
    return F.col(above) / F.greatest(F.col(below), F.lit(1))


def ratios() -> list[Column]:
    return [
        _ratio("n_symbols", "word_chars").alias("symbols"), _ratio("n_dup_lines", "n_lines").alias("dup_lines"),
        _ratio("n_repeat_words", "n_words").alias("repeats"), _ratio("n_upper", "word_chars").alias("capitals"),
        _ratio("n_marks", "word_chars").alias("marks"),
    ]


def binomial_at_most(k: int, n: int, p: float) -> float:
    """The exact probability of at most k successes in n trials."""
    if k >= n:
        return 1.0
    i = np.arange(1, k + 1, dtype=float)
    logs = n * math.log1p(-p) + np.concatenate(([0.0], np.cumsum(np.log((n - i + 1) / i) + math.log(p / (1 - p)))))
    return float(min(1.0, np.exp(logs.max()) * np.exp(logs - logs.max()).sum()))


def cutoffs(labelled: DataFrame, stratum: str, good: Column, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(stratum, level, risk_bound_p, one cutoff per ratio) for strata with a certified level; a cutoff may be null.

    `labelled` has the counts of `measure`, the stratum and an id column `doc_id`.
    """
    levels = range(len(SHARES))
    side = F.pmod(F.xxhash64(F.lit("holdout"), "doc_id"), F.lit(2)) == 1
    rows = labelled.filter(~base_failed() & good.isNotNull())
    salt = F.pmod(F.xxhash64(F.lit("salt"), "doc_id"), F.lit(SALTS)).cast("int")
    rows = rows.select(F.col(stratum).alias("stratum"), side.alias("holdout"), good.alias("good"), salt.alias("salt"), *ratios())
    fit = rows.filter("NOT holdout")

    ladder = fit.filter("good").groupBy("stratum").agg(
        *[F.percentile_approx(r, [1.0 - s for s in SHARES], 20000).alias(f"c_{r}") for r in RATIOS], F.count("*").alias("n_fit")
    )
    # A stratum may hold most rows: its one row of cutoffs goes to SALTS tasks.
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    same = F.col("l.stratum").eqNullSafe(F.col("r.stratum")) & (F.col("l.salt") == F.col("r.salt"))

    # A ratio serves at a level where it rejects a bad row ten times as often as a good one.
    def over(r, k):
        return F.col(r) > F.col(f"c_{r}")[k]

    sums = [F.sum((over(r, k) & (F.col("good") == g)).cast("long")).alias(f"{r}_{k}_{int(g)}") for r in RATIOS for k in levels for g in (True, False)]
    sizes = [F.sum((F.col("good") == g).cast("long")).alias(f"all_{int(g)}") for g in (True, False)]
    told = rows.filter("NOT holdout").alias("r")
    told = told.join(ladder.select("*", salts).alias("l"), same).groupBy(F.col("l.stratum").alias("stratum")).agg(*sums, *sizes)
    serves = [
        (
            (F.col(f"{r}_{k}_0") / F.greatest("all_0", F.lit(1)) >= 0.01)
            & (F.col(f"{r}_{k}_0") / F.greatest("all_0", F.lit(1)) >= 10 * F.col(f"{r}_{k}_1") / F.greatest("all_1", F.lit(1)))
        ).alias(f"s_{r}_{k}")
        for r in RATIOS
        for k in levels
    ]
    told = told.select("stratum", *serves).alias("t")
    used = ladder.alias("l").join(told, F.col("l.stratum").eqNullSafe(F.col("t.stratum"))).select(
        "l.stratum", *[F.array(*[F.when(F.col(f"s_{r}_{k}"), F.col(f"c_{r}")[k]) for k in levels]).alias(f"c_{r}") for r in RATIOS]
    )

    def rejected(k):
        return F.greatest(*[F.coalesce(over(r, k), F.lit(False)).cast("long") for r in RATIOS])

    tally = rows.alias("r").join(used.select("*", salts).alias("l"), same).groupBy("l.stratum").agg(
        *[F.first(f"c_{r}").alias(f"c_{r}") for r in RATIOS],
        *[
            F.sum(F.when((F.col("holdout") == h) & (F.col("good") == g), rejected(k)).otherwise(0)).alias(f"n_{int(h)}{int(g)}_{k}")
            for k in levels for h in (True, False) for g in (True, False)
        ],
        *[F.sum(((F.col("holdout") == h) & (F.col("good") == g)).cast("long")).alias(f"m_{int(h)}{int(g)}") for h in (True, False) for g in (True, False)],
    )

    def choose(frames):
        import pandas as pd

        for frame in frames:
            found = []
            for _, x in frame.iterrows():
                best, score, p_best = None, 0.0, None
                for k in levels:
                    p = binomial_at_most(int(x[f"n_11_{k}"]), int(x["m_11"]), risk) if x["m_11"] else 1.0
                    if p > delta / x["n_strata"]:
                        break
                    gain = x[f"n_00_{k}"] / max(x["m_00"], 1) - 20 * x[f"n_01_{k}"] / max(x["m_01"], 1)
                    if gain > score:
                        best, score, p_best = k, gain, p
                if best is not None:
                    found.append([x["stratum"], best, p_best, *[x[f"c_{r}"][best] for r in RATIOS]])
            yield pd.DataFrame(found, columns=["stratum", "level", "risk_bound_p", *RATIOS]).astype({r: float for r in RATIOS})

    strata = ladder.agg(F.count("*").alias("n_strata"))
    kind = labelled.schema[stratum].dataType.simpleString()
    counted = tally.withColumn("n_strata", strata.scalar())
    return counted.mapInPandas(choose, f"stratum {kind}, level int, risk_bound_p double, " + ", ".join(f"{r} double" for r in RATIOS))


def verdicts(measured: DataFrame, labels: DataFrame, stratum: str, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """`measured` (doc_id, stratum and counts) with base_failed, level and kept; `labels` has (doc_id, good)."""
    # A label per id: a repeated label row would repeat the document.
    labels = labels.groupBy("doc_id").agg(F.min("good").alias("good"))
    labelled = measured.join(labels.filter("good IS NOT NULL"), "doc_id")
    limits = cutoffs(labelled, stratum, F.col("good"), risk, delta).select(
        F.col("stratum").alias("_stratum"), F.col("level").alias("cutoff_level"), F.struct(*RATIOS).alias("_limits")
    )
    rows = measured.join(limits, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    named = dict(zip(RATIOS, ratios(), strict=True))
    beyond = [F.coalesce(named[r] > F.col(f"_limits.{r}"), F.lit(False)) for r in RATIOS]
    rejected = beyond[0]
    for flag in beyond[1:]:
        rejected = rejected | flag
    rows = rows.withColumns({"base_failed": base_failed(), "kept": ~(base_failed() | rejected)})
    return rows.drop("_stratum", "_limits")
