"""Severity of toxicity by cumulative-link ordinal regression on sparse text features.

Grades are ordered 0 to K-1. One weight vector serves all thresholds: P(grade > k) is the logistic
of w.x - t_k with t_0 < t_1 < ... Features are the distinct lower-cased words of the whole text and
their first bytes, hashed to 2^18 places; a feature counts as much as it tells graded from harmless
texts among the fit rows (its log ratio). The weights are fitted by gradient steps on about
`fit_rows` labelled rows at most, chosen by a digest of their id, in one task; the model (one value
per place, and the thresholds) has a fixed size and is broadcast.

The score is the expected severity: the sum of P(grade > k) over the thresholds.

Defined results: a null or empty text has no features and gets the base rate; null grades are not
learned from; repeated rows get the same score; without labels every score is 0; an empty table
gives an empty result; only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm import words as W
from presslens.llm.store import Scratch, texts

PLACES = 1 << 18
PREFIXES = (4, 5)
FIT_ROWS, STEPS, RIDGE = 12_000, 150, 3.0
#: A feature needs this many fit rows.
SUPPORT = 5


def features(data: np.ndarray, offsets: np.ndarray, marks: W.Fingerprint) -> tuple[np.ndarray, np.ndarray]:
    """(row, place) of the distinct words of each text and of their first PREFIX bytes."""
    data = W.LOWER[data]
    first, last, row = W.spans(W.ALNUM[data], offsets)
    whole, begun = marks.segments(data, first, last), []
    for size in PREFIXES:
        long = last - first > size
        begun.append((row[long], W.mix(marks.segments(data, first[long], first[long] + size) + W.U(size))))
    row = np.concatenate([row, *[r for r, _ in begun]])
    place = np.concatenate([whole, *[p for _, p in begun]])
    both = np.unique(row * PLACES + (place % W.U(PLACES)).astype(np.int64))
    return both // PLACES, both % PLACES


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(row: np.ndarray, place: np.ndarray, grade: np.ndarray, steps: int, ridge: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(scales, weights, thresholds) of the cumulative-link model."""
    n, k = len(grade), int(grade.max()) if len(grade) else 0
    graded = grade > 0
    with_it = np.bincount(place[graded[row]], minlength=PLACES)
    without = np.bincount(place[~graded[row]], minlength=PLACES)
    ratio = np.log((with_it + 1) / (graded.sum() + 2)) - np.log((without + 1) / ((~graded).sum() + 2))
    scales = np.where(with_it + without >= SUPPORT, ratio, 0).astype(np.float32)
    told = scales[place] != 0
    row, place = row[told], place[told]
    value = scales[place].astype(float)
    above = grade[:, None] > np.arange(k)[None, :]
    rate = np.clip(above.mean(axis=0), 1 / (n + 1), 1 - 1 / (n + 1))
    # Thresholds stay in order: the first is free, the others add positive gaps.
    start = -np.log(rate / (1 - rate))
    free = np.concatenate((start[:1], np.log(np.maximum(np.diff(start), 0.05))))
    w = np.zeros(PLACES)
    m, v, mt, vt = np.zeros(PLACES), np.zeros(PLACES), np.zeros(k), np.zeros(k)
    # Rare grades weigh as much as the common one.
    share = np.bincount(grade, minlength=k + 1) / n
    weigh = (1 / np.maximum(share, 1e-9) / max((share > 0).sum(), 1))[grade] ** 0.5
    for step in range(1, steps + 1):
        cuts = np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))
        slope = (sigmoid(np.bincount(row, value * w[place], n)[:, None] - cuts) - above) * weigh[:, None] / n
        gw = np.bincount(place, value * slope.sum(axis=1)[row], PLACES) + ridge * w / n
        gc = -slope.sum(axis=0)
        gf = np.concatenate((gc[:1] + gc[1:].sum(), np.exp(free[1:]) * np.cumsum(gc[:0:-1])[::-1]))
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mt, vt = 0.9 * mt + 0.1 * gf, 0.999 * vt + 0.001 * gf * gf
        b1, b2 = 1 - 0.9**step, 1 - 0.999**step
        w -= 0.02 * (m / b1) / (np.sqrt(v / b2) + 1e-8)
        free -= 0.05 * (mt / b1) / (np.sqrt(vt / b2) + 1e-8)
    return scales, w.astype(np.float32), np.cumsum(np.concatenate((free[:1], np.exp(free[1:]))))


def learned(training: DataFrame, grades: DataFrame, fit_rows: int, steps: int, ridge: float) -> tuple | None:
    """The model of a bounded sample of (doc_id, grade) and its texts, fitted in one task."""
    n = grades.count()
    if not n:
        return None
    # Grades are drawn first, so that only the drawn rows' texts move.
    draw = F.pmod(F.xxhash64(F.lit("severity"), "doc_id"), F.lit(1 << 30))
    sample = grades.filter(draw < int((1 << 30) * min(1.0, fit_rows / n)))
    labelled = training.join(Scratch(training.sparkSession, "toxicity").put(sample, "sample"), "doc_id")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = W.Fingerprint()
        for batch in batches:
            for i, j, data, offsets in W.slices(batch.column("text")):
                row, place = features(data, offsets, marks)
                cuts = np.searchsorted(row, np.arange(j - i + 1))
                packed = [place[a:b].astype(np.int32).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("grade"), pa.array(packed, pa.binary())], ["doc_id", "grade", "places"])

    kind = labelled.schema["doc_id"].dataType.simpleString()
    rows = labelled.select("doc_id", "text", "grade").mapInArrow(W.tidy(hashed), f"doc_id {kind}, grade int, places binary")

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("places", "ascending")])
        places = [np.frombuffer(p.as_buffer(), np.int32) for chunk in table["places"].chunks for p in chunk]
        row = np.repeat(np.arange(len(places)), [len(p) for p in places])
        model = fit(row, np.concatenate(places).astype(np.int64), table["grade"].to_numpy().astype(np.int64), steps, ridge)
        return pa.table({name: pa.array([x.tobytes()], pa.binary()) for name, x in zip(("scales", "weights", "cuts"), model, strict=True)})

    keyed = rows.withColumn("one", F.lit(1)).groupBy("one")
    found = keyed.applyInArrow(lambda t: one(t.drop_columns(["one"])), "scales binary, weights binary, cuts binary").first()
    if found is None:
        return None
    return np.frombuffer(found.scales, np.float32), np.frombuffer(found.weights, np.float32), np.frombuffer(found.cuts, np.float64)


def severity(
    docs: DataFrame, grades: DataFrame, training: DataFrame | None = None, fit_rows: int = FIT_ROWS, steps: int = STEPS,
    ridge: float = RIDGE, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(doc_id, grade, severity, toxic): the likeliest grade, the expected severity, and whether P(grade > 0) is over one half.

    `grades` has (doc_id, grade) with grades from 0, of rows of `training`, by default of `docs`; an id
    with several grades has the highest.
    """
    graded = grades.filter("grade IS NOT NULL").groupBy("doc_id").agg(F.max("grade").cast("int").alias("grade"))
    known = texts(docs if training is None else training, id_col, text_col)
    model = docs.sparkSession.sparkContext.broadcast(learned(known, graded, fit_rows, steps, ridge))
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = W.Fingerprint()
        for batch in batches:
            for i, j, data, offsets in W.slices(batch.column("text")):
                n = j - i
                over = np.zeros((n, 1))
                if model.value is not None and len(model.value[2]):
                    scales, w, cuts = model.value
                    row, place = features(data, offsets, marks)
                    over = sigmoid(np.bincount(row, scales[place] * w[place], n)[:, None] - cuts)
                shares = np.hstack((np.ones((n, 1)), over)) - np.hstack((over, np.zeros((n, 1))))
                columns = [shares.argmax(axis=1).astype(np.int32), over.sum(axis=1), over[:, 0] > 0.5]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, n), *map(pa.array, columns)], ["doc_id", "grade", "severity", "toxic"])

    return rows.mapInArrow(W.tidy(run), f"doc_id {kind}, grade int, severity double, toxic boolean")
