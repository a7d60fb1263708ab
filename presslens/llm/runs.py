"""Detection of periodic runs of words: an online sparse dynamic programme over diagonals.

A run is a stretch of words with smallest period q (words q apart are identical) that no neighbouring
word extends, of at least `least` words and at least three periods. Word i and its earlier occurrence
j lie on the diagonal of lag i - j; a run of period q is a stretch of matches on the diagonal of lag q.
Going through the words of a text, an earlier occurrence makes its lag active, the match length of an
active lag grows with every further match, and a diagonal that ends with enough matches emits its run
at once. What ends on the same words at several lags is one run, of the smallest lag.

A frequent word has too many earlier occurrences to look at all of them. The occurrences that can
start a run are found by context, in levels: for lags of half the context up to the context (16, 32,
64, ... words), only the nearest earlier place with the same context counts. None is lost. A run of
period q has 2 q matches or more, so it holds places whose context of K words (K/2 <= q < K) stands
again q words before. Were there a nearer place at each of them, each context would have a period of
at most K/2, all the same one (contexts of neighbouring places share K - 1 words), hence so would 2 q
words of the run, and q would not be its smallest period. So the work is n log n for any text, and
contexts are compared only where the half of them is repeated already.

Defined results: a null or empty text has no words and no runs; words are compared by fingerprint;
repeated rows get the same result; an empty table gives an empty result; null ids stay; only id and
text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm import words as W
from presslens.llm.store import texts

LEAST, PERIODS = 24, 3
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def occurrences(values: np.ndarray, row: np.ndarray, least: int, periods: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(place, lag, context) of the nearest earlier place with the same context, for the lags of each context.

    `values` are the fingerprints of words, `row` the texts they stand in.
    """
    # Lags below `first` share the first context: a run of `least` words has a place for each of them.
    first = 1 << max(1, (2 * least // periods).bit_length() - 1)
    context, grams = 1, W.mix(values ^ W.mix(row.astype(W.U)))
    at = np.arange(len(values))
    while context < first:
        n = len(grams) - context
        if n <= 0:
            return
        grams, at = W.mix(grams[:n] * W.U(3) + grams[context:]), at[:n]
        context *= 2
    inside = row[at] == row[at + context - 1]
    grams, at = grams[inside], at[inside]
    low = 1
    while len(at):
        again = W.repeats(grams)
        grams, at = grams[again], at[again]
        order = np.lexsort((at, grams))
        place, gram = at[order], grams[order]
        lag = place[1:] - place[:-1]
        near = (gram[1:] == gram[:-1]) & (lag >= low) & (lag < context)
        if near.any():
            yield place[1:][near], lag[near], context
        # The context twice as long: both halves are repeated and lie in one text.
        half = np.searchsorted(at, at + context)
        found = half < len(at)
        found[found] = (at[half[found]] == at[found] + context) & (row[at[half[found]]] == row[at[found]])
        grams, at = W.mix(grams[found] * W.U(3) + grams[half[found]]), at[found]
        context, low = context * 2, context


def matches(one: np.ndarray, other: np.ndarray, backwards: bool = False) -> int:
    """How many values agree from the beginning (or from the end, going backwards), block by block."""
    n, done, block = min(len(one), len(other)), 0, 64
    if backwards:
        one, other = one[len(one) - n :][::-1], other[len(other) - n :][::-1]
    while done < n:
        differ = one[done : done + block] != other[done : done + block]
        if differ.any():
            return done + int(differ.argmax())
        done, block = done + len(differ), block * 2
    return n


def diagonals(values: np.ndarray, places: np.ndarray, lags: np.ndarray, contexts: np.ndarray, least: int, periods: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of one text; places, in ascending order, make their lags active."""
    active: dict[int, int] = {}
    runs: dict[tuple[int, int], int] = {}
    for place, lag, context in zip(places.tolist(), lags.tolist(), contexts.tolist(), strict=True):
        if active.get(lag, -1) >= place + context:
            continue  # this diagonal still goes on
        end = place + context
        end += matches(values[end:], values[end - lag : len(values) - lag])
        begin = place - matches(values[lag:place], values[: place - lag], backwards=True)
        active[lag] = end
        length = end - begin + lag
        if length >= max(least, periods * lag):
            key = (begin - lag, end)
            runs[key] = min(lag, runs.get(key, lag))
    return sorted((start, end - start, period) for (start, end), period in runs.items())


def of_buffer(data: np.ndarray, offsets: np.ndarray, marks: W.Fingerprint, least: int, periods: int) -> tuple[list, list[bytes]]:
    """(runs, the words that no run repeats, joined by one space) of each text of a buffer."""
    first, last, row = W.spans(W.NOT_SPACE[data], offsets)
    values, n = marks.segments(data, first, last), len(offsets) - 1
    found = list(occurrences(values, row, least, periods)) if len(values) else []
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(n)]
    change = np.zeros(len(first) + 1, np.int64)
    edges = np.searchsorted(row, np.arange(n + 1))
    if found:
        place, lag = (np.concatenate([f[k] for f in found]) for k in (0, 1))
        context = np.concatenate([np.full(len(f[0]), f[2]) for f in found])
        order = np.lexsort((lag, place))
        place, lag, context = place[order], lag[order], context[order]
        cuts = np.flatnonzero(np.diff(row[place])) + 1
        for part in np.split(np.arange(len(place)), cuts):
            r = int(row[place[part[0]]])
            lo, hi = edges[r], edges[r + 1]
            runs[r] = diagonals(values[lo:hi], place[part] - lo, lag[part], context[part], least, periods)
            for start, length, period in runs[r]:
                change[lo + start + period] += 1
                change[lo + start + length] -= 1
    kept = np.cumsum(change[:-1]) == 0
    first, last, row = first[kept], last[kept], row[kept]
    # Every kept word takes the byte behind it along, which becomes a space, but for the last of a text.
    more = np.append(row[1:] == row[:-1], False) if len(row) else np.zeros(0, bool)
    out = data.copy()
    out[last[more]] = ord(" ")
    flags = np.zeros(len(data) + 1, np.int8)
    flags[first] += 1
    np.subtract.at(flags, last + more, 1)
    keep = np.cumsum(flags[:-1], dtype=np.int8).astype(bool)
    out, sizes = out[keep].tobytes(), np.concatenate(([0], np.cumsum(W.per_row(keep, offsets))))
    return runs, [out[sizes[i] : sizes[i + 1]] for i in range(n)]


def periodic_runs(docs: DataFrame, least: int = LEAST, periods: int = PERIODS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, runs, collapsed): the runs of each text by start and period, and the text without their repetitions.

    Of each run only the first period stays; the words that stay are joined by one space. `periods` is 3 or more.
    """
    if periods < 3 or least < 1:
        raise ValueError("runs have at least three periods and one word")
    rows = texts(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = W.Fingerprint()
        for batch in batches:
            for i, j, data, offsets in W.slices(batch.column("text")):
                runs, left = of_buffer(data, offsets, marks, least, periods)
                counts = np.concatenate(([0], np.cumsum([len(r) for r in runs])))
                flat = np.array([x for r in runs for x in r], np.int64).reshape(-1, 3)
                values = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(_RUN))
                lists = pa.ListArray.from_arrays(pa.array(counts, pa.int32()), values)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(i, j - i), lists, pa.array(left, pa.binary())], ["doc_id", "runs", "collapsed"])

    found = rows.mapInArrow(W.tidy(run), f"doc_id {kind}, runs {RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.decode("collapsed", "UTF-8"))


def strongest(runs: str = "runs") -> Column:
    """The run with the most periods, exactly; ties go to the smallest start, then the smallest period."""

    def better(best: Column, one: Column) -> Column:
        more = one["length"] * best["period"] > best["length"] * one["period"]
        return F.when(best.isNull() | more, one).otherwise(best)

    return F.reduce(runs, F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>"), better)


def listing(runs: str = "runs") -> Column:
    """One line `start,length,period` per run."""

    def line(run: Column) -> Column:
        return F.concat(F.concat_ws(",", *[run[f].cast("string") for f in ("start", "length", "period")]), F.lit("\n"))

    return F.array_join(F.transform(runs, line), "")
