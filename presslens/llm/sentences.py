"""Substring dedup by sliding sentence spans.

A text is cut into sentences: a sentence ends after a word that ends with a stop (`.`, `!`, `?` or
the full stops of other scripts; up to three more signs, such as quotes and brackets, may follow) and
at a line break. Where scripts have no spaces, every character is a word, which counts as half a
word of others (Chinese, Japanese) or a quarter (Thai, Lao, Khmer, Burmese). Sentences are cut further
into pieces after the least of every `WINDOW` words in a row, by the hash of a word and the one before
(winnowing); words that end with a stop are the least of all, so that only long sentences are cut.
Cuts depend on the words around them only and are at most `WINDOW` words apart: of any
2 * `WINDOW` + `MAX_WORDS` spaced words without stops or line breaks that two texts share, a run of `MAX_WORDS` or more is the same in both.

From every piece a run grows until it has `run` sentence ends and `min_words` words, or `MAX_WORDS`
words whatever their stops; one more run reaches back from the end of the text. A run is hashed by its
words, so that spacing does not matter. Runs are joined over the whole corpus; of those with one hash
the first by (id, key of the row, place) stays, and every piece that lies in any other is removed
together with the space after it.

Defined results: a null text stays null and an empty one empty; texts too short for a run are left
alone; rows repeated in id and text count as one text and keep the same sentences; null ids come
before all others; an empty table gives an empty result; whole rows travel in one column, so extra
columns and clashing names pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm import words as W
from presslens.llm.lines import filled, may_hold, same_row
from presslens.llm.store import Scratch, row_key

RUN, MIN_WORDS, MAX_WORDS = 2, 10, 20
WINDOW = 15
#: A name that no column of a table has.
TO_CUT = "_presslens_to_cut"
#: Bits of a place that hold the number of pieces.
SHIFT = 32
_ENDS = W.byte_class(".!?")
_SIGNS = ~W.ALNUM & ~W.byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_BREAKS = W.byte_class("\n")
#: Stops and closing signs beyond ASCII, by their number of UTF-8 bytes.
_STOPS = {2: "؟۔։", 3: "。！？．｡।॥…።។៕။།"}
_CLOSERS = {2: "»", 3: "」』）】》〉〕］｝”’›、，"}
#: A word weighs 4, a character of a script without spaces 2 or 1.
WORD, HALF, QUARTER = 4, 2, 1


def _codes(signs: str) -> np.ndarray:
    return np.array([int.from_bytes(c.encode(), "big") for c in signs])


def _beyond_ascii(data: np.ndarray, ends: np.ndarray, closing: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(positions where a word begins, characters that are words, their weights); marks the last bytes of stops and closing signs."""
    glued, after = [], []
    for size, lead in ((2, (0xC2, 0xDF)), (3, (0xE0, 0xEF))):
        at = np.flatnonzero((data >= lead[0]) & (data <= lead[1]))
        code = np.zeros(len(at), np.int64)
        for k in range(size):
            code = code << 8 | data[at + k]
        stop, closer = np.isin(code, _codes(_STOPS[size])), np.isin(code, _codes(_CLOSERS[size]))
        ends[at[stop] + size - 1] = True
        closing[at[closer] + size - 1] = size
        if size == 3:
            glued.append(at[stop | closer])
            after.append(at[(stop | closer) & np.isin(code >> 16, (0xE3, 0xEF))] + 3)
    pair, free = code >> 8, ~(stop | closer)
    half = (code >= 0xE38080) & (code <= 0xE9BFBF) | (pair >= 0xEFA4) & (pair <= 0xEFAB)
    quarter = (pair >= 0xE0B8) & (pair <= 0xE0BB) | (pair >= 0xE180) & (pair <= 0xE182) | (pair == 0xE19E) | (pair == 0xE19F)
    far = np.flatnonzero(data >= 0xF0)
    far = far[(data[far] == 0xF0) & (data[far + 1] >= 0xA0)]
    wide = np.concatenate((at[half & free], far, at[quarter & free]))
    weight = np.repeat((HALF, QUARTER), (len(wide) - int((quarter & free).sum()), int((quarter & free).sum())))
    after += [at[(half | quarter) & free] + 3, far + 4]
    begin = np.setdiff1d(np.concatenate((wide, *after)), np.concatenate(glued))
    return begin, wide, weight


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, last, row, weight, whether it ends with a stop) of each word."""
    first, last, row = W.spans(W.NOT_SPACE[data], offsets)
    ends, closing = _ENDS[data], _SIGNS[data].astype(np.int64)
    weight = np.full(len(first), WORD)
    if len(data) and data.max() >= 0x80:
        begin, wide, heavy = _beyond_ascii(data, ends, closing)
        begin = begin[begin < len(data)]
        begin = begin[W.NOT_SPACE[data[begin]]]
        starts = np.union1d(first, begin)
        if len(starts) > len(first):
            held = np.searchsorted(first, starts, "right") - 1
            last, row = np.minimum(np.append(starts[1:], len(data)), last[held]), row[held]
        first, weight = starts, np.full(len(starts), WORD)
        weight[np.searchsorted(first, wide)] = heavy
    stops, open_signs, at = np.zeros(len(first), bool), np.ones(len(first), bool), last - 1
    for _ in range(4):
        open_signs &= at >= first
        spot = np.maximum(at, 0)
        stops |= open_signs & ends[spot]
        open_signs &= closing[spot] > 0
        at = at - closing[spot]
    return first, last, row, weight, stops


def slid(values: np.ndarray, of: np.ufunc) -> np.ndarray:
    """`of` over every WINDOW values in a row."""
    size = 1
    while size < WINDOW:
        step = min(size, WINDOW - size)
        values, size = of(values[:-step], values[step:]), size + step
    return values


def least(values: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Whether a value above 0 is the least of any WINDOW values in a row that lie in one text."""
    n = len(values) - WINDOW + 1
    if n <= 0:
        return np.zeros(len(values), bool)
    low = np.where(row[WINDOW - 1 :] == row[:n], slid(values, np.minimum), W.U(0))
    rest = np.zeros(WINDOW - 1, W.U)
    return slid(np.concatenate((rest, low, rest)), np.maximum) == values


def sentences(data: np.ndarray, offsets: np.ndarray, marks: W.Fingerprint) -> tuple[np.ndarray, ...]:
    """(first word, word after the last, row) of each piece, and (first byte, hash, weight, whether a sentence ends) of each word."""
    first, last, row, weight, stops = split(data, offsets)
    hashes = marks.segments(data, first, last)
    if not len(first):
        none = np.zeros(0, np.int64)
        return none, none, none, first, hashes, weight, stops
    breaks = np.concatenate(([0], np.cumsum(_BREAKS[data], dtype=np.int64)))
    new = row[1:] != row[:-1]
    before = np.concatenate((np.zeros(1, W.U), np.where(new, W.U(0), hashes[:-1])))
    ends = least(np.where(stops, W.U(1), W.mix(before * W.U(3) + hashes) | W.U(2)), row)
    stops[-1] = True
    stops[:-1] |= new | (breaks[first[1:]] > breaks[last[:-1]])
    ends |= stops
    after = np.flatnonzero(ends) + 1
    begin = np.concatenate(([0], after[:-1]))
    return begin, after, row[begin], first, hashes, weight, stops


def grown(begin: np.ndarray, after: np.ndarray, row: np.ndarray, weight: np.ndarray, stops: np.ndarray, run: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(first piece, piece after the last) of every run, in ascending order of the first."""
    load = np.concatenate(([0], np.cumsum(weight)))
    done = np.concatenate(([0], np.cumsum(stops)))
    most = max(min_words, MAX_WORDS)

    def enough(lo, hi):
        words, sentence_ends = load[after[hi]] - load[begin[lo]], done[after[hi]] - done[begin[lo]]
        return (row[lo] == row[hi]) & ((words >= WORD * min_words) & (sentence_ends >= run) | (words >= WORD * most))

    # Both counts only grow along a text, so the last piece of a run is the least that suffices.
    load_of, done_of = load[after], done[after]
    lo = np.arange(len(begin))
    both = np.maximum(np.searchsorted(load_of, load[begin] + WORD * min_words), np.searchsorted(done_of, done[begin] + run))
    hi = np.minimum(both, np.searchsorted(load_of, load[begin] + WORD * most))
    fits = hi < len(begin)
    lo, hi = lo[fits], hi[fits]
    fits = enough(lo, hi)
    lo, hi = lo[fits], hi[fits]
    # The run that reaches back from the last piece of each text: the latest first piece that suffices.
    end = np.flatnonzero(np.append(row[1:] != row[:-1], True)) if len(row) else np.zeros(0, np.int64)
    both = np.minimum(
        np.searchsorted(load[begin], load_of[end] - WORD * min_words, "right"), np.searchsorted(done[begin], done_of[end] - run, "right")
    )
    back = np.maximum(both, np.searchsorted(load[begin], load_of[end] - WORD * most, "right")) - 1
    end, back = end[back >= 0], back[back >= 0]
    fits = enough(back, end)
    pairs = np.unique(np.stack((np.append(lo, back[fits]), np.append(hi, end[fits])), axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1] + 1


def runs_of(data: np.ndarray, offsets: np.ndarray, marks: W.Fingerprint, run: int, min_words: int) -> tuple[np.ndarray, ...]:
    """(row, number of the first piece in its row and number of pieces as one value, two hashes) of every run."""
    begin, after, row, _, hashes, weight, stops = sentences(data, offsets, marks)
    at, to = grown(begin, after, row, weight, stops, run, min_words)
    place = (at - np.searchsorted(row, row[at])) << SHIFT | (to - at)
    out = []
    for salt in (1, 2):
        # Word hashes chained by powers, so that any stretch of words comes from two prefix sums.
        with np.errstate(over="ignore"):
            up = np.multiply.accumulate(np.concatenate((np.ones(1, W.U), np.full(len(hashes), W.BASE + 2 * salt, W.U))))
            down = np.multiply.accumulate(np.concatenate((np.ones(1, W.U), np.full(len(hashes), pow(W.BASE + 2 * salt, -1, 2**64), W.U))))
        sums = np.concatenate((np.zeros(1, W.U), np.cumsum(W.mix(hashes + W.U(salt)) * up[:-1], dtype=W.U)))
        lo, hi = begin[at], after[to - 1]
        out.append(W.mix((sums[hi] - sums[lo]) * down[lo] + (hi - lo).astype(W.U)).view(np.int64))
    return row[at], place, *out


def runs(rows: DataFrame, run: int, min_words: int) -> DataFrame:
    """(h1, h2, doc_id, key, place) of every run; `rows` has key, doc_id and text as bytes."""
    names = ["h1", "h2", "doc_id", "key", "place"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = W.Fingerprint()
        for batch in batches:
            ids, keys = batch.column("doc_id"), batch.column("key")
            for i, _, data, offsets in W.slices(batch.column("text")):
                row, place, h1, h2 = runs_of(data, offsets, marks, run, min_words)
                at = pa.array(row + i)
                yield pa.RecordBatch.from_arrays([pa.array(h1), pa.array(h2), ids.take(at), keys.take(at), pa.array(place, pa.int64())], names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(W.tidy(scan), f"h1 long, h2 long, doc_id {kind}, key long, place long")


def without(rows: DataFrame) -> DataFrame:
    """(rest, text) with the pieces of the runs in `places` removed."""
    kind = rows.schema["rest"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = W.Fingerprint()
        for batch in batches:
            places, out = batch.column("places"), []
            for i, j, data, offsets in W.slices(batch.column("text")):
                begin, _, row, first, _, _, _ = sentences(data, offsets, marks)
                change = np.zeros(len(begin) + 1, np.int64)
                starts = np.searchsorted(row, np.arange(j - i))
                for r in range(j - i):
                    if places[i + r].is_valid:
                        found = np.array(places[i + r].as_py(), np.int64)
                        at = starts[r] + (found >> SHIFT)
                        np.add.at(change, at, 1)
                        np.subtract.at(change, at + (found & (1 << SHIFT) - 1), 1)
                drop = np.cumsum(change[:-1]) > 0
                for r in range(j - i):
                    lo, hi = starts[r], starts[r + 1] if r + 1 < j - i else len(begin)
                    gone = np.flatnonzero(drop[lo:hi]) + lo
                    piece = data[offsets[r] : offsets[r + 1]]
                    if len(gone):
                        edges = np.append(first[begin[lo:hi]], offsets[r + 1]) - offsets[r]
                        keep = np.ones(len(piece), bool)
                        change = np.zeros(len(piece) + 1, np.int8)
                        change[edges[gone - lo]] += 1
                        np.subtract.at(change, edges[gone - lo + 1], 1)
                        keep = np.cumsum(change[:-1]) == 0
                        piece = piece[keep]
                    out.append(piece.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("rest"), pa.array(out, pa.binary())], ["rest", "text"])

    return rows.select("rest", "text", "places").mapInArrow(W.tidy(cut), f"rest {kind}, text binary")


def drop_repeated_spans(
    docs: DataFrame, run: int = RUN, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with its text column cut; every row stays.

    Only rows that may have a place to cut are joined and go through Python, without a second copy of
    their text; a filter of the keys of such rows tells most others.
    """
    scratch = Scratch(docs.sparkSession, "sentences")
    # Rows are told apart by id and key, so that a key of 64 bits need only do so among rows of one id.
    key = row_key(id_col, text_col).alias("key")
    doc = F.col(id_col).alias("doc_id")
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    found = scratch.put(runs(docs.select(key, doc, body), run, min_words), "runs")
    spot = F.struct("doc_id", "key", "place")
    first = found.groupBy("h1", "h2").agg(F.min(spot).alias("first"), F.max(spot).alias("last")).filter("first < last")
    # Written, so that the shuffle before it is gone and a frequent hash can be dealt to several tasks of the join.
    first = scratch.put(first.select("h1", "h2", "first"), "first")
    again = found.withColumn("spot", spot).join(first, ["h1", "h2"]).filter("spot <> first")
    places = again.groupBy("doc_id", "key").agg(F.collect_set("place").alias("places"))
    places = scratch.put(places, "places")
    scratch.drop("runs", "first")
    bitmap = docs.sparkSession.sparkContext.broadcast(filled(places.select(F.col("key").alias("hash")), 1).tobytes())
    rows = docs.withColumn(TO_CUT, may_hold(key, bitmap))
    rest = F.struct(F.col(text_col).isNull().alias("none"), F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"))
    cut = rows.filter(TO_CUT).select(rest.alias("rest"), key, doc, body).alias("r").join(places.alias("p"), same_row("r", "p"), "left")
    text = F.when(~F.col("rest.none"), F.decode("text", "UTF-8"))
    cut = without(cut).select(*[text.alias(c) if c == text_col else F.col(f"rest.row.`{c}`").alias(c) for c in docs.columns])
    return rows.filter(f"NOT {TO_CUT}").select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(cut)
