"""Line dedup with two Bloom filters of line hashes: seen once, and seen twice.

A first pass over the texts writes the hashes of the lines that are long enough, each once per row.
From these, a fixed number of tasks fill a pair of filters: a hash whose bits are all in the first
one already puts them into the second. Pairs are merged bit by bit (the first by OR, the second by OR,
together with the bits that two first ones share), so a hash in two tasks is in the merged second
filter: a repeated line always passes. A second pass over the texts lets only lines through whose
hash is in the second filter. These suspects alone are shuffled: their SHA-256 digests are counted
exactly by distinct documents, and the occurrence that stays is chosen. Counts are combined on the
map side, and the dealing is by digest and document, so that a line that every document has does not
meet in one task. The numbers of the lines to drop go back to the texts; only rows that a filter of the
rows with such lines lets through travel with their texts.

Filters have about `BITS_PER_LINE` bits for every hash, `MAX_BITS` at most: that bounds what a task
and the driver hold (64 MB a filter). With more hashes than that more lines are suspects and shuffled;
what is dropped stays the same.

Defined results: a null text stays null and counts as one empty line, an empty one stays empty; rows
that share an id are one document when documents are counted, and rows without an id are one document,
before all others; rows repeated in id and text lose the same lines; an empty table gives an empty
result; only id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.llm import words as W
from presslens.llm.store import Scratch, row_key
from presslens.operators.joins import lookup_join

MIN_CHARS, MIN_DOCS = 40, 5
BITS_PER_LINE, MIN_BITS, MAX_BITS = 16, 1 << 20, 1 << 29
#: Bits set per hash.
PROBES = 4
#: Tasks that fill filters, and the bytes of a filter that are merged at once.
BUILDERS, SLICE = 64, 1 << 17
_BREAK = 10


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first, last, row, stripped first, stripped last) of each line; a text of n line breaks has n + 1 lines."""
    breaks = np.flatnonzero(data == _BREAK)
    first = np.sort(np.concatenate((offsets[:-1], breaks + 1)), kind="stable")
    last = np.sort(np.concatenate((breaks, offsets[1:])), kind="stable")
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(np.searchsorted(breaks, offsets)) + 1)
    solid = np.append(np.flatnonzero(W.NOT_SPACE[data]), len(data))
    lo, hi = np.searchsorted(solid, first), np.searchsorted(solid, last)
    some = hi > lo
    begin = np.where(some, solid[lo], first)
    end = np.where(some, solid[np.maximum(hi - 1, 0)] + 1, first)
    return first, last, row, begin, end


def long_lines(data: np.ndarray, offsets: np.ndarray, marks: W.Fingerprint, min_chars: int) -> tuple[np.ndarray, ...]:
    """(row, number in its row, first byte of the key, byte after it, hash) of the lines with keys long enough; `data` is lower-cased."""
    first, _, row, begin, end = line_spans(data, offsets)
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)))
    long = np.flatnonzero(chars[end] - chars[begin] >= max(min_chars, 1))
    number = long - np.searchsorted(row, row[long])
    return row[long], number, begin[long], end[long], marks.segments(data, begin[long], end[long])


def bits_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """The PROBES bits of each hash in a filter of `size` bits, a power of two."""
    step = W.mix(hashes ^ W.GOLDEN) | W.U(1)
    return ((hashes[:, None] + step[:, None] * np.arange(PROBES, dtype=W.U)) & W.U(size - 1)).astype(np.int64)


class Filters:
    """A pair of Bloom filters: hashes seen once, and hashes seen twice."""

    def __init__(self, size: int):
        self.size, self.once, self.twice = size, np.zeros(size // 8, np.uint8), np.zeros(size // 8, np.uint8)

    @staticmethod
    def _put(bitmap: np.ndarray, bits: np.ndarray) -> None:
        np.bitwise_or.at(bitmap, bits.ravel() >> 3, (1 << (bits.ravel() & 7)).astype(np.uint8))

    @staticmethod
    def _all(bitmap: np.ndarray, bits: np.ndarray) -> np.ndarray:
        return ((bitmap[bits >> 3] >> (bits & 7).astype(np.uint8)) & 1).all(axis=1)

    def add(self, hashes: np.ndarray) -> None:
        """Add hashes, block by block; equal ones in one block, and those that the first filter holds, are seen twice."""
        for at in range(0, len(hashes), 1 << 16):
            block, counts = np.unique(hashes[at : at + (1 << 16)], return_counts=True)
            bits = bits_of(block, self.size)
            self._put(self.twice, bits[(counts > 1) | self._all(self.once, bits)])
            self._put(self.once, bits)

    @staticmethod
    def merge(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return one[0] | other[0], one[1] | other[1] | (one[0] & other[0])


def holds(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether a filter may hold each hash."""
    return Filters._all(bitmap, bits_of(hashes, 8 * len(bitmap)))


def may_hold(key: Column, bitmap) -> Column:
    """Whether a filter (broadcast) may hold the key."""

    @F.arrow_udf("boolean")
    def found(keys: pa.Array) -> pa.Array:
        return pa.array(holds(np.frombuffer(bitmap.value, np.uint8), keys.to_numpy(zero_copy_only=False).view(W.U)))

    return found(key)


def line_hashes(rows: DataFrame, min_chars: int) -> DataFrame:
    """(hash) of the long lines of each row, equal lines of a row once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = W.Fingerprint()
        for batch in batches:
            for _, _, data, offsets in W.slices(batch.column("text")):
                row, _, _, _, hashes = long_lines(W.LOWER[data], offsets, marks, min_chars)
                order = np.lexsort((hashes, row))
                row, hashes = row[order], hashes[order]
                new = np.append(True, (row[1:] != row[:-1]) | (hashes[1:] != hashes[:-1]))[: len(row)]
                yield pa.RecordBatch.from_arrays([pa.array(hashes[new].view(np.int64))], ["hash"])

    return rows.select("text").mapInArrow(W.tidy(run), "hash long")


def filled(hashes: DataFrame, seen: int) -> np.ndarray:
    """The merged filter of the values of `hashes` (a written table) that are seen `seen` times, 1 or 2, or more often."""
    size, most = MIN_BITS, BITS_PER_LINE * hashes.count()
    while size < min(MAX_BITS, most):
        size *= 2

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = None
        for batch in batches:
            pair = pair or Filters(size)
            pair.add(batch.column("hash").to_numpy().view(W.U))
        for at in range(0, size // 8 if pair else 0, SLICE):
            parts = [pa.array([x[at : at + SLICE].tobytes()], pa.binary()) for x in (pair.once, pair.twice)]
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), *parts], ["at", "once", "twice"])

    def merge(parts: pa.Table) -> pa.Table:
        pair = None
        for once, twice in zip(parts["once"], parts["twice"], strict=True):
            one = tuple(np.frombuffer(x.as_buffer(), np.uint8) for x in (once, twice))
            pair = Filters.merge(pair, one) if pair else one
        return pa.table([pa.array([parts["at"][0].as_py()], pa.int64()), pa.array([pair[seen - 1].tobytes()], pa.binary())], ["at", "bits"])

    pairs = hashes.coalesce(BUILDERS).mapInArrow(W.tidy(fill), "at long, once binary, twice binary")
    out = np.zeros(size // 8, np.uint8)
    # At most MAX_BITS bits reach the driver.
    for part in pairs.groupBy("at").applyInArrow(merge, "at long, bits binary").collect():
        out[part["at"] : part["at"] + len(part["bits"])] = np.frombuffer(part["bits"], np.uint8)
    return out


def suspects(rows: DataFrame, twice, min_chars: int) -> DataFrame:
    """(doc_id, key, digest, numbers) of the lines that the filter `twice` lets through, one row for each row and digest."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, bitmap = W.Fingerprint(), np.frombuffer(twice.value, np.uint8)
        for batch in batches:
            for i, _, data, offsets in W.slices(batch.column("text")):
                data = W.LOWER[data]
                row, number, begin, end, hashes = long_lines(data, offsets, marks, min_chars)
                found: dict[tuple[int, bytes], list[int]] = {}
                for at in np.flatnonzero(holds(bitmap, hashes)).tolist():
                    digest = hashlib.sha256(data[begin[at] : end[at]].tobytes()).digest()
                    found.setdefault((i + int(row[at]), digest), []).append(int(number[at]))
                at = pa.array([r for r, _ in found], pa.int64())
                columns = [batch.column("doc_id").take(at), batch.column("key").take(at), pa.array([d for _, d in found], pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(list(found.values()), pa.list_(pa.int64()))], ["doc_id", "key", "digest", "numbers"])

    return rows.select("doc_id", "key", "text").mapInArrow(W.tidy(run), f"doc_id {kind}, key bigint, digest binary, numbers array<bigint>")


def without(rows: DataFrame) -> DataFrame:
    """(doc_id, none, text, n_lines, n_dropped): the texts without the lines in `numbers`."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "none", "text", "n_lines", "n_dropped"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("numbers")
            for i, j, data, offsets in W.slices(batch.column("text")):
                first, last, row, _, _ = line_spans(data, offsets)
                counts, out = np.bincount(row, minlength=j - i), []
                starts, dropped = np.cumsum(counts) - counts, np.zeros(j - i, np.int64)
                for r in range(j - i):
                    text = data[offsets[r] : offsets[r + 1]].tobytes()
                    if numbers[i + r].is_valid:
                        gone = set(numbers[i + r].as_py())
                        dropped[r], text = len(gone), text.split(b"\n")
                        text = b"\n".join(line for k, line in enumerate(text) if k not in gone)
                    out.append(text)
                part = batch.slice(i, j - i)
                made = [pa.array(out, pa.binary()), pa.array(counts, pa.int64()), pa.array(dropped)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("none"), *made], names)

    rows = rows.select("doc_id", "none", "text", "numbers")
    return rows.mapInArrow(W.tidy(run), f"doc_id {kind}, none boolean, text binary, n_lines bigint, n_dropped bigint")


def same_row(left: str, right: str) -> Column:
    return (F.col(f"{left}.key") == F.col(f"{right}.key")) & F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))


def without_rows(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that are not in `gone` (doc_id, key), a written table; only rows that a filter lets through are joined."""
    bitmap = docs.sparkSession.sparkContext.broadcast(filled(gone.select(F.col("key").alias("hash")), 1).tobytes())
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"), whole)
    rows = rows.withColumn("maybe", may_hold(F.col("key"), bitmap))
    left = rows.filter("maybe").alias("r").join(gone.alias("g"), same_row("r", "g"), "left_anti")
    kept = rows.filter("NOT maybe").select("row").unionByName(left.select("row"))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def lines_to_drop(rows: DataFrame, scratch: Scratch, min_chars: int, min_docs: int) -> DataFrame:
    """(doc_id, key, numbers): the numbers of the lines that the rows lose, a written table."""
    spread = rows.sparkSession.sparkContext.broadcast
    hashes = scratch.put(line_hashes(rows, min_chars), "hashes")
    found = scratch.put(suspects(rows, spread(filled(hashes, 2).tobytes()), min_chars), "suspects")
    scratch.drop("hashes")

    # Documents of a digest: distinct first, dealt by both, then counted with partial sums.
    bearers = found.select("digest", "doc_id").distinct().groupBy("digest")
    repeated = bearers.agg(F.count("*").alias("docs"), F.max("doc_id").alias("keeper")).filter(F.col("docs") >= min_docs)
    repeated = scratch.put(repeated.select("digest", "keeper"), "repeated")
    again = lookup_join(found, repeated, "digest", "key").filter(~F.col("doc_id").eqNullSafe(F.col("keeper")))
    numbers = F.array_distinct(F.flatten(F.collect_list("numbers")))
    places = scratch.put(again.groupBy("doc_id", "key").agg(numbers.alias("numbers")), "places")
    scratch.drop("suspects", "repeated")
    return places


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): every text without the repeated lines, and its lines before and dropped.

    The key of a line is the line without white space at its ends and with A-Z lower-cased. Keys of at
    least `min_chars` characters that at least `min_docs` documents hold lose all their lines but those
    of the document with the greatest id.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), row_key(id_col, text_col).alias("key"), F.col(text_col).isNull().alias("none"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    places = lines_to_drop(rows, scratch, min_chars, min_docs)
    bitmap = docs.sparkSession.sparkContext.broadcast(filled(places.select(F.col("key").alias("hash")), 1).tobytes())
    marked = rows.withColumn("maybe", may_hold(F.col("key"), bitmap))
    free = marked.filter("NOT maybe").withColumn("numbers", F.lit(None).cast("array<bigint>"))
    cut = marked.filter("maybe").alias("r").join(places.alias("p"), same_row("r", "p"), "left").select("r.doc_id", "none", "text", "numbers")
    done = without(free).unionByName(without(cut))
    return done.select("doc_id", F.when(~F.col("none"), F.decode("text", "UTF-8")).alias("text"), "n_lines", "n_dropped")
