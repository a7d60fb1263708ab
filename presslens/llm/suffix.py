"""Exact substring dedup: bytes of long strings that start in two places, by blockwise suffix buckets.

Suffixes are compared by their first `length` bytes. Positions of a difference cover (the powers of
two modulo 73, nine places of which every distance modulo 73 is a difference) are the sample: for
any two places there is a shift below 73 that brings both into it. Four rounds, each sorting one
suffix bucket at a time, in which an entry is a few bytes of a suffix's fingerprint:

1. Sample suffixes are ranked by their first length - 72 bytes. Two equal long strings share a
   sample rank at some shift, so only places shortly before a shared rank can be repeated.
2. Long ties: a sample suffix whose neighbourhood of length + 72 bytes occurs twice settles all 73
   strings around it at once, without a look at single suffixes.
3. Ranks are marked that hold a suffix which round 2 left open.
4. The strings before the marked ranks, the ends of repeats, are sorted by their whole length.

A bucket entry stands for all equal suffixes of one chunk of texts, so a string that fills a third
of the corpus has one entry per chunk. The answer to a chunk is one bit per entry. Order inside a
bucket is by fingerprint, since only equality matters; 90 bits of it settle rounds 2 and 4.

Defined results: a null or empty text loses nothing; texts shorter than `length` are never touched;
repeated rows are separate texts, so each is a copy of the other; a null id is carried along; an
empty table gives an empty result; only id and text are read, so other columns cannot clash. A text
that is longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm import words as W
from presslens.llm.store import Scratch, texts

LENGTH = 200
PERIOD = 73
COVER = np.unique([pow(2, k, PERIOD) for k in range(9)])
CHUNK = 1 << 22
BUCKET = 1 << 25
#: Chunks that a worker holds at once.
AT_ONCE = 2
U = W.U


def sample(offsets: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, row) of the difference cover in every text, as far as `need` bytes follow."""
    room = np.maximum(np.diff(offsets) - need + 1, 0)
    per = room // PERIOD * len(COVER) + np.searchsorted(COVER, room % PERIOD)
    row = np.repeat(np.arange(len(room)), per)
    k = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    return offsets[row] + k // len(COVER) * PERIOD + COVER[k % len(COVER)], row


class Entries:
    """Distinct keys of one chunk, in order, and where each of its suffixes finds its key."""

    def __init__(self, high: np.ndarray, low: np.ndarray | None = None, flags: np.ndarray | None = None):
        order = np.argsort(high)
        if low is not None and len(high) and ((high[order[1:]] == high[order[:-1]]) & (low[order[1:]] != low[order[:-1]])).any():
            order = np.lexsort((low, high))
        fresh = np.ones(len(high), bool)
        fresh[1:] = high[order[1:]] != high[order[:-1]]
        if low is not None:
            fresh[1:] |= low[order[1:]] != low[order[:-1]]
        first = np.flatnonzero(fresh)
        self.of = np.empty(len(high), np.int64)
        self.of[order] = np.cumsum(fresh) - 1
        self.high, self.low = high[order][first], None if low is None else low[order][first]
        size = np.diff(np.append(first, len(high)))
        self.flags = size > 1 if flags is None else np.bincount(self.of, flags, len(first)) > 0

    def found(self, answers: list[dict] | None, bits: int) -> np.ndarray:
        """The answer for each suffix."""
        out = np.zeros(len(self.high), bool)
        cuts = self.cuts(bits)
        for one in answers or ():
            lo, hi = cuts[one["bucket"]], cuts[one["bucket"] + 1]
            out[lo:hi] = np.unpackbits(np.frombuffer(one["bits"], np.uint8), count=hi - lo)
        return out[self.of]

    def cuts(self, bits: int) -> np.ndarray:
        edges = np.searchsorted(self.high, np.arange(1 << bits, dtype=U) << U(64 - bits))
        return np.append(edges, len(self.high))


class Chunk:
    """The texts of one chunk with what the rounds so far have settled about their suffixes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int, bits: int):
        self.data, self.offsets, self.length, self.bits = data, offsets, length, bits
        self.at, self.row = sample(offsets, length - PERIOD + 1)
        ranked = W.Fingerprint(1).segments(data, self.at, self.at + (length - PERIOD + 1))
        # Ranks are only a filter: 40 bits beyond the bucket's will do.
        self.ranks = ranked >> U(24 - bits) << U(24 - bits) if bits <= 24 else ranked

    def rank_entries(self) -> Entries:
        return Entries(self.ranks)

    def shared(self, answers: list[dict] | None) -> None:
        """Keep the sample suffixes with a shared rank."""
        keep = Entries(self.ranks).found(answers, self.bits)
        self.at, self.row, self.ranks = self.at[keep], self.row[keep], self.ranks[keep]
        self.whole = (self.at - (PERIOD - 1) >= self.offsets[self.row]) & (self.at + self.length <= self.offsets[self.row + 1])

    def keys(self, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        high = W.Fingerprint(2).segments(self.data, first, first + size)
        low = W.Fingerprint(3).segments(self.data, first, first + size)
        return high, (low >> U(48)).astype(np.uint16)

    def tie_entries(self) -> Entries:
        return Entries(*self.keys(self.at[self.whole] - (PERIOD - 1), self.length + PERIOD - 1))

    def ties(self, answers: list[dict] | None) -> None:
        self.settled = np.zeros(len(self.at), bool)
        self.settled[self.whole] = self.tie_entries().found(answers, self.bits)

    def open_entries(self) -> Entries:
        return Entries(self.ranks, flags=~self.settled)

    def strings(self, keep: np.ndarray) -> np.ndarray:
        """Flags of the places from which one of the kept sample suffixes is less than a period away."""
        change = np.zeros(len(self.data) + 1, np.int32)
        lo = np.maximum(self.at[keep] - (PERIOD - 1), self.offsets[self.row[keep]])
        hi = np.minimum(self.at[keep], self.offsets[self.row[keep] + 1] - self.length) + 1
        some = hi > lo
        np.add.at(change, lo[some], 1)
        np.subtract.at(change, hi[some], 1)
        return np.cumsum(change[:-1], dtype=np.int32) > 0

    def end_entries(self, answers: list[dict] | None) -> Entries:
        marked = Entries(self.ranks, flags=~self.settled).found(answers, self.bits)
        self.ends = np.flatnonzero(self.strings(marked))
        return Entries(*self.keys(self.ends, self.length))

    def removed(self, marks: list[dict] | None, answers: list[dict] | None) -> np.ndarray:
        """Flags of the bytes that a repeated string covers."""
        found = self.end_entries(marks).found(answers, self.bits)
        starts = self.strings(self.settled)
        starts[self.ends[found]] = True
        change = np.zeros(len(self.data) + 1, np.int32)
        first = np.flatnonzero(starts)
        change[first] += 1
        change[first + self.length] -= 1
        return np.cumsum(change[:-1], dtype=np.int32) > 0


def chunked(docs: DataFrame, size: int) -> DataFrame:
    """(chunk, ids, ends, data): texts put together to chunks of about `size` bytes, one row each."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, j, data, offsets in W.slices(batch.column("text"), size):
                ids = pa.array([batch.column("doc_id").slice(i, j - i).to_pylist()], pa.list_(batch.column("doc_id").type))
                ends = pa.array([offsets.tobytes()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), ids, ends, pa.array([data.tobytes()], pa.binary())], ["chunk", "ids", "ends", "data"])
                number += 1

    return docs.mapInArrow(W.tidy(run), f"chunk long, ids array<{kind}>, ends binary, data binary")


def opened(batch: pa.RecordBatch, i: int, length: int, bits: int, answers: list[str]) -> tuple[Chunk, list]:
    data = np.frombuffer(batch.column("data")[i].as_buffer(), np.uint8)
    offsets = np.frombuffer(batch.column("ends")[i].as_buffer(), np.int64)
    return Chunk(data, offsets, length, bits), [batch.column(a)[i].as_py() for a in answers]


def entries_sent(chunks: DataFrame, entries: Callable[..., Entries], length: int, bits: int, answers: list[str]) -> DataFrame:
    """(bucket, chunk, high, low, flags): the entries of every chunk, packed per bucket."""
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("high", pa.binary()), ("low", pa.binary()), ("flags", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                chunk, known = opened(batch, i, length, bits, answers)
                own, rows = entries(chunk, *known), []
                cuts, number = own.cuts(bits), batch.column("chunk")[i].as_py()
                for bucket in np.flatnonzero(np.diff(cuts)):
                    part = slice(cuts[bucket], cuts[bucket + 1])
                    if own.low is None:
                        # Five bytes below the bucket's bits.
                        high = (own.high[part] >> U(24 - bits) if bits <= 24 else own.high[part]) & U((1 << 40) - 1)
                        high = high.view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
                    else:
                        high = own.high[part].tobytes()
                    low = b"" if own.low is None else own.low[part].tobytes()
                    rows.append((int(bucket), number, high, low, np.packbits(own.flags[part]).tobytes()))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return chunks.select("chunk", "ends", "data", *answers).mapInArrow(W.tidy(run), "bucket int, chunk long, high binary, low binary, flags binary")


def resolved(sent: DataFrame, repeats: bool, name: str) -> DataFrame:
    """(chunk, name): per chunk and bucket one bit per entry: is it repeated, or (not `repeats`) is an equal one flagged?"""

    def sort(table: pa.Table) -> pa.Table:
        highs, lows, flags, sizes = [], [], [], []
        for high, low, flag in zip(table["high"], table["low"], table["flags"], strict=True):
            low = np.frombuffer(low.as_buffer(), np.uint16)
            if len(low):
                high = np.frombuffer(high.as_buffer(), U)
            else:
                five = np.frombuffer(high.as_buffer(), np.uint8).reshape(-1, 5)
                high = np.zeros((len(five), 8), np.uint8)
                high[:, :5] = five
                high = high.reshape(-1).view(U)
            highs.append(high)
            lows.append(low)
            sizes.append(len(high))
            flags.append(np.unpackbits(np.frombuffer(flag.as_buffer(), np.uint8), count=len(high)))
        low = np.concatenate(lows)
        all_flags = np.concatenate(flags)
        entries = Entries(np.concatenate(highs), low if len(low) else None, all_flags)
        answer = entries.flags
        if repeats:
            answer = answer | (np.bincount(entries.of) > 1)
        answer, at, out = answer[entries.of], 0, []
        for chunk, bucket, size in zip(table["chunk"].to_pylist(), table["bucket"].to_pylist(), sizes, strict=True):
            bits = answer[at : at + size]
            at += size
            if bits.any():
                out.append((chunk, bucket, np.packbits(bits).tobytes()))
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table({"chunk": pa.array(columns[0], pa.int64()), "bucket": pa.array(columns[1], pa.int32()), "bits": pa.array(columns[2], pa.binary())})

    back = sent.groupBy("bucket").applyInArrow(sort, "chunk long, bucket int, bits binary")
    return back.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias(name))


def cut(chunks: DataFrame, length: int, bits: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): what is left of every text."""
    kind = chunks.schema["ids"].dataType.elementType.simpleString()
    answers = ["ranks", "ties", "open", "ends_found"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                chunk, (ranks, ties, marks, found) = opened(batch, i, length, bits, answers)
                chunk.shared(ranks)
                chunk.ties(ties)
                gone, offsets = chunk.removed(marks, found), chunk.offsets
                spans = np.bincount(W.spans(gone, offsets)[2], minlength=len(offsets) - 1)
                kept = [chunk.data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
                ids = batch.column("ids")[i].values
                columns = [ids, pa.array(np.diff(offsets)), pa.array(W.per_row(gone, offsets)), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    rows = chunks.select("ids", "ends", "data", *answers)
    return rows.mapInArrow(W.tidy(run), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def drop_repeated_strings(docs: DataFrame, length: int = LENGTH, chunk_bytes: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept), one row per row of `docs`; `kept` holds the remaining bytes."""
    if length < 2 * PERIOD:
        raise ValueError(f"strings of at least {2 * PERIOD} bytes")
    scratch = Scratch(docs.sparkSession, "suffix")
    chunks = scratch.put(chunked(texts(docs, id_col, text_col), chunk_bytes), "chunks")
    total = chunks.agg(F.sum(F.octet_length("data").cast("long"))).first()[0] or 0
    # A bucket holds the entries of about BUCKET bytes of text.
    bits = max(8, math.ceil(math.log2(total / BUCKET + 1)))

    rounds = [
        ("ranks", True, lambda c: c.rank_entries()),
        ("ties", True, lambda c, ranks: (c.shared(ranks), c.tie_entries())[1]),
        ("open", False, lambda c, ranks, ties: (c.shared(ranks), c.ties(ties), c.open_entries())[2]),
        ("ends_found", True, lambda c, ranks, ties, marks: (c.shared(ranks), c.ties(ties), c.end_entries(marks))[2]),
    ]
    known, joined = [], chunks
    for name, repeats, entries in rounds:
        sent = entries_sent(joined, entries, length, bits, list(known))
        answers = scratch.put(resolved(sent, repeats, name), name, AT_ONCE)
        joined = joined.join(answers, "chunk", "left")
        known.append(name)
    out = scratch.put(cut(joined, length, bits), "cut", AT_ONCE)
    scratch.drop("chunks", *known)
    return out
