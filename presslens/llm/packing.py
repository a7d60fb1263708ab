"""Bounded-space online packing of token ids into sequences.

Every task packs its documents as they come, with a fixed number of open windows: a piece goes to
the open window that it fills best; if none has room, the fullest is emitted and a new one opened.
A document longer than a sequence gives whole sequences and one rest, which is packed like a short
document. What stays open in the tasks is merged at the end, window by window, by the same rule, in
rounds that each take a bounded number of windows into one task.

Defined results: a null text is the empty text, whose only id is the end mark; repeated rows are
packed once each and keep their pieces apart; an empty table gives no pieces; only id and text are
read, so other columns cannot clash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm import words as W
from presslens.llm.store import Scratch
from presslens.llm.tokens import Encoder

OPEN_WINDOWS = 128
#: Tasks whose open windows meet in one task in a merging round.
FAN_IN = 32
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, window long, offset long"


class OpenWindows:
    """The fixed number of open windows of one task, ordered by their fill."""

    def __init__(self, size: int, windows: int, first_id: int):
        self.size, self.windows, self.next = size, windows, first_id
        self.open: list[tuple[int, int]] = []

    def place(self, length: int) -> tuple[int, int]:
        """(window, offset) of a piece of at most `size` ids."""
        if length == self.size:
            self.next += 1
            return self.next - 1, 0
        at = bisect_left(self.open, (self.size - length + 1, -1)) - 1
        if at >= 0:
            fill, window = self.open.pop(at)
        else:
            if len(self.open) >= self.windows:
                self.open.pop()
            fill, window, self.next = 0, self.next, self.next + 1
        if fill + length < self.size:
            insort(self.open, (fill + length, window))
        return window, fill


def packed_pieces(docs: DataFrame, path: str, size: int, end_id: int, windows: int) -> DataFrame:
    """One row per piece with its window in its task, and one row without document per window left open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        encoder, space = Encoder(path), OpenWindows(size, windows, task << 32)
        schema = pa.schema([(c.split()[0], pa.int64()) for c in (PIECES + ", fill long").split(", ")])
        end = np.array([end_id], "<u4").tobytes()

        def table(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=schema)

        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = memoryview(encoder.encode(text.as_py() or "") + end)
                n = len(ids) // 4
                for start in range(0, n, size):
                    length = min(size, n - start)
                    window, offset = space.place(length)
                    rows.append((doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, window, offset, None))
            if rows:
                yield table(rows)
        if space.open:
            yield table([(None, None, None, None, None, window, None, fill) for fill, window in space.open])

    return docs.mapInArrow(W.tidy(run), PIECES + ", fill long")


def merged(left: DataFrame, size: int, windows: int, scratch: Scratch) -> DataFrame:
    """(window, target, shift) for the open windows (window, fill) of all tasks, in rounds of FAN_IN tasks to one."""
    state = scratch.put(left.select("window", F.col("window").alias("target"), F.lit(0).cast("long").alias("shift"), "fill"), "merge-0")
    groups = (state.agg(F.max(F.shiftright("window", 32))).first()[0] or 0) + 1
    step, span = 0, 1
    while span < groups:
        step, span = step + 1, span * FAN_IN

        def merge(heads: pa.Table) -> pa.Table:
            heads = heads.sort_by([("fill", "descending"), ("target", "ascending")])
            space, heirs, out = OpenWindows(size, windows, 0), {}, []
            for target, fill in zip(heads["target"].to_pylist(), heads["fill"].to_pylist(), strict=True):
                number, offset = space.place(fill)
                out.append((target, heirs.setdefault(number, target), offset))
            still = {heirs[number]: fill for fill, number in space.open}
            rows = [(old, to, by, still.get(to)) for old, to, by in out]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            return pa.Table.from_arrays(columns, ["old", "target", "shift", "fill"])

        # Heads: windows that are still open; a window that a full one took in is closed with it.
        heads = state.filter("fill IS NOT NULL").groupBy("target").agg(F.max("fill").alias("fill"))
        keyed = heads.withColumn("task", F.expr(f"shiftright(target, 32) div {span}"))
        moved = keyed.groupBy("task").applyInArrow(merge, "old long, target long, shift long, fill long")
        moved = moved.select("old", F.col("target").alias("to"), F.col("shift").alias("by"), F.col("fill").alias("now"))
        again = state.join(moved, F.col("target") == F.col("old"), "left")
        again = again.select(
            "window", F.coalesce("to", "target").alias("target"), (F.col("shift") + F.coalesce("by", F.lit(0))).alias("shift"), F.col("now").alias("fill")
        )
        state = scratch.put(again, f"merge-{step}")
        scratch.drop(f"merge-{step - 1}")
    return state.select("window", "target", "shift")


def pack(
    docs: DataFrame, path: str, size: int = 2048, end_id: int = 1, windows: int = OPEN_WINDOWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), one row per piece.

    The tokenizer file must be at `path` on every machine.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = scratch.put(packed_pieces(rows, path, size, end_id, windows), "pieces")
    moves = merged(pieces.filter("length IS NULL").select("window", "fill"), size, windows, scratch)
    pieces = pieces.filter("length IS NOT NULL").drop("fill").join(moves, "window", "left")
    return pieces.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        F.coalesce("target", "window").alias("sequence_id"), (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
    )
