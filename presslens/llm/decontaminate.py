"""Benchmark decontamination with a distributed positional inverted index.

Words of both sides are hashed. The corpus frequency of every benchmark word is counted first. Each
window of `width` consecutive item words then has its two rarest words as anchors. The index holds
postings (word, document, positions) of the anchors only; which words a task keeps, it learns from
a bit set of fixed size, and the join drops what the bit set lets through in excess. The lists of
two anchors are intersected after subtracting their places in the item, which gives alignments
(item, document, shift); at an alignment the words of item and document are compared one by one, and
runs of at least a whole window of equal words are exact phrase matches. With `slop`, anchors whose
distance is off by at most that much, without being exact, are proximity matches.

Defined results: a null or empty text has no words, no hits and is not contaminated; an item without
words matches nothing; an item of fewer than `width` words is one window; repeated rows get the same
result; an item with a null id marks its words but has no name to list; an empty benchmark leaves all
documents clean; an empty table gives an empty result; only id
and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm import words as W
from presslens.llm.store import Scratch, row_key

WIDTH = 13
#: Size of the bit set that tasks use to skip words; the index is the same whatever it lets through.
SIEVE_BITS = 1 << 23


def hashed(data: np.ndarray, offsets: np.ndarray, marks: W.Fingerprint) -> tuple[np.ndarray, ...]:
    """(first, last, row, hash) of each word."""
    data = W.LOWER[data]
    first, last, row = W.spans(W.ALNUM[data], offsets)
    return first, last, row, marks.segments(data, first, last).view(np.int64)


def item_words(items: DataFrame) -> DataFrame:
    """(item, item_id, words): the hashed words of each benchmark text that has any, as an array."""
    kind = items.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = W.Fingerprint()
        for batch in batches:
            for i, j, data, offsets in W.slices(batch.column("text")):
                _, _, row, found = hashed(data, offsets, marks)
                cuts = np.searchsorted(row, np.arange(j - i + 1))
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(found, pa.int64()))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column("item"), part.column("item_id"), lists], ["item", "item_id", "words"])

    return items.mapInArrow(W.tidy(run), f"item long, item_id {kind}, words array<long>").filter("size(words) > 0")


def sieve(words: DataFrame) -> np.ndarray:
    """The fixed-size bit set of a table of hashed words, as packed bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(SIEVE_BITS, bool)
        for batch in batches:
            bits[batch.column(0).to_numpy().view(W.U) % W.U(SIEVE_BITS)] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])

    # Four parts of SIEVE_BITS / 8 bytes each reach the driver, whatever the size of the benchmark.
    parts = words.repartition(4).mapInArrow(W.tidy(run), "bits binary").collect()
    out = np.zeros(SIEVE_BITS // 8, np.uint8)
    for part in parts:
        out |= np.frombuffer(part.bits, np.uint8)
    return out


def frequencies(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(word, n): how often each of the words stands in the corpus, 0 included."""
    bits = docs.sparkSession.sparkContext.broadcast(sieve(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, keep = W.Fingerprint(), np.unpackbits(bits.value).astype(bool)
        for batch in batches:
            for _, _, data, offsets in W.slices(batch.column("text"), 1 << 22):
                found = hashed(data, offsets, marks)[3]
                word, n = np.unique(found[keep[found.view(W.U) % W.U(SIEVE_BITS)]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(n, pa.int64())], ["word", "n"])

    counted = docs.select("text").mapInArrow(W.tidy(run), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.join(counted, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n"))


def anchors(items: DataFrame, counts: DataFrame, width: int) -> DataFrame:
    """(item, p1, w1, p2, w2): places and hashes of the two rarest words of every window, distinct."""
    placed = items.select("item", F.size("words").alias("size"), F.posexplode("words").alias("place", "word")).join(counts, "word")
    start = F.explode(F.sequence(F.greatest(F.col("place") - width + 1, F.lit(0)), F.least(F.col("place"), F.greatest(F.col("size") - width, F.lit(0)))))
    rank = F.row_number().over(Window.partitionBy("item", "start").orderBy("n", "place"))
    ranked = placed.withColumn("start", start).withColumn("rank", rank).filter("rank <= 2")
    pair = ranked.groupBy("item", "start").agg(F.min(F.struct("rank", "place", "word")).alias("a"), F.max(F.struct("rank", "place", "word")).alias("b"))
    return pair.select("item", F.col("a.place").alias("p1"), F.col("a.word").alias("w1"), F.col("b.place").alias("p2"), F.col("b.word").alias("w2")).distinct()


def postings(docs: DataFrame, words: DataFrame) -> DataFrame:
    """(word, key, places): where each of the words stands in each document."""
    bits = docs.sparkSession.sparkContext.broadcast(sieve(words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, keep = W.Fingerprint(), np.unpackbits(bits.value).astype(bool)
        for batch in batches:
            for i, _, data, offsets in W.slices(batch.column("text")):
                _, _, row, found = hashed(data, offsets, marks)
                at = np.flatnonzero(keep[found.view(W.U) % W.U(SIEVE_BITS)])
                place = at - np.searchsorted(row, row[at])
                at = at[order := np.lexsort((place, found[at], row[at]))]
                place, word, doc = place[order], found[at], row[at]
                fresh = np.flatnonzero(np.concatenate((np.ones(min(1, len(at)), bool), (word[1:] != word[:-1]) | (doc[1:] != doc[:-1]))))
                lists = pa.ListArray.from_arrays(pa.array(np.append(fresh, len(at)), pa.int32()), pa.array(place, pa.int32()))
                keys = batch.column("key").take(pa.array(doc[fresh] + i))
                yield pa.RecordBatch.from_arrays([pa.array(word[fresh]), keys, lists], ["word", "key", "places"])

    found = docs.select("key", "text").mapInArrow(W.tidy(run), "word long, key long, places array<int>")
    return found.join(words, "word", "left_semi").distinct()


def alignments(pairs: DataFrame, index: DataFrame, slop: int) -> DataFrame:
    """(item, key, shift, gap): documents in which both anchors of a pair stand, `gap` off their distance in the item."""
    first = index.select(F.col("word").alias("w1"), "key", F.col("places").alias("x"))
    second = index.select(F.col("word").alias("w2"), "key", F.col("places").alias("y"))
    both = pairs.join(first, "w1").join(second, ["w2", "key"])
    shifts = F.transform("x", lambda v: v - F.col("p1"))
    if slop == 0:
        # Offset-adjusted lists of one document: their intersection is the exact alignments.
        found = F.array_intersect(shifts, F.transform("y", lambda v: v - F.col("p2")))
        return both.select("item", "key", F.explode(found).alias("shift"), F.lit(0).alias("gap")).distinct()
    near = both.select("item", "key", "p2", "y", F.explode(shifts).alias("shift"))
    near = near.select("item", "key", "shift", F.explode(F.transform("y", lambda v: F.abs(v - F.col("p2") - F.col("shift")))).alias("gap"))
    return near.filter(F.col("gap") <= slop).groupBy("item", "key", "shift").agg(F.min("gap").alias("gap"))


def word_lists(docs: DataFrame, bits) -> DataFrame:
    """(doc_id, key, n_words, own): the number of words of every text, and the hashed words where `bits` may hold the key."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, keep = W.Fingerprint(), np.unpackbits(bits.value).astype(bool)
        for batch in batches:
            wanted = keep[batch.column("key").to_numpy().view(W.U) % W.U(SIEVE_BITS)]
            for i, j, data, offsets in W.slices(batch.column("text")):
                _, _, row, found = hashed(data, offsets, marks)
                cuts = np.searchsorted(row, np.arange(j - i + 1))
                own = [found[cuts[r] : cuts[r + 1]].tobytes() if wanted[i + r] else None for r in range(j - i)]
                part = batch.slice(i, j - i)
                columns = [part.column("doc_id"), part.column("key"), pa.array(np.diff(cuts), pa.int64()), pa.array(own, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n_words", "own"])

    return docs.select("doc_id", "key", "text").mapInArrow(W.tidy(run), f"doc_id {kind}, key long, n_words long, own binary")


def compared(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, key, n_words, n_hit, ids): the words of documents held against the items at their alignments (column `at`)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, ids = [], []
            for packed, at in zip(batch.column("own"), batch.column("at"), strict=True):
                own = np.frombuffer(packed.as_buffer(), np.int64) if at.is_valid else np.zeros(0, np.int64)
                seen, names = np.zeros(len(own), bool), set()
                for one in at.as_py() or ():
                    item = np.array(one["words"], np.int64)
                    for shift in one["shifts"]:
                        lo, hi = max(0, -shift), min(len(item), len(own) - shift)
                        if hi <= lo:
                            continue
                        same = np.concatenate(([0], (own[lo + shift : hi + shift] == item[lo:hi]).astype(np.int8), [0]))
                        edges = np.flatnonzero(np.diff(same)).reshape(-1, 2)
                        for a, b in edges[edges[:, 1] - edges[:, 0] >= min(width, len(item))]:
                            seen[lo + shift + a : lo + shift + b] = True
                            if one["item_id"] is not None:
                                names.add(one["item_id"])
                hits.append(int(seen.sum()))
                ids.append(sorted(names))
            columns = [batch.column(c) for c in ("doc_id", "key", "n_words")] + [pa.array(hits, pa.int64()), pa.array(ids, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n_words", "n_hit", "ids"])

    rows = docs.select("doc_id", "key", "n_words", "own", "at")
    return rows.mapInArrow(W.tidy(run), f"doc_id {kind}, key long, n_words long, n_hit long, ids array<string>")


class Index:
    """The postings of the anchors of one benchmark over one corpus."""

    def __init__(self, docs: DataFrame, bench: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text"):
        self.docs, self.width, self.id_col, self.text_col = docs, width, id_col, text_col
        self.scratch = Scratch(docs.sparkSession, "decontaminate")
        text = F.coalesce(F.col(item_text), F.lit(""))
        items = bench.select(F.xxhash64(item_col, item_text).alias("item"), F.col(item_col).cast("string").alias("item_id"), text.cast("binary").alias("text"))
        self.items = self.scratch.put(item_words(items).distinct(), "items")
        key = row_key(id_col, text_col).alias("key")
        narrow = self.narrow = docs.select(F.col(id_col).alias("doc_id"), key, F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
        vocabulary = self.items.select(F.explode("words").alias("word")).distinct()
        counts = self.scratch.put(frequencies(narrow, vocabulary), "frequencies")
        self.pairs = self.scratch.put(anchors(self.items, counts, width), "anchors")
        wanted = self.pairs.select(F.col("w1").alias("word")).union(self.pairs.select("w2")).distinct()
        self.postings = self.scratch.put(postings(narrow, wanted), "postings")

    def contamination(self) -> DataFrame:
        """(doc_id, key, n_words, n_hit, ids) of every document: words hit by exact phrase matches, and the matched items.

        Words travel only of documents with an alignment, which a bit set of fixed size tells from most others.
        """
        # The shifts of an item in a document first, so that its words come once, however often it may stand there.
        found = alignments(self.pairs, self.postings, 0).groupBy("key", "item").agg(F.collect_set("shift").alias("shifts")).join(self.items, "item")
        found = found.groupBy("key").agg(F.collect_list(F.struct("item_id", "words", "shifts")).alias("at"))
        found = self.scratch.put(found, "alignments")
        bits = self.docs.sparkSession.sparkContext.broadcast(sieve(found.select("key")))
        # Written, so that no task needs two Python workers, one for words and one for the comparison.
        words = self.scratch.put(word_lists(self.narrow, bits), "words")
        return compared(words.join(found, "key", "left"), self.width)

    def proximity(self, slop: int) -> DataFrame:
        """(doc_id, item_id, gap): documents with both anchors of a window at most `slop` off, but not exact."""
        near = alignments(self.pairs, self.postings, slop).join(self.items, "item")
        near = near.groupBy("key", "item_id").agg(F.min("gap").alias("gap")).filter("gap > 0")
        ids = self.docs.select(row_key(self.id_col, self.text_col).alias("key"), F.col(self.id_col).alias("doc_id"))
        return ids.join(near, "key").select("doc_id", "item_id", "gap")


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words", percent: int = 5) -> Column:
    return (F.col(n_hit) > 0) & (100 * F.col(n_hit) >= percent * F.col(n_words))


def items_digest() -> Column:
    """SHA-256 of the matched item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join("ids", ","), 256)
