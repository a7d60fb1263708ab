"""Near-duplicate groups: SuperMinHash signatures, banding, verification on whole sets, components.

A text's set holds its distinct runs of `width` words, lower-cased A-Z. SuperMinHash gives element x
in step j the value j + r(x, j) at the j-th place of a random permutation of x's own; the signature
keeps the least value of each place. A step ends the work on a text as soon as no place can sink any
more. All elements of a buffer take a step together.

Texts with one set are one class, so a thousand copies are one row from then on. Bands of a
signature put classes into buckets. First every class is held against the least of its bucket, the
hub, on whole sets, and verified pairs are linked. Classes of one hub that are then not in one
component are held against each other in blocks, by what sets them apart from the hub. So each pair
that shares a band is either verified or already connected; pairs are never rows. Components come
from alternating large-star and small-star rounds over the links.

With 28 bands of 4 rows a pair at the threshold shares no band with probability below 1e-6.

Defined results: a null or empty text, or one without words, has an empty set and stays alone; a
text of fewer than `width` words has one element, its whole sequence; repeated rows and rows with
one id share a component; an empty table gives an empty result; only id and text are read, so other
columns cannot clash. Elements are 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.llm import words as W
from presslens.llm.store import Scratch, texts
from presslens.operators.joins import lookup_join

WIDTH, BANDS, ROWS = 4, 28, 4
#: Members of a hub that one task holds against as many others.
BLOCK = 2048
U = W.U


def shingles(data: np.ndarray, offsets: np.ndarray, marks: W.Fingerprint, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, element): the distinct elements of each text, ordered by row and value."""
    data = W.LOWER[data]
    first, last, row = W.spans(W.NOT_SPACE[data], offsets)
    hashes = marks.segments(data, first, last)
    at, found = W.chained(hashes, row, width)
    found_row = row[at]
    n_words = np.bincount(row, minlength=len(offsets) - 1)
    ends = np.cumsum(n_words)
    for short in range(1, width):
        few = np.flatnonzero(n_words == short)
        whole = np.zeros(len(few), U)
        for k in range(short):
            whole = W.mix(whole * U(3) + hashes[ends[few] - short + k])
        found, found_row = np.concatenate((found, whole)), np.concatenate((found_row, few))
    order = np.lexsort((found, found_row))
    found, found_row = found[order], found_row[order]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:] != found[:-1]) | (found_row[1:] != found_row[:-1])
    return found_row[fresh], found[fresh]


def super_minhash(row: np.ndarray, elements: np.ndarray, n: int, m: int) -> np.ndarray:
    """n signatures of m places; `row` ascends. Places hold step * 2^32 + a 32-bit draw."""
    signs = np.full((n, m), np.iinfo(np.uint64).max, U)
    flat = signs.reshape(-1)
    places = None
    for j in range(m):
        draw = W.mix(elements + np.array([j], U) * W.GOLDEN)
        pick = (j + (((draw & U(0xFFFFFFFF)) * U(m - j)) >> U(32)).astype(np.int64)).astype(np.int64)
        if places is None:
            slot = pick
        else:
            k = np.arange(len(elements))
            slot = places[k, pick].astype(np.int64)
            places[k, pick] = places[:, j]
            places[:, j] = slot
        np.minimum.at(flat, row * m + slot, (U(j) << U(32)) | (draw >> U(32)))
        # A text is done when every place holds less than what the next step can give.
        more = signs[row].max(axis=1) >= U(j + 1) << U(32) if len(row) < n else (signs.max(axis=1) >= U(j + 1) << U(32))[row]
        if not more.any():
            break
        elements, row = elements[more], row[more]
        if places is None:
            places = np.tile(np.arange(m, dtype=np.uint16), (len(elements), 1))
            k, first = np.arange(len(elements)), pick[more]
            places[k, first], places[:, 0] = 0, first
        else:
            places = places[more]
    return signs


def band_keys(signs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(signs), bands), U)
    for k in range(rows):
        out = W.mix(out * U(3) + signs[:, k::rows][:, :bands])
    return out


def signatures(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, s1, s2, bands): the set's size, two sums over it that name the set, and its band keys."""
    schema = "doc_id long, n_shingles long, s1 long, s2 long, bands array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = W.Fingerprint()
        for batch in batches:
            for i, j, data, offsets in W.slices(batch.column("text"), 1 << 19):
                row, elements = shingles(data, offsets, marks, width)
                size = np.bincount(row, minlength=j - i)
                ends = np.cumsum(size)
                sums = []
                for salt in (U(11), U(12)):
                    total = np.concatenate((np.zeros(1, U), np.cumsum(W.mix(elements * U(2) + salt), dtype=U)))
                    sums.append((total[ends] - total[ends - size]).view(np.int64))
                keys = band_keys(super_minhash(row, elements, j - i, bands * rows), bands, rows).view(np.int64)
                filled = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(np.where(size > 0, bands, 0)))), pa.int32()), pa.array(keys[size > 0].reshape(-1))
                )
                columns = [batch.column("doc_id").slice(i, j - i), pa.array(size, pa.int64()), *map(pa.array, sums), filled]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "s1", "s2", "bands"])

    return docs.mapInArrow(W.tidy(run), schema)


def sets_of(docs: DataFrame, width: int) -> DataFrame:
    """(node, elements): the sorted set of each text as packed 64-bit values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = W.Fingerprint()
        for batch in batches:
            for i, j, data, offsets in W.slices(batch.column("text")):
                row, elements = shingles(data, offsets, marks, width)
                cuts = np.searchsorted(row, np.arange(j - i + 1))
                packed = [elements[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("node").slice(i, j - i), pa.array(packed, pa.binary())], ["node", "elements"])

    return docs.select("node", "text").mapInArrow(W.tidy(run), "node long, elements binary")


def compared(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, n_a, n_b, linked, diff) of pairs (a, b): sizes, whether 100 * intersection >= percent * union, and the
    elements that only one of both has, as packed 64-bit values in order."""
    left = sets.select(F.col("node").alias("a"), F.col("elements").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("elements").alias("y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b, linked, diff = [], [], [], []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = np.sort(np.concatenate((x, y)))
                twice = np.zeros(len(both), bool)
                twice[1:] = both[1:] == both[:-1]
                shared = int(twice.sum())
                twice[:-1] |= twice[1:]
                n_a.append(len(x))
                n_b.append(len(y))
                linked.append(100 * shared >= percent * (len(both) - shared))
                diff.append(both[~twice].tobytes())
            columns = [batch.column("a"), batch.column("b"), pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()), pa.array(linked, pa.bool_()), pa.array(diff, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "n_a", "n_b", "linked", "diff"])

    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return rows.mapInArrow(W.tidy(run), "a long, b long, n_a long, n_b long, linked boolean, diff binary")


def shared_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of `x` shares with each of `y`: a sparse matrix product, element by element of
    few holders, and a dense one for elements of many."""
    ix = np.repeat(np.arange(len(x)), [len(e) for e in x])
    iy = np.repeat(np.arange(len(y)), [len(e) for e in y])
    ex, ey = np.concatenate(x), np.concatenate(y)
    both = np.intersect1d(ex, ey)
    out = np.zeros((len(x), len(y)), np.float32)
    if not len(both):
        return out

    def placed(elements, holder):
        at = np.minimum(np.searchsorted(both, elements), len(both) - 1)
        keep = both[at] == elements
        at, holder = at[keep], holder[keep]
        order = np.argsort(at, kind="stable")
        return at[order], holder[order]

    ax, hx = placed(ex, ix)
    ay, hy = placed(ey, iy)
    nx, ny = np.bincount(ax, minlength=len(both)), np.bincount(ay, minlength=len(both))
    many = nx * ny > 64
    for lo in range(0, int(many.sum()), 512):
        chosen = np.flatnonzero(many)[lo : lo + 512]
        column = np.full(len(both), -1)
        column[chosen] = np.arange(len(chosen))
        left, right = np.zeros((len(x), len(chosen)), np.float32), np.zeros((len(y), len(chosen)), np.float32)
        k = column[ax] >= 0
        left[hx[k], column[ax[k]]] = 1
        k = column[ay] >= 0
        right[hy[k], column[ay[k]]] = 1
        out += left @ right.T
    few = ~many[ax]
    ax, hx = ax[few], hx[few]
    first = np.cumsum(ny) - ny
    for lo in range(0, len(ax), 1 << 14):
        at, holder = ax[lo : lo + (1 << 14)], hx[lo : lo + (1 << 14)]
        size = ny[at]
        other = hy[np.repeat(first[at] - np.cumsum(size) + size, size) + np.arange(size.sum())]
        np.add.at(out, (np.repeat(holder, size), other), 1)
    return out


def joined(pairs: np.ndarray) -> np.ndarray:
    """(node, least node) of what the pairs connect."""
    nodes, at = np.unique(pairs, return_inverse=True)
    at, label = at.reshape(-1, 2), np.arange(len(nodes))
    while True:
        low = np.minimum(label[at[:, 0]], label[at[:, 1]])
        fresh = label.copy()
        np.minimum.at(fresh, at[:, 0], low)
        np.minimum.at(fresh, at[:, 1], low)
        fresh = fresh[fresh]
        if (fresh == label).all():
            return np.stack((nodes, nodes[label]), axis=1)
        label = fresh


def across_components(members: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(a, b): links between components inside the groups of one hub, enough to join what belongs together.

    `members` has hub, node, component, n (size of the set) and diff (from the hub's set). Two sets
    differ in what exactly one of their differences from the hub has, so whole sets need not travel.
    A group is cut into blocks of BLOCK members; each pair of blocks is one task of bounded size that
    counts shared elements as matrix products and sends no more links than it has members.
    """
    sizes = members.groupBy("hub").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    # Broadcast while small, else salted: either way rows are not dealt by hub, and pairs of blocks are.
    rows = lookup_join(members, scratch.put(sizes, "sizes"), "hub", "node")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "hub", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "component", "n", "diff"
    )

    def match(table: pa.Table) -> pa.Table:
        block, i = table["block"].to_numpy(), table["i"][0].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block != i)
        right = right if table["j"][0].as_py() != i else left
        diffs = [np.frombuffer(d.as_buffer(), U) for chunk in table["diff"].chunks for d in chunk]
        n, component = table["n"].to_numpy(), table["component"].to_numpy()
        found = [np.zeros((0, 2), np.int64)]
        for lo in range(0, len(left), 256):
            part = left[lo : lo + 256]
            if not len(right):
                break
            shared = shared_counts([diffs[k] for k in part], [diffs[k] for k in right])
            size = np.array([len(d) for d in diffs])
            apart = size[part][:, None] + size[right][None, :] - 2 * shared
            total = n[part][:, None] + n[right][None, :]
            # 100 * intersection >= percent * union, with twice both on either side
            like = 100 * (total - apart) >= percent * (total + apart)
            like &= component[part][:, None] != component[right][None, :]
            a, b = np.nonzero(like)
            if len(a):
                found.append(joined(np.stack((component[part][a], component[right][b]), axis=1)))
        links = joined(np.concatenate(found)) if len(found) > 1 else found[0]
        links = links[links[:, 0] != links[:, 1]]
        return pa.table({"a": pa.array(links[:, 0], pa.int64()), "b": pa.array(links[:, 1], pa.int64())})

    return rows.groupBy("hub", "i", "j").applyInArrow(match, "a long, b long")


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component) of all linked nodes; the component is the least node that can be reached."""
    both = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges, last, n = scratch.put(both, f"{name}-0"), None, 0
    while True:
        # Large star: each node's greater neighbours go to its least neighbour or itself.
        mirrored = edges.union(edges.select("v", "u"))
        least = mirrored.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = mirrored.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: each node and its lesser neighbours go to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        n += 1
        edges = scratch.put(small.filter("u <> v").distinct(), f"{name}-{n}")
        scratch.drop(f"{name}-{n - 1}")
        state = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == last:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        last = state


def near_duplicates(
    docs: DataFrame, percent: int = 80, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id, kept), one row per row of `docs`."""
    scratch = Scratch(docs.sparkSession, "nearcopy")
    docs = texts(docs, id_col, text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = scratch.put(signatures(docs, width, bands, rows), "signed")
    sized = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    same_set = ["n_shingles", "s1", "s2"]
    classes = sized.groupBy(*same_set).agg(F.min(F.struct("doc_id", "bands")).alias("least"))
    classes = scratch.put(classes.select(*same_set, F.col("least.doc_id").alias("node"), F.col("least.bands").alias("bands")), "classes")

    keys = classes.select("node", "n_shingles", F.posexplode("bands").alias("band", "key"))
    shared = keys.groupBy("band", "key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    members = scratch.put(keys.join(shared, ["band", "key"]), "members")
    hubs = members.filter("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    nodes = members.select("node").distinct()
    texts_of = docs.withColumnRenamed("doc_id", "node").join(nodes, "node", "left_semi")
    sets = scratch.put(sets_of(texts_of, width).distinct(), "sets")
    star = scratch.put(compared(hubs, sets, percent), "star")
    scratch.drop("members", "sets")
    links = star.filter("linked").select("a", "b")
    linked = components(links, scratch, "linked")

    # Groups of one hub that still hold several components.
    own = star.select(F.col("b").alias("hub"), F.col("b").alias("node"), F.col("n_b").alias("n"), F.lit(b"").alias("diff")).distinct()
    rows = star.select(F.col("b").alias("hub"), F.col("a").alias("node"), F.col("n_a").alias("n"), "diff").unionByName(own)
    rows = rows.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = rows.groupBy("hub").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    rows = scratch.put(rows.join(mixed.select("hub"), "hub"), "mixed")
    links = scratch.put(links.unionByName(across_components(rows, percent, scratch)).unionByName(linked.select(F.col("node").alias("a"), F.col("component").alias("b"))), "links")
    scratch.drop("star", "mixed")
    groups = components(links, scratch, "groups").select(F.col("node").alias("class_id"), "component")

    out = signed.join(classes.select(*same_set, F.col("node").alias("class_id")), same_set, "left")
    out = out.join(groups, "class_id", "left").withColumn("class_id", F.coalesce("class_id", "doc_id"))
    component = F.coalesce("component", "class_id")
    return out.select("doc_id", "n_shingles", "class_id", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
