"""Random forests on sparse rows: all trees grow a level at a time from histograms of the stored entries.

MLlib's learner turns every row into one number per feature, present or not. Here a row keeps only the
entries it has. Values are binned once, at most 32 bins a feature with 0 as bin 0; blocks of rows stay
cached with the node that each row is at in each tree. A level is one job: a task counts the classes per
(node, feature, bin) of its block's entries, for the features that the node tries; the counts meet per
tree, rows without a feature being the rest of the node; the driver gets one split per node. The result
is MLlib's own model, in its saved form.
"""

from __future__ import annotations

import json
import math
import pickle
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.operators.joins import lookup_join
from presslens.session import materialise, new_path

BINS = 32
#: Rows of one block; a task holds a few blocks at a time.
BLOCK_ROWS = 2048
#: Shares of a Poisson distribution of mean 1: how often a row is drawn for a tree.
DRAWS = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])
BLOCK = "block binary, nodes binary"
FACTS = ("row", "label", "weight", "out")


class SparseForest(RandomForestClassifier):
    """MLlib's forest and its settings, grown on sparse rows."""

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        return fit(dataset, self)


# ---- rows to blocks ------------------------------------------------------------------------------


def stored_values(features: str) -> Column:
    """Indices and values that a vector, sparse or dense, holds."""
    stored = F.unwrap_udt(features)
    # a dense vector has values only
    return F.when(stored["type"] == 0, F.struct(stored["indices"].alias("indices"), stored["values"].alias("values"))).otherwise(
        F.struct(F.sequence(F.lit(0), F.size(stored["values"]) - 1).alias("indices"), stored["values"].alias("values"))
    )


def binned(rows: DataFrame, bins: int = BINS) -> tuple[DataFrame, DataFrame]:
    """((row, label, weight, out, entries of (feature, bin)), the written (feature, cuts, zero)).

    `rows`: (row, label, weight, out, features). Cuts are 0 and quantiles of the values that are not 0. The bin
    of a value is the number of cuts below it, less those below 0 (`zero`).
    """
    entry = F.explode_outer(F.arrays_zip(F.col("vector.indices").alias("feature"), F.col("vector.values").alias("value")))
    long = rows.select(*FACTS, stored_values("features").alias("vector")).select(*FACTS, entry.alias("e"))
    long = long.select(*FACTS, F.when(F.col("e.value") != 0, F.col("e.feature")).alias("feature"), F.col("e.value").alias("value"))
    shares = [k / (bins - 1) for k in range(1, bins - 1)]
    cuts = long.filter("feature IS NOT NULL").groupBy("feature").agg(F.percentile_approx("value", shares, 10_000).alias("q"))
    cuts = cuts.select("feature", F.array_sort(F.array_union(F.array(F.lit(0.0)), "q")).alias("cuts"))
    cuts = materialise(cuts.withColumn("zero", F.size(F.filter("cuts", lambda c: c < 0))), "cuts")
    place = F.size(F.filter("cuts", lambda c: c < F.col("value"))) - F.col("zero")
    placed = lookup_join(long, cuts, "feature", "row", "left")
    pair = F.when(F.col("feature").isNotNull(), F.struct("feature", place.alias("bin")))
    packed = placed.groupBy(*FACTS).agg(F.sort_array(F.collect_list(pair)).alias("entries"))
    return packed, cuts


def blocks_of(packed: DataFrame, forest_of: np.ndarray, bagged: np.ndarray, features: int, seed: int) -> DataFrame:
    """One row per block: its rows' entries by feature, labels, weights and draws, and each tree's node of each row.

    `forest_of`, `bagged`: the forest of each tree, and whether it draws rows. A tree of a forest in a row's
    `out` never draws the row.
    """
    trees = len(forest_of)

    def pack(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(start, BLOCK_ROWS)
                rows = batch.column("row").to_numpy().astype(np.uint64)
                lists, out = batch.column("entries"), batch.column("out")
                pairs = lists.flatten()
                row = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
                feature = pairs.field(0).to_numpy(zero_copy_only=False)
                order = np.argsort(feature, kind="stable")
                # draws depend on the row and the tree only, so a block that is made again is the same
                mixed = np.arange(trees, dtype=np.uint64)[:, None] + rows * np.uint64(trees)
                draws = np.where(bagged[:, None], np.searchsorted(DRAWS, _uniform(mixed, seed)), 1).astype(np.uint8)
                for forest, left_out in zip(out.flatten().to_pylist(), np.repeat(np.arange(len(rows)), np.diff(out.offsets.to_numpy())), strict=True):
                    draws[forest_of == forest, left_out] = 0
                block = {
                    "at": np.concatenate([[0], np.cumsum(np.bincount(feature, minlength=features))]).astype(np.int32),
                    "row": row[order],
                    "bin": pairs.field(1).to_numpy(zero_copy_only=False)[order].astype(np.int8),
                    "label": batch.column("label").to_numpy().astype(np.int64),
                    "weight": batch.column("weight").to_numpy(),
                    "draws": draws,
                }
                nodes = np.where(draws > 0, 0, -1).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"block": [pickle.dumps(block, 5)], "nodes": [nodes.tobytes()]})

    return packed.mapInArrow(pack, BLOCK)


def _uniform(x: np.ndarray, seed: int) -> np.ndarray:
    """Numbers in [0, 1) that look random, by the finisher of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


# ---- one level -----------------------------------------------------------------------------------


def draw(seed: int, tree: int, depth: int, nodes: int, features: int) -> tuple[int, np.ndarray]:
    """(step, first place of each node), by which `places` says what the nodes of a level try.

    Places are a random order of the features, multiplied by a random unit modulo their number for each
    tree and level; a node tries the features of the places from its first on. So every node tries the same
    number of features, drawn without replacement.
    """
    rng = np.random.default_rng([seed, tree, depth])
    step = 1
    while features > 2:
        step = int(rng.integers(1, features))
        if math.gcd(step, features) == 1:
            break
    return step, rng.integers(0, features, nodes)


def move(batches, splits):
    """Blocks with every row at its node of the next level; -1 where that is a leaf."""
    for batch in batches:
        for raw, nodes in zip(batch.column("block").to_pylist(), batch.column("nodes").to_pylist(), strict=True):
            block = pickle.loads(raw)
            rows = len(block["label"])
            nodes = np.frombuffer(nodes, np.int32).reshape(-1, rows).copy()
            own = np.repeat(np.arange(len(block["at"]) - 1, dtype=np.int64), np.diff(block["at"])) * rows + block["row"]
            for tree, (feature, cut, left, right) in enumerate(splits.value):
                there = np.flatnonzero(nodes[tree] >= 0)
                if not len(there):
                    continue
                node = nodes[tree, there]
                wanted = feature[node].astype(np.int64) * rows + there  # a leaf has feature -1, and no child
                at = np.minimum(np.searchsorted(own, wanted), max(len(own) - 1, 0))
                bins = np.where(own[at] == wanted, block["bin"][at], 0) if len(own) else np.zeros(len(there), np.int8)
                nodes[tree, there] = np.where(bins > cut[node], right[node], left[node])
            yield pa.RecordBatch.from_pydict({"block": [raw], "nodes": [nodes.tobytes()]})


def count(batches, level):
    """Per tree, the weight of each class and the rows drawn, of (node, feature, bin) and of the nodes."""
    seed, depth, features, classes = (level.value[k] for k in ("seed", "depth", "features", "classes"))
    order = np.random.default_rng(seed).permutation(features)
    at_place = np.argsort(order)
    for batch in batches:
        for raw, nodes in zip(batch.column("block").to_pylist(), batch.column("nodes").to_pylist(), strict=True):
            block = pickle.loads(raw)
            label, weight, entry_row, entry_bin = (block[k] for k in ("label", "weight", "row", "bin"))
            nodes = np.frombuffer(nodes, np.int32).reshape(-1, len(label))
            rows = len(label)
            entry_feature = np.repeat(np.arange(features, dtype=np.int32), np.diff(block["at"]))
            by_row = np.argsort(entry_row, kind="stable")
            row_at = np.concatenate([[0], np.cumsum(np.bincount(entry_row, minlength=rows))])
            row_place = order[entry_feature[by_row]]
            found = []
            for tree, (active, mtry) in enumerate(zip(level.value["nodes"], level.value["mtry"], strict=True)):
                node = nodes[tree]
                there = np.flatnonzero(node >= 0)
                if not active or not len(there):
                    continue
                step, first = draw(seed, tree, depth, active, features)
                # A node of many rows reads the entries of the features it tries, one of few the entries of its rows.
                wide = np.bincount(node[there], minlength=active) * features > mtry * rows
                held = np.flatnonzero(wide)
                tried = at_place[(first[held, None] + np.arange(mtry)) % features * pow(step, -1, features) % features].ravel()
                e, of = _ranges(block["at"][tried], block["at"][tried + 1])
                at = np.repeat(held, mtry)[of]
                keep = node[entry_row[e]] == at
                e, at = e[keep], at[keep]
                few = there[~wide[node[there]]]
                own, of = _ranges(row_at[few], row_at[few + 1])
                at_own = node[few].astype(np.int64)[of]
                ahead = row_place[own] * step
                ahead -= ahead // features * features
                ahead -= first[at_own]
                keep = np.flatnonzero(((ahead >= 0) & (ahead < mtry)) | (ahead < mtry - features))
                e, at = np.concatenate([e, by_row[own[keep]]]), np.concatenate([at, at_own[keep]])
                key = (at * features + entry_feature[e]) * (2 * BINS) + entry_bin[e] + BINS
                keys, inverse = np.unique(key, return_inverse=True)
                row, drawn = entry_row[e], block["draws"][tree].astype(np.float64)
                stats = _sums(inverse, len(keys), label[row], drawn[row], weight[row], classes)
                totals = _sums(node[there], active, label[there], drawn[there], weight[there], classes)
                found.append((tree, pickle.dumps((keys, stats.astype(_small(stats)), totals), 5)))
            if found:
                yield pa.RecordBatch.from_pydict({"tree": pa.array([t for t, _ in found], pa.int32()), "counts": [c for _, c in found]})


def _ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each start up to its end, and the range that each is of."""
    sizes = (end - start).astype(np.int64)
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) + (start - (np.cumsum(sizes) - sizes))[of], of


def _sums(place, size, label, drawn, weight, classes):
    """(size, classes + 1): weight of each class, then rows drawn."""
    by_class = np.bincount(place * classes + label, drawn * weight, size * classes).reshape(size, classes)
    return np.column_stack([by_class, np.bincount(place, drawn, size)])


def _small(stats: np.ndarray):
    """The narrowest type that holds the sums exactly."""
    if not stats.size or (stats % 1).any() or stats.max() >= 1 << 16:
        return np.float64
    return np.uint8 if stats.max() < 256 else np.uint16


def choose(batches, level):
    """Per tree, the best split of each node: feature (-1: none), bin, gain, and the left side's sums."""
    parts: dict[int, list] = {}
    for batch in batches:
        for tree, counts in zip(batch.column("tree").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            parts.setdefault(tree, []).append(counts)
    for tree in sorted(parts):
        loaded = [pickle.loads(p) for p in parts.pop(tree)]
        totals = np.sum([t for _, _, t in loaded], axis=0)
        keys, inverse = np.unique(np.concatenate([k for k, _, _ in loaded]), return_inverse=True)
        every = np.concatenate([s.astype(np.float64) for _, s, _ in loaded])
        sums = np.column_stack([np.bincount(inverse, every[:, c], len(keys)) for c in range(every.shape[1])])
        found = best_splits(keys, sums, totals, level.value, level.value["min_rows"][tree], level.value["min_weight"][tree])
        yield pa.RecordBatch.from_pydict({"tree": pa.array([tree], pa.int32()), "found": [pickle.dumps((totals, *found), 5)]})


def gini(stats: np.ndarray) -> np.ndarray:
    """Gini impurity of rows of class weights; 0 where there is no weight."""
    total = stats.sum(axis=1)
    return np.where(total > 0, 1 - (stats**2).sum(axis=1) / np.maximum(total, 1e-300) ** 2, 0.0)


def best_splits(keys: np.ndarray, sums: np.ndarray, totals: np.ndarray, level: dict, min_rows: int, min_weight: float):
    """(feature, bin, gain, left sums) per node. Of equal gains the first feature's lowest cut wins."""
    classes, nodes, features = level["classes"], len(totals), level["features"]
    feature_of, cut, gain = np.full(nodes, -1, np.int32), np.zeros(nodes, np.int8), np.zeros(nodes)
    left_of = np.zeros_like(totals)
    if not len(keys):
        return feature_of, cut, gain, left_of
    group = keys // (2 * BINS)
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    # rows of the node without the feature are its bin 0, which no entry has
    rest = totals[group[start] // features] - np.add.reduceat(sums, start, axis=0)
    keys = np.concatenate([keys, group[start] * (2 * BINS) + BINS])
    order = np.argsort(keys, kind="stable")
    keys, sums = keys[order], np.concatenate([sums, rest])[order]
    some = sums[:, -1] > 0.5
    keys, sums = keys[some], sums[some]
    group = keys // (2 * BINS)
    start = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.concatenate([start, [len(keys)]]))
    run = np.cumsum(sums, axis=0)
    left = run - np.repeat(run[start] - sums[start], size, axis=0)
    node = group // features
    right = totals[node] - left
    ok = (np.minimum(left[:, -1], right[:, -1]) > min_rows - 0.5) & (right[:, -1] > 0.5)
    lw, rw = left[:, :classes].sum(axis=1), right[:, :classes].sum(axis=1)
    ok &= np.minimum(lw, rw) >= max(min_weight - 1e-9, 1e-12)
    at = np.flatnonzero(ok)
    node, left, right, lw, rw = node[at], left[at], right[at], lw[at], rw[at]
    won = gini(totals[:, :classes])[node] - (lw * gini(left[:, :classes]) + rw * gini(right[:, :classes])) / (lw + rw)
    best = np.lexsort((at, -np.round(won, 12), node))
    first = best[np.concatenate([[True], node[best][1:] != node[best][:-1]])] if len(best) else best
    first = first[won[first] > 1e-12]
    here = keys[at[first]]
    feature_of[node[first]] = here // (2 * BINS) % features
    cut[node[first]] = here % (2 * BINS) - BINS
    gain[node[first]], left_of[node[first]] = won[first], left[first]
    return feature_of, cut, gain, left_of


# ---- the forest ----------------------------------------------------------------------------------


def features_tried(strategy: str, features: int) -> int:
    """The features that a node tries: a number, or MLlib's names for one."""
    named = {"all": features, "auto": math.ceil(math.sqrt(features)), "sqrt": math.ceil(math.sqrt(features))}
    return max(1, min(features, named[strategy] if strategy in named else int(strategy)))


def fit(dataset: DataFrame, forest: RandomForestClassifier) -> RandomForestClassificationModel:
    """MLlib's model of `dataset` under the settings of `forest`."""
    return fit_all(dataset, [forest])[0]


def fit_all(dataset: DataFrame, forests: list[RandomForestClassifier], out: Column | None = None) -> list[RandomForestClassificationModel]:
    """The models of several forests, grown together. They share columns, seed and depth of the first.

    `out`: the numbers of the forests that a row is left out of.
    """
    spark, lead = dataset.sparkSession, forests[0]
    forest_of = np.repeat(np.arange(len(forests)), [f.getNumTrees() for f in forests])
    bagged = np.array([forests[f].getNumTrees() > 1 and forests[f].getBootstrap() for f in forest_of])
    weight = F.col(lead.getWeightCol()).cast("double") if lead.isDefined("weightCol") and lead.getWeightCol() else F.lit(1.0)
    rows = dataset.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(lead.getLabelCol()).cast("double").alias("label"),
        weight.alias("weight"),
        (F.array().cast("array<int>") if out is None else out).alias("out"),
        F.col(lead.getFeaturesCol()).alias("features"),
    )
    # written, so that a row's number stays the same
    rows = materialise(rows, "forest-rows")
    stored = F.unwrap_udt("features")
    width = F.max(F.when(stored["type"] == 0, stored["size"]).otherwise(F.size(stored["values"])))
    facts = rows.agg(F.count("*").alias("rows"), F.sum("weight").alias("weight"), F.max("label").alias("label"), width.alias("features")).first()
    if not facts["rows"]:
        raise ValueError("a forest needs rows to fit")
    features, depths = max(1, facts["features"]), lead.getMaxDepth()
    level = {
        "seed": lead.getSeed(),
        "features": features,
        "classes": max(2, int(facts["label"]) + 1),
        "mtry": [features_tried(forests[f].getFeatureSubsetStrategy(), features) for f in forest_of],
        "min_rows": [forests[f].getMinInstancesPerNode() for f in forest_of],
        "min_weight": [forests[f].getMinWeightFractionPerNode() * facts["weight"] for f in forest_of],
    }
    packed, cuts = binned(rows)
    parts = max(spark.sparkContext.defaultParallelism, -(-facts["rows"] // BLOCK_ROWS))
    packed = materialise(packed.repartition(parts, "row"), "forest-entries")
    state = blocks_of(packed, forest_of, bagged, features, level["seed"]).persist(StorageLevel.MEMORY_AND_DISK)
    grown = [Tree() for _ in forest_of]
    for depth in range(depths + 1):
        said = _level(spark, state, {**level, "depth": depth, "nodes": [t.active for t in grown]}, parts)
        splits = [t.extend(said.get(i), level["classes"], depth == depths) for i, t in enumerate(grown)]
        if not any(t.active for t in grown):
            break
        moved = state.mapInArrow(_with(move, spark.sparkContext.broadcast(splits)), BLOCK).persist(StorageLevel.MEMORY_AND_DISK)
        if depth:
            before.unpersist()
        # kept until the next level has read it
        before, state = state, moved
    state.unpersist()
    if depth:
        before.unpersist()
    with ThreadPoolExecutor(8) as pool:
        of = [[t for t, f in zip(grown, forest_of, strict=True) if f == n] for n in range(len(forests))]
        return list(pool.map(lambda n: _model(spark, forests[n], of[n], cuts, level), range(len(forests))))


def _with(step, held):
    return lambda batches: step(batches, held)


def _level(spark: SparkSession, state: DataFrame, level: dict, parts: int) -> dict:
    """What `choose` finds, per tree."""
    held = spark.sparkContext.broadcast(level)
    counted = state.mapInArrow(_with(count, held), "tree int, counts binary")
    parts = min(len(level["nodes"]), parts)
    found = counted.repartition(parts, "tree").mapInArrow(_with(choose, held), "tree int, found binary").collect()
    return {r["tree"]: pickle.loads(r["found"]) for r in found}


class Tree:
    """Nodes by level: the sums of each, its split and its children; a node's children come after it."""

    def __init__(self):
        self.sums, self.gain, self.feature, self.cut, self.left, self.right = [], [], [], [], [], []
        # the nodes of the level that may be split, by their numbers
        self.open, self.active = None, 1

    def extend(self, found, classes: int, last: bool) -> tuple:
        """Adds the children of the level's nodes; (feature, cut, left, right) to move the rows to the next level."""
        none = np.zeros(0, np.int32)
        if not self.active or found is None:
            # a tree that drew no row is one leaf
            if not self.sums:
                self._add(np.zeros(classes + 1))
            self.active = 0
            return none, none, none, none
        totals, feature, cut, gain, left = found
        if self.open is None:
            self.open = [self._add(totals[0])]
        feature = np.where(last, -1, feature)
        below = np.full((2, len(feature)), -1, np.int32)
        opened = []
        for i in np.flatnonzero(feature >= 0):
            node = self.open[i]
            self.feature[node], self.cut[node], self.gain[node] = int(feature[i]), int(cut[i]), float(gain[i])
            for side, sums in enumerate((left[i], totals[i] - left[i])):
                child = self._add(sums)
                (self.right if side else self.left)[node] = child
                if np.count_nonzero(sums[:-1] > 1e-12) > 1 and sums[-1] > 1.5:
                    below[side, i] = len(opened)
                    opened.append(child)
        self.open, self.active = opened, len(opened)
        return feature.astype(np.int32), cut, below[0], below[1]

    def _add(self, sums) -> int:
        self.sums.append(np.asarray(sums, np.float64))
        for column, value in ((self.gain, -1.0), (self.feature, -1), (self.cut, 0), (self.left, -1), (self.right, -1)):
            column.append(value)
        return len(self.sums) - 1

    def nodes(self) -> list[tuple]:
        """Nodes as MLlib stores them, with `cut` for the threshold; leaves that say the same are one, as MLlib has it."""
        stats = np.array(self.sums)
        said, impurity = stats[:, :-1].argmax(axis=1), gini(stats[:, :-1])
        feature, left, right = list(self.feature), self.left, self.right
        for i in range(len(feature) - 1, -1, -1):
            if feature[i] >= 0 and feature[left[i]] < 0 and feature[right[i]] < 0 and said[left[i]] == said[right[i]]:
                feature[i] = -1
        number, queue = {0: 0}, [0]
        for i in queue:
            for child in (left[i], right[i]) if feature[i] >= 0 else ():
                number[child] = len(queue)
                queue.append(child)
        rows = []
        for i in queue:
            inner = feature[i] >= 0
            rows.append(
                (number[i], float(said[i]), float(impurity[i]), stats[i, :-1].tolist(), int(round(stats[i, -1])),
                 self.gain[i] if inner else -1.0, number[left[i]] if inner else -1, number[right[i]] if inner else -1, feature[i], self.cut[i])
            )
        return rows


NODE = {
    "id": pa.int32(), "prediction": pa.float64(), "impurity": pa.float64(), "impurityStats": pa.list_(pa.float64()), "rawCount": pa.int64(),
    "gain": pa.float64(), "leftChild": pa.int32(), "rightChild": pa.int32(), "feature": pa.int32(), "cut": pa.int32(),
}


def _model(spark: SparkSession, forest: RandomForestClassifier, grown: list[Tree], cuts: DataFrame, level: dict) -> RandomForestClassificationModel:
    """Writes the trees in the form in which MLlib saves a forest, and loads it."""
    path, of_trees = new_path(spark, "forest"), new_path(spark, "forest-tree")
    parts = []
    for number, tree in enumerate(grown):
        columns = list(zip(*tree.nodes(), strict=True))
        arrays = [pa.array(c, t) for c, t in zip(columns, NODE.values(), strict=True)]
        parts.append(pa.Table.from_arrays([pa.array([number] * len(columns[0]), pa.int32()), *arrays], ["treeID", *NODE]))
    nodes = spark.createDataFrame(pa.concat_tables(parts))
    inner = F.col("feature") >= 0
    threshold = F.when(inner, F.array(F.get("cuts", F.col("cut") + F.col("zero")))).otherwise(F.array().cast("array<double>"))
    split = F.struct(F.col("feature").alias("featureIndex"), threshold.alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    fields = [F.col(c) for c in NODE if c not in ("feature", "cut")]
    stored = nodes.join(cuts, "feature", "left").select("treeID", F.struct(*fields, split.alias("split")).alias("nodeData"))
    stored.write.parquet(f"{path}/data")
    settings = {p.name: forest.getOrDefault(p) for p in forest.params if forest.isSet(p)}
    tree = DecisionTreeClassifier()
    tree = tree.copy({tree.getParam(k): v for k, v in settings.items() if tree.hasParam(k) and k != "bootstrap"})
    facts = _stored(spark, tree, of_trees, "DecisionTreeClassificationModel")
    trees = [(i, json.dumps({**facts, "uid": f"{facts['uid']}_{i}"}), 1.0) for i in range(len(grown))]
    spark.createDataFrame(trees, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    facts = _stored(spark, forest, new_path(spark, "forest-settings"), "RandomForestClassificationModel")
    facts |= {"numFeatures": level["features"], "numClasses": level["classes"], "numTrees": len(grown)}
    spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return RandomForestClassificationModel.load(path)


def _stored(spark: SparkSession, learner, path: str, kind: str) -> dict:
    """The settings of a learner as it saves them, for the model of class `kind`."""
    learner.save(path)
    facts = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    return {**facts, "class": f"org.apache.spark.ml.classification.{kind}"}
