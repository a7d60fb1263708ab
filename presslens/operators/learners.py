"""The five classifiers, tuning, importance and prediction."""

from __future__ import annotations

import math
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.classification import LinearSVC, NaiveBayes
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions.text import gram_array
from presslens.operators import boosting, embeddings
from presslens.operators.counts import text_bytes
from presslens.operators.embeddings import bucketed
from presslens.operators.forest import SparseForest, fit_all, stored_values
from presslens.operators.joins import lookup_join
from presslens.operators.metrics import hamming_loss
from presslens.operators.split import cv_folds
from presslens.session import materialise, spread

# Fixed values of the production and research forests, the embedding model and the tuning grids.
RF_TREES = 500
RF_MIN_NODE = 20
RF_RESEARCH_MTRY, RF_RESEARCH_MIN_NODE = 10, 10
TUNE_MTRY = [8, 16, 25, 30]
TUNE_FOLDS, TUNE_REPEATS = 10, 3
EMBED = {"dim": 100, "lr": 1.0, "epoch": 50, "word_ngrams": 5, "min_count": 3}
EMBED_GRID = [
    {"dim": 300, "lr": 0.25, "epoch": 100, "word_ngrams": 3},
    {"dim": 300, "lr": 0.25, "epoch": 100, "word_ngrams": 3},
    {"dim": 100, "lr": 0.25, "epoch": 100, "word_ngrams": 3},
    {"dim": 100, "lr": 1.0, "epoch": 100, "word_ngrams": 5},
    {"dim": 100, "lr": 0.05, "epoch": 500, "word_ngrams": 3},
    {"dim": 100, "lr": 0.05, "epoch": 300, "word_ngrams": 6},
]
SEED = 1234
# The greatest depth that MLlib trees may have.
DEPTH = 30


def mtry(features: int, factor: int = 2) -> int:
    """Predictors tried per split: factor * floor(sqrt(p)), at most p."""
    return max(1, min(features, factor * math.floor(math.sqrt(features))))


def random_forest(
    features: int, trees: int = RF_TREES, tried: int | None = None, min_node: int = RF_MIN_NODE, depth: int = DEPTH
) -> SparseForest:
    """Gini forest. MLlib's least node size holds per child, so the production value is halved.

    `depth` is MLlib's own limit on the depth of a tree, which it cannot do without.
    """
    return SparseForest(
        labelCol="label",
        featuresCol="features",
        impurity="gini",
        numTrees=trees,
        featureSubsetStrategy=str(tried or mtry(features)),
        minInstancesPerNode=max(1, min_node // 2),
        maxDepth=depth,
        seed=SEED,
        maxMemoryInMB=1024,
    )


def random_forest_baseline(features: int, trees: int = RF_TREES) -> SparseForest:
    return random_forest(features, trees, mtry(features, 1), 1)


def random_forest_research(features: int, trees: int = RF_TREES) -> SparseForest:
    return random_forest(features, trees, min(features, RF_RESEARCH_MTRY), RF_RESEARCH_MIN_NODE)


def linear_svm(rows: int, cost: float = 1.0, weight_col: str | None = None) -> LinearSVC:
    """`cost` weighs the sum of the losses of `rows` rows; MLlib weighs the penalty against their mean.

    `weight_col` names the weight of each row, such as its class's (see `class_weights`).
    """
    svm = LinearSVC(labelCol="label", featuresCol="features", regParam=1.0 / (cost * max(rows, 1)), maxIter=50)
    return svm.setWeightCol(weight_col) if weight_col else svm


def class_weights(df: DataFrame, weight: float = 1.0, label: str = "label") -> DataFrame:
    """Adds `weight`: the weight of class 1, the topic's, against 1 for the others; the published value is 1."""
    return df.withColumn("weight", F.when(F.col(label) == 1, float(weight)).otherwise(1.0))


def gaussian_nb() -> NaiveBayes:
    return NaiveBayes(labelCol="label", featuresCol="features", modelType="gaussian")


def boosted_stumps(train: DataFrame, test: DataFrame, rounds: int = boosting.ROUNDS) -> DataFrame:
    """`test` as LogitBoost with `rounds` stumps predicts it, fitted on the stored values of the rows of `train`."""
    model = boosting.fit(signed_weights(train), train.select("doc_id", "label"), rounds)
    return model.predict(signed_weights(test), test.select("doc_id", "label"))


def signed_weights(rows: DataFrame) -> DataFrame:
    """(doc_id, term, weight) of the values in `features` that are not 0; those below 0 are weights of a term of their own."""
    entry = F.explode(F.arrays_zip(F.col("vector.indices").alias("term"), F.col("vector.values").alias("weight")))
    long = rows.select("doc_id", stored_values("features").alias("vector")).select("doc_id", entry.alias("e"))
    term = F.concat(F.when(F.col("e.weight") < 0, "-").otherwise(""), F.col("e.term").cast("string"))
    return long.select("doc_id", term.alias("term"), F.abs("e.weight").alias("weight")).filter("weight <> 0")


def embedding_rows(docs: DataFrame, tokens: str = "tokens", word_ngrams: int = 5, min_count: int = 3) -> DataFrame:
    """`docs` with the buckets of its words and grams and their shares, as the embedding model takes them."""
    return bucketed(gram_words(docs, tokens, word_ngrams, min_count)).drop("words")


def gram_words(docs: DataFrame, tokens: str = "tokens", word_ngrams: int = 5, min_count: int = 3) -> DataFrame:
    """Adds `words`: the tokens that occur at least `min_count` times, and their grams of up to `word_ngrams` words."""
    counts = docs.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    common = materialise(counts.filter(F.col("n") >= min_count).select("term", F.lit(True).alias("common")), "common")
    # Dealt out by id once, texts are taken apart and put together in their tasks.
    docs = spread(docs, "doc_id", size=text_bytes(tokens))
    placed = docs.select("doc_id", F.posexplode(tokens).alias("pos", "term"))
    kept = lookup_join(placed, common, "term", "doc_id").groupBy("doc_id")
    kept = kept.agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "term"))), lambda x: x["term"]).alias("kept"))
    rows = docs.join(kept, "doc_id", "left").withColumn("kept", F.coalesce("kept", F.array().cast("array<string>")))
    grams = F.concat(*[gram_array(F.col("kept"), n) for n in range(1, word_ngrams + 1)])
    return rows.withColumn("words", grams).drop("kept")


def predict(model, df: DataFrame, keep: tuple[str, ...] = ("doc_id", "label")) -> DataFrame:
    """Predicted label, and the probability of class 1 where the model gives one."""
    out = model.transform(df)
    columns = [*keep, F.col("prediction").cast("int").cast("string").alias("predicted")]
    if "probability" in out.columns:
        columns.append(vector_to_array("probability")[1].alias("probability"))
    return out.select(*columns)


def importance(model, vocab: DataFrame) -> DataFrame:
    """Impurity importance per term; the model's vector travels as one row, of its non-zero values."""
    scores = model.featureImportances
    row = vocab.sparkSession.createDataFrame([(scores.indices.tolist(), scores.values.tolist())], "i array<int>, v array<double>")
    table = row.select(F.explode(F.arrays_zip("i", "v")).alias("x")).select(F.col("x.i").alias("term_id"), F.col("x.v").alias("importance"))
    rows = vocab.select("term", "term_id").join(table, "term_id", "left")
    return rows.withColumn("importance", F.coalesce("importance", F.lit(0.0)))


def tune(
    train: DataFrame,
    grid: list[int] = TUNE_MTRY,
    folds: int = TUNE_FOLDS,
    repeats: int = TUNE_REPEATS,
    trees: int = RF_TREES,
    min_node: int = RF_RESEARCH_MIN_NODE,
    depth: int = DEPTH,
    parallelism: int = 4,
    id_col: str = "doc_id",
) -> DataFrame:
    """Repeated cross-validation over mtry: mean accuracy of the folds per value, best first.

    The forests of all folds, repeats and values grow together, and none draws a row of its own fold. A
    forest scores the rows of its fold; in each repeat every row is scored once per value (`scored`).
    """
    rows = train
    for repeat in range(repeats):
        rows = cv_folds(rows, "label", folds, SEED + repeat, id_col).withColumnRenamed("fold", f"fold_{repeat}")
    rows = materialise(rows, "folds").cache()
    present = sorted((r["repeat"], r["fold"]) for r in _fold_sizes(rows, repeats))
    runs = [(repeat, fold, tried) for repeat, fold in present for tried in grid]
    mine = [F.when(F.col(f"fold_{repeat}") == fold, F.lit(n)) for n, (repeat, fold, _) in enumerate(runs)]
    forests = [random_forest(1, trees, tried, min_node, depth) for _, _, tried in runs]
    models = fit_all(rows, forests, F.array_compact(F.array(*mine)))

    def score(run, model):
        repeat, fold, tried = run
        right = F.count_if(F.col("prediction") == F.col("label"))
        said = model.transform(rows.filter(F.col(f"fold_{repeat}") == fold)).agg(right.alias("right"), F.count("*").alias("n")).first()
        return repeat, fold, tried, said["right"] / said["n"], said["n"]

    with ThreadPoolExecutor(parallelism) as pool:
        found = list(pool.map(score, runs, models))
    rows.unpersist()
    table = train.sparkSession.createDataFrame(found, "repeat int, fold int, mtry int, accuracy double, n long")
    facts = [F.avg("accuracy").alias("accuracy"), F.countDistinct("repeat").alias("repeats"), F.countDistinct("fold").alias("folds"), F.sum("n").alias("scored")]
    settings = {"trees": F.lit(trees), "min_node": F.lit(min_node)}
    return table.groupBy("mtry").agg(*facts).withColumns(settings).orderBy(F.desc("accuracy"), "mtry")


def _fold_sizes(rows: DataFrame, repeats: int) -> list:
    folds = F.explode(F.array(*[F.struct(F.lit(r).alias("repeat"), F.col(f"fold_{r}").alias("fold")) for r in range(repeats)]))
    return rows.select(folds.alias("x")).groupBy("x.repeat", "x.fold").agg(F.count("*").alias("n")).collect()


def grid_eval(docs: DataFrame, configs: list[dict] = EMBED_GRID, min_count: int = EMBED["min_count"], parallelism: int = 3) -> DataFrame:
    """One row per configuration with its Hamming loss; `docs` has tokens, label and is_train."""
    lengths = sorted({config["word_ngrams"] for config in configs})
    words = {n: materialise(embedding_rows(docs, "tokens", n, min_count), f"grams-{n}") for n in lengths}

    def run(number, config):
        rows = words[config["word_ngrams"]]
        model = embeddings.train(rows.filter("is_train"), config["dim"], config["lr"], config["epoch"])
        said = model.predict(rows.filter("NOT is_train"))
        loss = hamming_loss(said, "label", "predicted").first()["hamming_loss"]
        return number, float(loss), config["dim"], config["lr"], config["epoch"], config["word_ngrams"]

    with ThreadPoolExecutor(parallelism) as pool:
        found = list(pool.map(run, range(1, len(configs) + 1), configs))
    schema = "model_n int, ham_loss double, dim int, lr double, epoch int, word_ngrams int"
    return docs.sparkSession.createDataFrame(found, schema)


def gaussian_moments(weights: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Mean and variance per class and term, absent weights counted as zeros."""
    sizes = labels.groupBy("label").agg(F.count("*").alias("docs"))
    sums = (
        weights.join(labels, id_col)
        .groupBy("label", "term")
        .agg(F.sum("weight").alias("s1"), F.sum(F.col("weight") * F.col("weight")).alias("s2"))
    )
    mean = F.col("s1") / F.col("docs")
    variance = F.col("s2") / F.col("docs") - mean * mean
    return sums.join(sizes, "label").select("label", "term", mean.alias("mean"), variance.alias("variance"))

