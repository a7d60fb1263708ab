"""Queries over splits, metrics, model history, classifiers and neighbours."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from presslens.catalog.registry import SEED, gazetteer, query, sql_clean_delete, table
from presslens.catalog.text import WEIGHTS, weights
from presslens.functions.text import clean_delete, tokenize
from presslens.operators import bayes, boosting, embeddings, learners, metrics, neighbours, split
from presslens.operators.counts import class_share
from presslens.operators.dedupe import keep_first_by_text
from presslens.plans import training
from presslens.plans.scoring import score_batch
from presslens.session import materialise, new_path
from presslens.sinks.bundles import load_bundle, save_bundle
from presslens.streaming import flows

# The tuning query fits 120 forests on all rows; its forests have fewer trees than the production
# forest, for the time that takes, and its result says so (column trees).
TUNE_TREES = 20
# As many words as the research run asks neighbours of.
NEIGHBOUR_WORDS = 7

# ---- split ---------------------------------------------------------------------------------------

RANKED = f"""SELECT doc_id, quality, toxic, row_number() OVER (PARTITION BY quality ORDER BY md5('{SEED}:' || doc_id), doc_id) AS k,
    count(*) OVER (PARTITION BY quality) AS size FROM labels"""


@query("stratified_split", f"SELECT doc_id, quality, k <= ceil(0.7::DOUBLE * size) AS is_train FROM ({RANKED})")
def _(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return split.stratified_split(labels, "quality", 0.7, SEED)


@query("cv_folds", f"SELECT doc_id, quality, CAST((k - 1) % 10 AS INTEGER) AS fold FROM ({RANKED})")
def _(spark, sf):
    return split.cv_folds(table(spark, sf, "labels").select("doc_id", "quality"), "quality", 10, SEED)


# ---- metrics -------------------------------------------------------------------------------------


def sql_confusion(source: str = "labels", by: str = "") -> str:
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {by + ', ' if by else ''}count(*) FILTER (toxic = 0 AND quality = 0) AS tp,
        count(*) FILTER (toxic = 0 AND quality <> 0) AS fp, count(*) FILTER (toxic <> 0 AND quality = 0) AS fn,
        count(*) FILTER (toxic <> 0 AND quality <> 0) AS tn FROM {source} {group}"""


# Fixed names of the published metrics, with their closed forms.
CLOSED = {
    "Accuracy": "(tp + tn) / n",
    "Kappa": "((tp + tn) / n - e) / (1 - e)",
    "AccuracyNull": "greatest(tp + fn, fp + tn) / n",
    "Sensitivity": "tp / nullif(tp + fn, 0)",
    "Specificity": "tn / nullif(fp + tn, 0)",
    "Pos Pred Value": "tp / nullif(tp + fp, 0)",
    "Neg Pred Value": "tn / nullif(tn + fn, 0)",
    "Precision": "tp / nullif(tp + fp, 0)",
    "Recall": "tp / nullif(tp + fn, 0)",
    "F1": "2 * tp / nullif(2 * tp + fp + fn, 0)",
    "Prevalence": "(tp + fn) / n",
    "Detection Rate": "tp / n",
    "Detection Prevalence": "(tp + fp) / n",
    "Balanced Accuracy": "(tp / nullif(tp + fn, 0) + tn / nullif(fp + tn, 0)) / 2",
}
PREPARED = "SELECT *, ((tp + fp) * (tp + fn) + (fn + tn) * (fp + tn)) / (n * n) AS e FROM (SELECT *, (tp + fp + fn + tn)::DOUBLE AS n FROM conf)"


def sql_long(by: str = "") -> str:
    """`conf` to (by, metric, value) for the closed-form metrics."""
    head = by + ", " if by else ""
    rows = (f"SELECT {head}'{name}' AS metric, CAST({expr} AS DOUBLE) AS value FROM prepared" for name, expr in CLOSED.items())
    return " UNION ALL ".join(rows)


@query("confusion_counts", sql_confusion())
def _(spark, sf):
    return metrics.confusion(table(spark, sf, "labels"), "quality", "toxic")


TAIL = """list_sum(list_transform(range({k}, n + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
    + i * ln({p}) + (n - i) * ln(1 - {p}))))"""
EXACT = f"""WITH RECURSIVE conf AS ({sql_confusion()}), prepared AS ({PREPARED}),
    c AS (SELECT CAST(tp + tn AS BIGINT) AS k, CAST(tp + fp + fn + tn AS BIGINT) AS n,
      greatest(tp + fn, fp + tn) / (tp + fp + fn + tn)::DOUBLE AS p0,
      power(abs(fp - fn) - CASE WHEN fp = fn THEN 0 ELSE 1 END, 2) / (fp + fn)::DOUBLE / 2 AS x FROM conf),
    b AS (SELECT 0 AS step, 0.0::DOUBLE AS lo1, 1.0::DOUBLE AS hi1, 0.0::DOUBLE AS lo2, 1.0::DOUBLE AS hi2
      UNION ALL SELECT step + 1, CASE WHEN t1 < 0.025 THEN m1 ELSE lo1 END, CASE WHEN t1 < 0.025 THEN hi1 ELSE m1 END,
        CASE WHEN t2 < 0.975 THEN m2 ELSE lo2 END, CASE WHEN t2 < 0.975 THEN hi2 ELSE m2 END
      FROM (SELECT *, {TAIL.format(k='k', p='m1')} AS t1, {TAIL.format(k='(k + 1)', p='m2')} AS t2 FROM
        (SELECT b.*, c.*, (lo1 + hi1) / 2 AS m1, (lo2 + hi2) / 2 AS m2 FROM b, c WHERE step < 45))),
    ends AS (SELECT * FROM b WHERE step = 45),
    exact AS (SELECT 'AccuracyLower' AS metric, lo1 AS value FROM ends
      UNION ALL SELECT 'AccuracyUpper', lo2 FROM ends
      UNION ALL SELECT 'AccuracyPValue', {TAIL.format(k='k', p='p0')} FROM c
      UNION ALL SELECT 'McnemarPValue', 1 - list_sum(list_transform(range(0, 3000),
        lambda j: exp((j + 0.5) * ln(x) - x - lgamma(j + 1.5)))) FROM c)"""


@query(
    "confusion_metrics",
    f"{EXACT} SELECT metric, round(value, 6) + 0 AS value FROM ({sql_long()} UNION ALL SELECT * FROM exact)",
)
def _(spark, sf):
    counts = metrics.confusion(table(spark, sf, "labels"), "quality", "toxic")
    return metrics.melt(metrics.metrics(counts)).select("metric", (F.round("value", 6) + 0).alias("value"))


# Metrics per language stand in for several models; documents per language for the training size.
BY_LANG = f"""judged AS (SELECT l.*, d.lang AS model FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
    conf AS ({sql_confusion('judged', 'model')}), prepared AS ({PREPARED}),
    sizes AS (SELECT model, count(*) AS train_n FROM judged GROUP BY model),
    long AS (SELECT s.model, s.train_n, metric, round(value, 9) AS value FROM ({sql_long('model')}) m JOIN sizes s ON m.model = s.model)"""


def judged(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("model"))
    return table(spark, sf, "labels").join(docs, "doc_id")


def wide_by_lang(spark, sf):
    counts = metrics.confusion(judged(spark, sf), "quality", "toxic", by=("model",))
    sized = counts.withColumn("train_n", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    return metrics.metrics(sized)


def long_by_lang(spark, sf):
    long = metrics.melt(wide_by_lang(spark, sf)).withColumn("value", F.round("value", 9))
    return long.filter(F.col("metric").isin(list(CLOSED)))


@query("melt_metrics", f"WITH {BY_LANG} SELECT model, train_n, metric, value FROM long")
def _(spark, sf):
    return long_by_lang(spark, sf)


@query(
    "metric_filter",
    f"WITH {BY_LANG} SELECT model, metric, value FROM long WHERE metric IN ('Accuracy', 'Kappa', 'F1', 'Precision', 'Recall')",
)
def _(spark, sf):
    return long_by_lang(spark, sf).filter(F.col("metric").isin(metrics.CARD_METRICS)).select("model", "metric", "value")


@query(
    "pivot_wider_metrics",
    f"""WITH {BY_LANG} SELECT model, max(value) FILTER (metric = 'Accuracy') AS "Accuracy", max(value) FILTER (metric = 'Kappa') AS "Kappa",
    max(value) FILTER (metric = 'F1') AS "F1", max(value) FILTER (metric = 'Precision') AS "Precision",
    max(value) FILTER (metric = 'Recall') AS "Recall" FROM long GROUP BY model""",
)
def _(spark, sf):
    return metrics.pivot_metrics(long_by_lang(spark, sf), metrics.CARD_METRICS, ["model"])


@query(
    "learning_curve",
    f"""WITH {BY_LANG} SELECT model, train_n, max(value) FILTER (metric = 'F1') AS "F1", max(value) FILTER (metric = 'Kappa') AS "Kappa"
    FROM long GROUP BY model, train_n""",
)
def _(spark, sf):
    return metrics.learning_curve(long_by_lang(spark, sf))


@query("max_and_unique", f"WITH {BY_LANG} SELECT max(train_n) AS max_train_n FROM long")
def _(spark, sf):
    return long_by_lang(spark, sf).agg(F.max("train_n").alias("max_train_n"))


@query(
    "model_comparison",
    f"""WITH conf AS ({sql_confusion()}), prepared AS ({PREPARED}), a AS ({sql_long()}), flipped AS (SELECT quality AS toxic, toxic AS quality FROM labels),
    conf2 AS ({sql_confusion('flipped')}), prepared2 AS ({PREPARED.replace('FROM conf', 'FROM conf2')}), b AS ({sql_long().replace('prepared', 'prepared2')})
    SELECT metric, round(value, 9) AS value, model, '2024-01-31' AS date, (SELECT count(*) FROM labels) AS train_n,
    round((SELECT avg(quality) FROM labels), 9) AS class_share
    FROM (SELECT *, 'toxic as prediction' AS model FROM a UNION ALL SELECT *, 'quality as prediction' FROM b)""",
)
def _(spark, sf):
    labels = table(spark, sf, "labels")
    facts = class_share(labels, "quality").first()
    results = {
        "toxic as prediction": metrics.melt(metrics.metrics(metrics.confusion(labels, "quality", "toxic"))),
        "quality as prediction": metrics.melt(metrics.metrics(metrics.confusion(labels, "toxic", "quality"))),
    }
    rows = metrics.compare(results, "2024-01-31", facts["train_n"], round(facts["class_share"], 9))
    rows = rows.filter(F.col("metric").isin(list(CLOSED))).withColumn("train_n", F.col("train_n").cast("bigint"))
    return rows.withColumn("value", F.round("value", 9))


# The newest earlier record is the language last in order; the new model is the whole table.
@query(
    "champion_challenger",
    f"""WITH {BY_LANG}, new AS (SELECT 2 * tp / (2 * tp + fp + fn)::DOUBLE AS f1 FROM ({sql_confusion()})),
    old AS (SELECT arg_max(value, model) AS previous FROM long WHERE metric = 'F1')
    SELECT round(f1, 9) AS model_f1, previous, f1 > previous AS promoted FROM new, old""",
)
def _(spark, sf):
    long = metrics.melt(metrics.metrics(metrics.confusion(table(spark, sf, "labels"), "quality", "toxic")))
    new = metrics.model_card(long).select("model_f1")
    wide = metrics.pivot_metrics(long_by_lang(spark, sf), ["F1"], ["model"])
    history = wide.select(F.col("F1").alias("model_f1"), F.col("model").alias("last_changed"))
    return metrics.promote(new, history).withColumn("model_f1", F.round("model_f1", 9))


@query("hamming_loss", "SELECT round(avg(CASE WHEN quality = toxic THEN 0.0 ELSE 1.0 END), 9) AS hamming_loss FROM labels")
def _(spark, sf):
    loss = metrics.hamming_loss(table(spark, sf, "labels"), "quality", "toxic")
    return loss.select(F.round("hamming_loss", 9).alias("hamming_loss"))


# ---- neighbours ----------------------------------------------------------------------------------


@query(
    "embedding_neighbours",
    """WITH parts AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
    means AS (SELECT label, dim, avg(x) AS x FROM parts GROUP BY label, dim),
    q AS (SELECT label AS query_id, list(x ORDER BY dim) AS v FROM means GROUP BY label),
    s AS (SELECT query_id, vec_id, round(list_cosine_similarity(v, embedding::DOUBLE[]), 6) AS cosine FROM q, embeddings)
    SELECT * FROM (SELECT CAST(query_id AS BIGINT) AS query_id, vec_id, cosine,
      CAST(row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) AS INTEGER) AS rank FROM s) WHERE rank <= 12""",
)
def _(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return neighbours.nearest(vectors, neighbours.centroids(vectors, "label"), 12)


@query("embedding_index_neighbours")
def _(spark, sf):
    """The neighbours of the same centroids by the index; a test holds its recall against the exact ones."""
    vectors = table(spark, sf, "embeddings")
    found = neighbours.ProjectionIndex.build(vectors).nearest(neighbours.centroids(vectors, "label"), 12)
    return found.withColumnRenamed("id", "vec_id")


# ---- classifiers ---------------------------------------------------------------------------------

_fitted: dict = {}


def corpus(spark, sf):
    """Labelled documents, one row per (text, label)."""
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    rows = table(spark, sf, "documents").select("doc_id", "text").join(labels, "doc_id")
    return keep_first_by_text(rows, "text", ["label"], ["doc_id"])


def matrix(spark, sf):
    """The training matrix, written once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf, "matrix")
    if key not in _fitted:
        _fitted[key] = training.training_matrix(corpus(spark, sf), gazetteer(spark), language=None)
    return _fitted[key]


def bundle(spark, sf):
    key = (spark.sparkContext.applicationId, sf, "bundle")
    if key not in _fitted:
        _fitted[key] = training.fit(matrix(spark, sf), fitted_on="2024-01-31")
    return _fitted[key]


def held_out(spark, sf, learner):
    m = matrix(spark, sf)
    model = learner(m).fit(learners.class_weights(m.rows.filter("is_train")))
    return learners.predict(model, m.rows.filter("NOT is_train"))


@query("rf_train")
def _(spark, sf):
    return bundle(spark, sf).card


@query("rf_baseline")
def _(spark, sf):
    return held_out(spark, sf, lambda m: learners.random_forest_baseline(m.size))


@query("rf_research")
def _(spark, sf):
    return held_out(spark, sf, lambda m: learners.random_forest_research(m.size))


@query("rf_importance")
def _(spark, sf):
    b = bundle(spark, sf)
    return learners.importance(b.model.stages[-1], b.tfidf.table)


@query("svm_linear")
def _(spark, sf):
    return held_out(spark, sf, lambda m: learners.linear_svm(m.rows.filter("is_train").count(), weight_col="weight"))


def weighted_split(spark, sf):
    """(training labels, the others, weights in long form), written once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf, "weighted")
    if key not in _fitted:
        labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
        rows = materialise(split.stratified_split(labels, "label", 0.7, SEED), "split")
        long = materialise(weights(spark, sf)[1].select("doc_id", "term", "weight"), "weights")
        _fitted[key] = rows.filter("is_train").drop("is_train"), rows.filter("NOT is_train").drop("is_train"), long
    return _fitted[key]


VARIANCE = "greatest(var, 0) + eps"


@query(
    "nb_gaussian",
    f"""WITH {WEIGHTS}, split AS (SELECT doc_id, quality, k <= ceil(0.7::DOUBLE * size) AS is_train FROM ({RANKED})),
    sizes AS (SELECT quality, count(*)::DOUBLE AS docs FROM split WHERE is_train GROUP BY quality),
    own AS (SELECT w.term, w.weight, s.quality FROM weights w JOIN split s ON w.doc_id = s.doc_id WHERE s.is_train),
    sums AS (SELECT term, quality, sum(weight) AS s1, sum(weight * weight) AS s2 FROM own GROUP BY term, quality),
    moments AS (SELECT t.term, z.quality, coalesce(s1, 0) / docs AS mean, coalesce(s2, 0) / docs - power(coalesce(s1, 0) / docs, 2) AS var
      FROM (SELECT DISTINCT term FROM own) t CROSS JOIN sizes z LEFT JOIN sums s ON s.term = t.term AND s.quality = z.quality),
    smooth AS (SELECT {bayes.SMOOTHING}::DOUBLE * max(greatest(var, 0)) AS eps FROM moments),
    base AS (SELECT quality, sum(-0.5::DOUBLE * ln(2 * pi() * ({VARIANCE})) - mean * mean / (2 * ({VARIANCE}))) AS b FROM moments, smooth GROUP BY quality),
    more AS (SELECT w.doc_id, m.quality, sum(weight * (2 * mean - weight) / (2 * ({VARIANCE}))) AS s
      FROM weights w JOIN moments m ON w.term = m.term, smooth GROUP BY w.doc_id, m.quality),
    scores AS (SELECT p.doc_id, p.quality AS label, z.quality AS class, coalesce(s, 0) + b + ln(docs / (SELECT sum(docs) FROM sizes)) AS score
      FROM split p CROSS JOIN sizes z JOIN base ON base.quality = z.quality
      LEFT JOIN more ON more.doc_id = p.doc_id AND more.quality = z.quality WHERE NOT p.is_train)
    SELECT doc_id, label, CAST(class AS VARCHAR) AS predicted FROM
    (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, class) AS r FROM scores) WHERE r = 1""",
)
def _(spark, sf):
    train, test, long = weighted_split(spark, sf)
    return bayes.gaussian_predictions(long, train, test)


@query(
    "nb_gaussian_moments",
    """WITH w AS (SELECT quality AS label, d.source AS term, d.n_chars::DOUBLE AS weight, d.doc_id FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
    sizes AS (SELECT quality AS label, count(*) AS docs FROM labels GROUP BY quality)
    SELECT w.label, term, round(sum(weight) / any_value(docs), 6) AS mean,
    round(sum(weight * weight) / any_value(docs) - power(sum(weight) / any_value(docs), 2), 2) AS variance
    FROM w JOIN sizes s ON w.label = s.label GROUP BY w.label, term""",
)
def _(spark, sf):
    long = table(spark, sf, "documents").select(
        "doc_id", F.col("source").alias("term"), F.col("n_chars").cast("double").alias("weight")
    )
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    moments = learners.gaussian_moments(long, labels)
    return moments.withColumns({"mean": F.round("mean", 6), "variance": F.round("variance", 2)})


@query("logit_boost")
def _(spark, sf):
    train, test, long = weighted_split(spark, sf)
    return boosting.fit(long, train).predict(long, test)


@query("model_baselines")
def _(spark, sf):
    """The 18 metrics of the five models on one split, with date, training size and class share."""
    m = matrix(spark, sf)
    facts = class_share(m.rows.filter("is_train"), "label").first()
    results = training.baselines(m, texts=table(spark, sf, "documents").select("doc_id", "text"))
    return metrics.compare(results, "2024-01-31", facts["train_n"], facts["class_share"])


def token_lists(spark, sf):
    """The corpus with tokens and its split."""
    rows = corpus(spark, sf).withColumn("tokens", tokenize(clean_delete(F.col("text"))))
    rows = rows.select("doc_id", F.col("label").cast("double").alias("label"), "tokens")
    return materialise(split.stratified_split(materialise(rows, "tokens"), "label"), "split")


def embedding_model(spark, sf):
    """(rows with buckets, model) of the published settings, trained once per session and data folder."""
    key = (spark.sparkContext.applicationId, sf, "embedding")
    if key not in _fitted:
        s = learners.EMBED
        rows = materialise(learners.embedding_rows(token_lists(spark, sf), "tokens", s["word_ngrams"], s["min_count"]), "words")
        _fitted[key] = rows, embeddings.train(rows.filter("is_train"), s["dim"], s["lr"], s["epoch"])
    return _fitted[key]


@query("embedding_classifier")
def _(spark, sf):
    rows, model = embedding_model(spark, sf)
    return model.predict(rows.filter("NOT is_train"))


@query("word_neighbours")
def _(spark, sf):
    """12 neighbours, in the fitted model, of the words that most of its texts hold."""
    rows, model = embedding_model(spark, sf)
    words = rows.filter("is_train").select(F.explode(F.array_distinct("tokens")).alias("term"))
    words = words.groupBy("term").agg(F.count("*").alias("texts")).withColumn("term_id", F.xxhash64("term"))
    known = materialise(model.word_vectors(words.filter(F.col("texts") >= learners.EMBED["min_count"])), "words")
    asked = known.orderBy(F.desc("texts"), "term").limit(NEIGHBOUR_WORDS)
    found = neighbours.ProjectionIndex.build(known, "term_id", "vector").nearest(asked.select(F.col("term_id").alias("query_id"), "vector"), 13)
    names = known.select("term_id", "term")
    named = found.join(names.withColumnsRenamed({"term_id": "query_id", "term": "word"}), "query_id").filter("id <> query_id")
    named = named.join(names.withColumnsRenamed({"term_id": "id", "term": "neighbour"}), "id")
    rank = F.row_number().over(Window.partitionBy("word").orderBy("rank"))
    return named.select("word", "neighbour", "cosine", rank.alias("rank")).filter("rank <= 12")


@query("cv_tune_rf")
def _(spark, sf):
    train = matrix(spark, sf).rows.filter("is_train")
    return learners.tune(train, trees=TUNE_TREES, parallelism=8)


@query("grid_eval")
def _(spark, sf):
    return learners.grid_eval(token_lists(spark, sf))


@query("score_batch")
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return score_batch(docs, bundle(spark, sf), gazetteer(spark)).drop("text")


@query("predict_labels")
def _(spark, sf):
    b, m = bundle(spark, sf), matrix(spark, sf)
    return learners.predict(b.model, m.rows)


@query("model_load")
def _(spark, sf):
    """What the saved and loaded forest says of every row, beside what the one in memory says."""
    path, rows = new_path(spark, "bundle"), matrix(spark, sf).rows
    save_bundle(bundle(spark, sf), path)
    loaded = learners.predict(load_bundle(spark, path).model, rows)
    kept = learners.predict(bundle(spark, sf).model, rows, ("doc_id",)).withColumnsRenamed({"predicted": "before", "probability": "p"})
    same = (F.col("predicted") == F.col("before")) & (F.abs(F.col("probability") - F.col("p")) < 1e-9)
    return loaded.join(kept, "doc_id").select("doc_id", "predicted", F.round("probability", 9).alias("probability"), same.alias("same"))


@query("loaded_vocabulary")
def _(spark, sf):
    path = new_path(spark, "bundle")
    save_bundle(bundle(spark, sf), path)
    return load_bundle(spark, path).tfidf.table.select("term", "term_id", F.round("idf", 9).alias("idf"))


@query("bundle_save")
def _(spark, sf):
    path = new_path(spark, "bundle")
    save_bundle(bundle(spark, sf), path)
    return load_bundle(spark, path).card


@query(
    "stream_score_sink",
    f"SELECT doc_id, coalesce(length({sql_clean_delete()}), 0) <= 80 OR coalesce(length(trim(text)), 0) <= 80 AS rejected FROM documents",
)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    stream = spark.readStream.schema(docs.schema).parquet(f"{sf}/documents*.parquet").select("doc_id", "text")
    b, names = bundle(spark, sf), gazetteer(spark)
    out, log = new_path(spark, "scored"), new_path(spark, "scored-log")

    def reject(batch):
        short = F.coalesce(F.length(F.trim("text")), F.lit(0)) <= 80
        return batch.filter(~short), batch.filter(short).withColumn("reason", F.lit("short text"))

    flows.score_stream(stream, lambda d: score_batch(d, b, names), out, log, reject).awaitTermination()
    # Which class a document gets depends on the fitted forest; that every document has one place does not.
    parts = [
        spark.read.schema("doc_id bigint").parquet(f"{out}/{part}").select("doc_id", F.lit(part == "rejects").alias("rejected"))
        for part in ("positives", "negatives", "rejects")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
