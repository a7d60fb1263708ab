"""Retraining: corpus to promoted bundle."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions.text import clean_delete, ngram_rows, stopwords, tokenize
from presslens.operators import embeddings, learners, metrics
from presslens.operators.candidates import CandidateGrams, Candidates
from presslens.operators.counts import frequent_vocabulary, prune, tokens_of
from presslens.operators.entities import ENTITY_TYPES, annotate, entity_counts
from presslens.operators.split import stratified_split
from presslens.operators.tfidf import TfidfModel, assemble, export_matrix, to_entries
from presslens.session import materialise, new_path
from presslens.sinks.bundles import Bundle

# Gram lengths, least total count and training share of the production model.
GRAMS = (1, 5)
MIN_COUNT = 20
TRAIN_SHARE = 0.7
DEFAULTS = {"n_min": GRAMS[0], "n_max": GRAMS[1], "language": "portuguese", "stem": True, "legacy": False, "entity_chars": None}


@dataclass
class Matrix:
    """Training matrix (doc_id, label, is_train, features) and what made it."""

    rows: DataFrame
    tfidf: TfidfModel
    size: int
    options: dict


def words_of(
    docs: DataFrame, options: dict, ready: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Words as training and scoring use them: cleaned, stop words out, stems.

    `ready`: the text is clean and the documents are partitioned by id.
    """
    stop = stopwords(options["language"]) if options["language"] else []
    clean = None if ready or options["legacy"] else clean_delete
    return tokens_of(
        docs, stop=stop, stem=options["stem"], stop_after_stem=options["legacy"], keep=keep, clean=clean,
        partitioned=ready,
    )


def weights_of(
    words: DataFrame, docs: DataFrame, tfidf: TfidfModel, size: int, gazetteer, options: dict, candidates: Candidates | None = None
) -> DataFrame:
    """(doc_id, term_id, weight): term weights and, with a gazetteer, entity counts.

    Entities are looked for in the text of `docs` as it came, in training and in scoring alike; with
    the option `entity_chars`, only in so many of its characters. `candidates`, fitted for the same
    vocabulary, leaves out grams that cannot be in it.
    """
    lengths = options["n_min"], options["n_max"]
    grams = CandidateGrams(words, candidates, *lengths) if candidates else ngram_rows(words, "words", *lengths)
    long = tfidf.transform(grams).select("doc_id", "term", "term_id", "weight")
    if gazetteer is not None:
        found = entity_counts(annotate(docs, gazetteer, max_chars=options["entity_chars"]))
        long = assemble(long, found, ENTITY_TYPES, size)
    return long


def matrix_of(docs: DataFrame, clean: str, tfidf: TfidfModel, gazetteer: DataFrame | None, options: dict) -> DataFrame:
    """(doc_id, features) of every document, written; `clean` is the column of the cleaned text."""
    size = tfidf.size
    words = words_of(docs.select("doc_id", F.col(clean).alias("text")), options, ready=True)
    entries = to_entries(weights_of(words, docs, tfidf, size, gazetteer, options), ids=docs)
    return export_matrix(entries, size + len(ENTITY_TYPES), new_path(docs.sparkSession, "matrix"))


def training_matrix(
    corpus: DataFrame,
    gazetteer: DataFrame | None = None,
    min_count: int = MIN_COUNT,
    min_docs: int | None = None,
    idf_variant: str = "plus_one_below",
    share: float = TRAIN_SHARE,
    **options,
) -> Matrix:
    """Split, vocabulary and idf of the training part, then vectors of all documents.

    `corpus`: (doc_id, text, label) with one row per document.
    """
    options = {**DEFAULTS, **options}
    corpus = materialise(corpus, "corpus")
    split = stratified_split(corpus, "label", share)
    # words are stemmed once, then read by both vocabulary passes and by the weights
    written = materialise(words_of(split, options, keep=("is_train",)), "words")
    train = written.filter("is_train").select("doc_id", "words")
    candidates = Candidates.fit(train, options["n_max"], min_count)
    vocab = frequent_vocabulary(train, options["n_min"], options["n_max"], min_count, candidates=candidates)
    vocab = prune(vocab, min_docs=min_docs)
    tfidf = TfidfModel.fit(vocab, written.filter("is_train").count(), idf_variant)
    terms = tfidf.size
    size = terms + len(ENTITY_TYPES)
    entries = to_entries(weights_of(written, corpus, tfidf, terms, gazetteer, options, candidates), ids=corpus)
    label = F.col("label").cast("double").alias("label")
    rows = split.select("doc_id", label, "is_train").join(entries, "doc_id")
    return Matrix(export_matrix(rows, size, new_path(corpus.sparkSession, "matrix")), tfidf, size, options)


def evaluate(model, test: DataFrame) -> DataFrame:
    """The 18 metrics of a fitted model as (metric, value)."""
    return judged(learners.predict(model, test))


def judged(said: DataFrame) -> DataFrame:
    """The 18 metrics of predictions (label, predicted) as (metric, value)."""
    said = said.withColumn("label", F.col("label").cast("int"))
    return metrics.melt(metrics.metrics(metrics.confusion(said, "label", "predicted")))


def train(
    corpus: DataFrame, gazetteer: DataFrame | None = None, trees: int = learners.RF_TREES, fitted_on=None, **options
) -> Bundle:
    """Fit the production forest and evaluate it on the held-out part."""
    return fit(training_matrix(corpus, gazetteer, **options), trees, fitted_on)


def fit(matrix: Matrix, trees: int = learners.RF_TREES, fitted_on=None) -> Bundle:
    """The production forest of a matrix, with its model card."""
    fit_rows, test = matrix.rows.filter("is_train"), matrix.rows.filter("NOT is_train")
    forest = learners.random_forest(matrix.size, trees)
    model = Pipeline(stages=[forest]).fit(fit_rows)
    facts = matrix.rows.agg(
        F.count_if("is_train").alias("n"), F.avg(F.col("label")).alias("share")
    ).first()
    card = metrics.model_card(
        evaluate(model, test),
        model="Random forest (MLlib)",
        sample_size=facts["n"],
        train_prop_covid=facts["share"],
        mtry=learners.mtry(matrix.size),
        n_tree=trees,
        min_node_size=learners.RF_MIN_NODE,
        splitrule="gini",
        model_type="classification",
        fitted_on=fitted_on,
    )
    return Bundle(model, matrix.tfidf, materialise(card, "card"), matrix.size, matrix.options)


def baselines(
    matrix: Matrix, trees: int = learners.RF_TREES, texts: DataFrame | None = None, parallelism: int = 3, **embed
) -> dict[str, DataFrame]:
    """Long metrics of the five models on one split; the embedding model needs `texts` (doc_id, text).

    A model's steps leave many cores idle between them, so `parallelism` models are fitted at a time.
    """
    fit_rows, test = matrix.rows.filter("is_train").cache(), matrix.rows.filter("NOT is_train")
    models = {
        "svm\nbaseline": lambda: evaluate(learners.linear_svm(fit_rows.count()).fit(fit_rows), test),
        "nb\nbaseline": lambda: evaluate(learners.gaussian_nb().fit(fit_rows), test),
        "logitboost\nbaseline": lambda: judged(learners.boosted_stumps(fit_rows, test)),
        "random forests\nbaseline": lambda: evaluate(learners.random_forest_baseline(matrix.size, trees).fit(fit_rows), test),
    }

    def embedding():
        settings = {**learners.EMBED, **embed}
        rows = matrix.rows.select("doc_id", "label", "is_train").join(texts, "doc_id")
        rows = rows.withColumn("tokens", tokenize(clean_delete(F.col("text")))).drop("text")
        rows = materialise(rows, "tokens")
        rows = materialise(learners.embedding_rows(rows, "tokens", settings["word_ngrams"], settings["min_count"]), "words")
        model = embeddings.train(rows.filter("is_train"), settings["dim"], settings["lr"], settings["epoch"])
        return judged(model.predict(rows.filter("NOT is_train")))

    if texts is not None:
        models["embedding\nbaseline"] = embedding
    # the two that take longest begin first
    order = sorted(models, key=lambda name: not name.startswith(("random", "embedding")))
    with ThreadPoolExecutor(parallelism) as pool:
        found = dict(zip(order, pool.map(lambda name: materialise(models[name](), "metrics"), order), strict=True))
    fit_rows.unpersist()
    return {name: found[name] for name in models}
