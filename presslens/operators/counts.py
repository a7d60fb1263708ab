"""Term counts, vocabulary and pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions import text as tx
from presslens.functions.stemming import stem_tokens
from presslens.operators.candidates import WORD_BYTES, CandidateGrams, Candidates
from presslens.operators.joins import lookup_join
from presslens.session import BROADCAST_ROWS, materialise, spread


def tokens_of(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    stop: list[str] | None = None,
    stem: bool = False,
    stop_after_stem: bool = False,
    keep: tuple[str, ...] = (),
    clean=None,
    partitioned: bool = False,
    rows_of_word: int = 1,
) -> DataFrame:
    """Documents as (id, words), hash-partitioned by id.

    Only the text is shuffled, once; counting grams per document afterwards needs no exchange. `clean`
    is applied to the text in the same step as the split into words. Stop words are removed before
    stemming unless `stop_after_stem` asks for the older order. `partitioned`: the documents already
    are partitioned by id. `rows_of_word`: the rows that a later step of the task sorts for each word; a
    task gets so much less text.
    """
    words = tx.tokenize(clean(F.col(text)) if clean else F.col(text))
    if stop and not stop_after_stem:
        words = tx.drop_stopwords(words, stop)
    rows = docs.select(id_col, *keep, text)
    if not partitioned:
        rows = spread(rows, id_col, size=F.octet_length(text) * rows_of_word)
    rows = rows.select(id_col, *keep, words.alias("words"))
    if stem:
        rows = rows.withColumn("words", stem_tokens("words"))
        if stop and stop_after_stem:
            rows = rows.withColumn("words", tx.drop_stopwords(F.col("words"), stop))
    return rows


def term_counts(grams: DataFrame | CandidateGrams, id_col: str = "doc_id") -> DataFrame:
    """(id, term, n). Candidates are counted inside their rows, where no document has two."""
    if isinstance(grams, CandidateGrams):
        if grams.one_row_each():
            rows = grams.entries(None, {}).select(grams.id_col, F.explode("entries").alias("e"))
            return rows.select(grams.id_col, "e.term", "e.n")
        grams = grams.rows()
    return grams.groupBy(id_col, "term").agg(F.count("*").alias("n"))


def vocabulary(counts: DataFrame | CandidateGrams) -> DataFrame:
    """Total count and document count per term, of counts or of candidates not counted yet."""
    if isinstance(counts, CandidateGrams):
        if counts.one_row_each():
            return counts.vocabulary()
        counts = term_counts(counts.rows(), counts.id_col)
    return counts.groupBy("term").agg(F.sum("n").alias("term_count"), F.count("*").alias("doc_count"))


def min_df(counts: DataFrame | CandidateGrams, documents: int = 5) -> DataFrame:
    """Terms present in at least so many documents."""
    if isinstance(counts, CandidateGrams):
        return vocabulary(counts).select("term", "doc_count").filter(F.col("doc_count") >= documents)
    return counts.groupBy("term").agg(F.count("*").alias("doc_count")).filter(F.col("doc_count") >= documents)


def restrict(counts: DataFrame, vocab: DataFrame, tasks: int | None = None, id_col: str = "doc_id", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Counts of the terms of a written vocabulary.

    They are looked up after they are counted: where the vocabulary is too large to broadcast, a term's
    repeats in a document are shuffled as one row, and the counts need no second shuffle.
    """
    rows = lookup_join(counts, vocab.select("term"), "term", id_col, max_rows=max_rows, tasks=tasks)
    return rows.select(id_col, "term", "n")


def prune(
    vocab: DataFrame,
    min_count: int = 1,
    max_doc_share: float | None = None,
    docs: DataFrame | None = None,
    min_docs: int | None = None,
) -> DataFrame:
    """Keep terms by total count, and optionally by document count and share of documents."""
    vocab = vocab.filter(F.col("term_count") >= min_count)
    if min_docs is not None:
        vocab = vocab.filter(F.col("doc_count") >= min_docs)
    if max_doc_share is not None:
        total = docs.agg(F.count("*").alias("docs")).scalar()
        vocab = vocab.filter(F.col("doc_count") <= F.lit(max_doc_share) * total)
    return vocab


def research_words(docs: DataFrame, stop: list[str], text: str = "text", id_col: str = "doc_id", stem: bool = False) -> DataFrame:
    """(id, words): raw words, stop words blank."""
    words = tx.blank_stopwords(tx.tokenize(F.col(text)), stop)
    rows = docs.select(id_col, words.alias("words"))
    return rows.withColumn("words", stem_tokens("words")) if stem else rows


def research_grams(
    docs: DataFrame,
    stop: list[str],
    text: str = "text",
    id_col: str = "doc_id",
    n_min: int = 2,
    n_max: int = 5,
    stem: bool = False,
) -> DataFrame:
    """Grams of raw words; stop words are then dropped inside each gram and the rest re-joined."""
    rows = spread(docs.select(id_col, text), id_col, size=F.octet_length(text))
    return tx.ngram_rows(research_words(rows, stop, text, id_col, stem), "words", n_min, n_max, " ", (id_col,))


def frequent_research_grams(
    docs: DataFrame, stop: list[str], min_docs: int = 5, n_min: int = 2, n_max: int = 5, slots: int | None = None
) -> CandidateGrams:
    """The research grams without most of those in fewer than `min_docs` documents (see `candidates`)."""
    words = materialise(research_words(docs, stop), "words")
    return CandidateGrams(words, Candidates.fit(words, n_max, min_docs, per_doc=True, slots=slots), n_min, n_max, " ")


def frequent_research_counts(
    docs: DataFrame, stop: list[str], min_docs: int = 5, n_min: int = 2, n_max: int = 5, slots: int | None = None
) -> DataFrame:
    """(doc_id, term, n) of the research grams, without most of those in fewer than `min_docs` documents.

    Terms in at least so many documents have all their rows (see `candidates`); the caller drops the rest.
    """
    return term_counts(frequent_research_grams(docs, stop, min_docs, n_min, n_max, slots))


def text_bytes(words: str) -> Column:
    """About the bytes of a row of words."""
    return F.size(words) * WORD_BYTES


def frequent_vocabulary(
    words: DataFrame,
    n_min: int = 1,
    n_max: int = 5,
    min_count: int = 20,
    sep: str = "_",
    id_col: str = "doc_id",
    slots: int | None = None,
    candidates: Candidates | None = None,
) -> DataFrame:
    """Terms of n_min..n_max words with at least `min_count` occurrences, as a written table.

    Only grams that may be frequent are formed and shuffled (see `candidates`); most of the grams, and
    nearly all of the long ones, never arise. No frequent gram is lost. `words` is a written table.
    """
    candidates = candidates or Candidates.fit(words, n_max, min_count, slots=slots)
    grams = CandidateGrams(words, candidates, n_min, n_max, sep, id_col)
    return materialise(prune(vocabulary(grams), min_count), "vocabulary")


def collapse(tokens: DataFrame, keys: list[str], pos: str = "pos", word: str = "word") -> DataFrame:
    """The words of one gram pasted back in order; a gram has a handful of words."""
    parts = F.sort_array(F.collect_list(F.struct(pos, word)))
    return tokens.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda p: p[word]), " ").alias("term"))


def class_share(df: DataFrame, label: str, positive=1) -> DataFrame:
    return df.agg(
        F.count("*").alias("train_n"),
        F.avg(F.when(F.col(label) == positive, 1.0).otherwise(0.0)).alias("class_share"),
    )
