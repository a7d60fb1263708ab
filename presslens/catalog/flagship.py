"""The flagship query: corpus to the most telling terms per label."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.catalog.registry import STOP, query, sql_list, sql_tokens, table
from presslens.functions.text import SPACE_PATTERN, clean_space
from presslens.operators.candidates import CandidateGrams, Candidates
from presslens.operators.counts import min_df, tokens_of
from presslens.operators.dedupe import keep_first_by_text, top_n_with_ties
from presslens.operators.tfidf import doc_rows, tfidf_tidy
from presslens.session import materialise

EDGE = "' ' || chr(9) || chr(10) || chr(13)"


@query(
    "top_terms_per_label",
    rf"""WITH corpus AS (SELECT * FROM (SELECT d.doc_id, d.text, l.quality,
      row_number() OVER (PARTITION BY d.text, l.quality ORDER BY d.doc_id) r
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id) WHERE r = 1),
    clean AS (SELECT doc_id, trim(regexp_replace(text, '{SPACE_PATTERN}', ' ', 'g'), {EDGE}) AS text,
      quality FROM corpus),
    words AS (SELECT doc_id, quality, list_filter({sql_tokens()}, lambda x: x NOT IN {sql_list(STOP)}) AS w FROM clean),
    tokens AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - n + 2),
      lambda i: array_to_string(list_slice(w, i, i + n - 1), '_'))) AS term FROM words, (SELECT unnest([1, 2]) AS n)),
    counts AS (SELECT doc_id, term, count(*) AS n FROM tokens GROUP BY doc_id, term),
    vocab AS (SELECT term, count(*) AS doc_count FROM counts GROUP BY term HAVING count(*) >= 5),
    kept AS (SELECT c.*, v.doc_count FROM counts c JOIN vocab v ON c.term = v.term),
    scored AS (SELECT doc_id, term, n / sum(n) OVER (PARTITION BY doc_id)
      * ln((SELECT count(DISTINCT doc_id) FROM kept) / doc_count) AS tf_idf FROM kept),
    sums AS (SELECT quality, term, round(sum(tf_idf), 6) AS score FROM scored s JOIN clean c ON s.doc_id = c.doc_id
      GROUP BY quality, term)
    SELECT * FROM (SELECT quality, term, score, rank() OVER (PARTITION BY quality ORDER BY score DESC) AS rank FROM sums)
    WHERE rank <= 20""",
)
def top_terms(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    rows = table(spark, sf, "documents").select("doc_id", "text").join(labels, "doc_id")
    corpus = keep_first_by_text(rows, "text", ["quality"], ["doc_id"])
    # de-duplicated rows are read twice below (vocabulary, then weights): written once
    clean = materialise(corpus.withColumn("text", clean_space(F.col("text"))), "clean-corpus")
    words = materialise(tokens_of(clean, stop=STOP, partitioned=True, keep=("quality",)), "words")
    grams = CandidateGrams(words, Candidates.fit(words, 2, 5, per_doc=True), 1, 2, keep=("quality",))
    vocab = materialise(min_df(grams, 5), "vocabulary")
    labelled = tfidf_tidy(doc_rows(grams, vocab, ("doc_count",)))
    if "quality" not in labelled.columns:  # where a document has two labels, its words are counted once and labelled twice
        labelled = labelled.join(clean.select("doc_id", "quality"), "doc_id")
    sums = labelled.groupBy("quality", "term").agg(F.round(F.sum("tf_idf"), 6).alias("score"))
    top = top_n_with_ties(sums, "quality", 20, "score", "term")
    return top.withColumn("rank", F.col("rank").cast("bigint"))
