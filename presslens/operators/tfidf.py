"""Two TF-IDF variants, the document-term matrix and sparse vectors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.functions.text import bind
from presslens.operators.candidates import CandidateGrams, Lookup
from presslens.operators.counts import term_counts
from presslens.operators.joins import lookup_join
from presslens.session import materialise, new_path

# Smoothed document frequencies: ln(N / (1 + df)), or ln(1 + N / df), or plain ln(N / df).
IDF_VARIANTS = ("plus_one_below", "plus_one_outside", "plain")


def idf_column(n_docs: Column, df: Column, variant: str) -> Column:
    if variant == "plus_one_below":
        return F.ln(n_docs / (F.lit(1.0) + df))
    if variant == "plus_one_outside":
        return F.ln(F.lit(1.0) + n_docs / df)
    if variant == "plain":
        return F.ln(n_docs / df)
    raise ValueError(f"idf variant {variant!r} is not one of {IDF_VARIANTS}")


def doc_rows(grams: CandidateGrams, vocab: DataFrame, columns: tuple[str, ...] = ("term_id",)) -> DataFrame:
    """(id, entries of (term, n, *columns)) of the terms of a written vocabulary, one row per document that has some.

    Documents of one row each are counted and looked up inside their rows: no gram is shuffled. Others are
    counted by id, joined by term and put together again.
    """
    if grams.one_row_each():
        lookup = Lookup.build(vocab, columns, grams.sep)
        if lookup:
            return grams.entries(lookup, dict(vocab.select(*columns).dtypes)).filter(F.size("entries") > 0)
    kept = lookup_join(term_counts(grams.rows(), grams.id_col), vocab.select("term", *columns), "term", grams.id_col)
    return kept.groupBy(grams.id_col).agg(F.collect_list(F.struct("term", "n", *columns)).alias("entries"))


def long_form(rows: DataFrame) -> DataFrame:
    """One row per entry of `doc_rows`, with the other columns of its document."""
    others = [c for c in rows.columns if c != "entries"]
    return rows.select(*others, F.explode("entries").alias("_entry")).select(*others, "_entry.*")


def doc_term_matrix(
    grams: DataFrame | CandidateGrams, vocab: DataFrame, id_col: str = "doc_id", columns: tuple[str, ...] = ("term_id",)
) -> DataFrame:
    """Counts of the vocabulary's terms per document.

    Grams are looked up before they are counted: most of them are outside the vocabulary and vanish
    in the task that made them. Candidates are counted inside their rows (see `doc_rows`).
    """
    if isinstance(grams, CandidateGrams):
        return long_form(doc_rows(grams, vocab, columns)).select(id_col, "term", *columns, "n")
    kept = lookup_join(grams, vocab.select("term", *columns), "term", id_col)
    return kept.groupBy(id_col, "term", *columns).agg(F.count("*").alias("n"))


def term_shares(counts: DataFrame, id_col: str = "doc_id") -> Column:
    """n over the document's total of kept terms (rows sum to 1)."""
    return F.col("n") / F.sum("n").over(Window.partitionBy(id_col))


def entry_total() -> Column:
    """The total of a document's `entries` (see `doc_rows`)."""
    return F.aggregate("entries", F.lit(0).cast("bigint"), lambda total, e: total + e["n"])


def tfidf_tidy(counts: DataFrame, id_col: str = "doc_id", df_col: str = "doc_count") -> DataFrame:
    """tf = n / total of kept terms, idf = ln(documents / documents with the term).

    `counts` are already restricted and carry each term's document count: one row per document (see
    `doc_rows`), or per document and term. The rows are written once; the number of documents is then
    read from the written ids, so the grams are not formed a second time for it.
    """
    if "entries" in counts.columns:
        rows = materialise(counts.withColumn("_total", entry_total()), "tf")
    else:
        rows = materialise(counts.withColumn("tf", term_shares(counts, id_col)), "tf")
    n_docs = rows.agg(F.count_distinct(id_col).alias("docs")).scalar()
    if "entries" in counts.columns:
        rows = long_form(rows).withColumn("tf", F.col("n") / F.col("_total")).drop("_total")
    rows = rows.withColumn("idf", F.ln(n_docs / F.col(df_col)))
    return rows.withColumn("tf_idf", F.col("tf") * F.col("idf"))


@dataclass
class TfidfModel:
    """Fitted vocabulary: term, term_id, term_count, doc_count, idf, in one written table.

    `fit` takes a written vocabulary (see `counts.frequent_vocabulary`).
    """

    table: DataFrame
    n_docs: int

    @classmethod
    def fit(cls, vocab: DataFrame, n_docs: int, variant: str = "plus_one_below") -> TfidfModel:
        idf = idf_column(F.lit(float(n_docs)), F.col("doc_count"), variant)
        return cls(materialise(_dense_ids(vocab.withColumn("idf", idf)), "tfidf"), n_docs)

    def transform_rows(self, grams: CandidateGrams) -> DataFrame:
        """(id, entries of (term, term_id, n, weight)) under the fitted idf, one row per document with a known term."""
        rows = doc_rows(grams, self.table, ("term_id", "idf"))

        def weighted(total: Column) -> Column:
            weight = lambda e: (e["n"] / total * e["idf"]).alias("weight")
            return F.transform("entries", lambda e: F.struct(e["term"].alias("term"), e["term_id"].alias("term_id"), e["n"].alias("n"), weight(e)))

        return rows.withColumn("entries", bind(entry_total(), weighted))

    def transform(self, grams: DataFrame | CandidateGrams, id_col: str = "doc_id") -> DataFrame:
        """Weights of any documents under the fitted idf; unseen terms are ignored."""
        if isinstance(grams, CandidateGrams):
            rows = doc_rows(grams, self.table, ("term_id", "idf")).withColumn("_total", entry_total())
            weight = (F.col("n") / F.col("_total") * F.col("idf")).alias("weight")
            return long_form(rows).select(id_col, "term", "term_id", "n", weight)
        counts = doc_term_matrix(grams, self.table, id_col, ("term_id", "idf"))
        tf = term_shares(counts, id_col)
        return counts.withColumn("weight", tf * F.col("idf")).select(id_col, "term", "term_id", "n", "weight")

    @property
    def size(self) -> int:
        return self.table.count()

    def save(self, path: str) -> None:
        self.table.withColumn("n_docs", F.lit(self.n_docs)).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TfidfModel:
        table = spark.read.parquet(path)
        n_docs = table.select("n_docs").first()["n_docs"]
        return cls(table.drop("n_docs"), n_docs)


def _dense_ids(vocab: DataFrame) -> DataFrame:
    """0, 1, 2, ... by term, without one task that sees the whole vocabulary.

    Terms are put into fixed hash buckets; a bucket's first id is the number of terms in the buckets
    before it, and inside a bucket terms are numbered in order.
    """
    buckets = 4096
    rows = vocab.withColumn("_bucket", F.pmod(F.crc32(F.encode("term", "UTF-8")), F.lit(buckets)))
    sizes = rows.groupBy("_bucket").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most 4096 rows
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("term"))
    rows = rows.withColumn("_inside", inside).join(F.broadcast(starts), "_bucket")
    ids = (F.col("_start") + F.col("_inside") - 1).cast("int")
    return rows.withColumn("term_id", ids).drop("_bucket", "_start", "_inside")


def to_entries(long: DataFrame, id_col: str = "doc_id", ids: DataFrame | None = None) -> DataFrame:
    """Long form (doc, term_id, weight) to one array of (term_id, weight) per document, by term id.

    With `ids` every listed document gets an array, an empty one if it has no weight. Rows that are one per
    document already (see `TfidfModel.transform_rows`) are not grouped again.
    """
    if "entries" in long.columns:
        pair = F.transform("entries", lambda e: F.struct(e["term_id"].alias("term_id"), e["weight"].alias("weight")))
        rows = long.select(id_col, F.array_sort(pair).alias("entries"))
    else:
        entries = F.array_sort(F.collect_list(F.struct("term_id", "weight"))).alias("entries")
        rows = long.groupBy(id_col).agg(entries)
    if ids is None:
        return rows
    none = F.array().cast(rows.schema["entries"].dataType)
    rows = ids.select(id_col).join(rows, id_col, "left")
    return rows.withColumn("entries", F.coalesce("entries", none))


def export_matrix(rows: DataFrame, size: int, path: str) -> DataFrame:
    """Write rows with `entries` as a training matrix with sparse vectors in `features`.

    The struct written is the stored form of a sparse vector, so the vectors are read back as such
    and no row passes through Python.
    """
    vector = F.struct(
        F.lit(0).cast("byte").alias("type"),
        F.lit(size).alias("size"),
        F.col("entries.term_id").alias("indices"),
        F.col("entries.weight").alias("values"),
    )
    out = rows.withColumn("entries", vector).withColumnRenamed("entries", "features")
    out.write.mode("overwrite").parquet(path)
    fields = [f if f.name != "features" else T.StructField("features", VectorUDT()) for f in out.schema]
    return rows.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def matrix_entries(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A written matrix in long form: `columns` (name and type each) with one row per stored entry (term_id, weight)."""
    stored = "features struct<type: tinyint, size: int, indices: array<int>, values: array<double>>"
    rows = spark.read.schema(", ".join([*columns, stored])).parquet(path)
    names = [c.split()[0] for c in columns]
    entry = F.explode(F.arrays_zip("features.indices", "features.values")).alias("e")
    return rows.select(*names, entry).select(*names, F.col("e.indices").alias("term_id"), F.col("e.values").alias("weight"))


def to_vectors(long: DataFrame, size: int, id_col: str = "doc_id", ids: DataFrame | None = None) -> DataFrame:
    """Long form to one sparse vector per document, as a written table (see `export_matrix`)."""
    return export_matrix(to_entries(long, id_col, ids), size, new_path(long.sparkSession, "vectors"))


def assemble(weights: DataFrame, entity_counts: DataFrame, types: list[str], size: int, id_col: str = "doc_id"):
    """Term weights and entity counts in one long form; entity types take the ids after the terms."""
    ids = F.create_map(*[x for i, t in enumerate(types) for x in (F.lit(t), F.lit(size + i))])
    columns = [f"entity_count_{t}" for t in types]
    long = entity_counts.select(id_col, *columns).unpivot([id_col], columns, "name", "weight")
    kind = F.substring("name", len("entity_count_") + 1, 1000)
    rows = long.filter("weight <> 0").select(
        id_col, F.col("name").alias("term"), ids[kind].alias("term_id"), F.col("weight").cast("double")
    )
    return weights.select(id_col, "term", "term_id", "weight").unionByName(rows)
