"""Stratified split and cross-validation folds with exact sizes.

Rows are ordered inside each class by md5(seed, id), then id. A plain window over a class would pull
the class into one task. Here the first four hex digits of the digest cut each class into 65,536
buckets: bucket sizes give every bucket's first rank, and only inside a bucket are rows sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.operators.joins import lookup_join
from presslens.session import materialise


def order_hash(seed: int, id_col: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")))


def _hashed(df: DataFrame, seed: int, id_col: str) -> DataFrame:
    digest = order_hash(seed, id_col)
    return df.withColumns({"_hash": digest, "_bucket": F.substring(digest, 1, 4)})


def _bucket_starts(hashed: DataFrame, label: str) -> DataFrame:
    """(class, bucket) -> rows before the bucket, rows in it, rows of the class."""
    sizes = hashed.groupBy(label, "_bucket").agg(F.count("*").alias("_in"))
    of_class = Window.partitionBy(label)
    before = of_class.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        label,
        "_bucket",
        "_in",
        F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_before"),
        F.sum("_in").over(of_class).alias("_total"),
    )


def class_rank(df: DataFrame, label: str, seed: int, id_col: str = "doc_id") -> DataFrame:
    """Adds `class_rank` (1, 2, ... per class) and `class_size`."""
    rows = _hashed(df, seed, id_col)
    starts = _bucket_starts(rows.select(label, "_bucket"), label).drop("_in")
    inside = Window.partitionBy(label, "_bucket").orderBy("_hash", id_col)
    ranked = rows.withColumn("_inside", F.row_number().over(inside)).join(starts, [label, "_bucket"])
    rank = F.col("_before") + F.col("_inside")
    return ranked.select(*df.columns, rank.alias("class_rank"), F.col("_total").alias("class_size"))


def cut_points(df: DataFrame, label: str, p: float, seed: int, id_col: str = "doc_id") -> DataFrame:
    """Per class the last (digest, id) of its first ceil(p * n) rows.

    Only (class, id) is read and only the one bucket that holds the cut is sorted.
    """
    rows = _hashed(df.select(label, id_col), seed, id_col)
    starts = _bucket_starts(rows, label)
    need = F.ceil(F.lit(float(p)) * F.col("_total")).cast("bigint")
    holds = (F.col("_before") < need) & (need <= F.col("_before") + F.col("_in"))
    cut = starts.withColumn("_need", need - F.col("_before")).filter(holds).drop("_in", "_before", "_total")
    edge = rows.join(cut, [label, "_bucket"])
    inside = Window.partitionBy(label).orderBy("_hash", id_col)
    edge = edge.withColumn("_inside", F.row_number().over(inside)).filter("_inside = _need")
    return edge.select(label, F.struct(F.col("_hash").alias("hash"), F.col(id_col).alias("id")).alias("_cut"))


def stratified_split(
    df: DataFrame, label: str, p: float = 0.7, seed: int = 1234, id_col: str = "doc_id"
) -> DataFrame:
    """Adds `is_train`: exactly ceil(p * n) rows of each class, the same for every partitioning.

    Rows look up the cut point of their class, a table of one row per class: while that is small it
    is broadcast and the rows are not shuffled. A row without a class is not for training.
    """
    points = materialise(cut_points(df, label, p, seed, id_col), "cut-points")
    place = F.struct(order_hash(seed, id_col).alias("hash"), F.col(id_col).alias("id"))
    rows = lookup_join(df, points, label, id_col, "left")
    return rows.select(*df.columns, F.coalesce(place <= F.col("_cut"), F.lit(False)).alias("is_train"))


def cv_folds(
    df: DataFrame, label: str, folds: int = 10, seed: int = 1234, id_col: str = "doc_id"
) -> DataFrame:
    """Adds `fold` (0 .. folds-1), balanced inside each class."""
    ranked = class_rank(df, label, seed, id_col)
    fold = F.pmod(F.col("class_rank") - 1, F.lit(folds)).cast("int")
    return ranked.withColumn("fold", fold).drop("class_rank", "class_size")
