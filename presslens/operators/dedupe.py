"""Keep-first, latest and top-n operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One whole row per key: the first in an explicit order.

    `min_by` combines on the map side, so of a hot key each task sends one row only.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    rows = df.groupBy(*keys).agg(first)
    return rows.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def keep_first_by_text(df: DataFrame, text: str, keys: list[str], order: list) -> DataFrame:
    """As `keep_first` with a long text among the keys: the text travels once, its digest is the key."""
    digest = df.withColumn("_digest", F.md5(F.col(text)))
    return keep_first(digest, ["_digest", *keys], order).drop("_digest")


def first_per_id(df: DataFrame, key: str, order: list) -> DataFrame:
    return keep_first(df, [key], order)


def latest(df: DataFrame, *order: str) -> DataFrame:
    """Newest row; a top-1 without a full sort."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(1)


def newest(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_n_with_ties(counts: DataFrame, by: str, n: int, value: str, tie: str) -> DataFrame:
    """Rows whose rank by `value` within `by` is at most n, ties kept.

    Ties can be unbounded, so no window collects them: a window with a row limit finds the (at most
    n) ranked values of a group, and a join on (group, value) brings back every row with such a
    value. The limit is applied per task before the shuffle.
    """
    window = Window.partitionBy(by).orderBy(F.desc(value), F.asc(tie))
    head = counts.withColumn("_row", F.row_number().over(window)).filter(F.col("_row") <= n)
    ranks = head.groupBy(by, value).agg(F.min("_row").alias("rank"))
    return counts.join(ranks, [by, value]).select(*counts.columns, "rank")
