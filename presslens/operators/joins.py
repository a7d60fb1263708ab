"""Joins: natural left, lookups with a checked broadcast, incremental anti join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.session import BROADCAST_BYTES, BROADCAST_ROWS

SALTS = 32


def natural_left(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on all shared columns; null keys match each other.

    Rows without a key, often many, are shared out over salted tasks.
    """
    shared = [c for c in left.columns if c in right.columns]
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in shared])
    salt = F.when(missing, F.pmod(F.xxhash64(*left.columns), F.lit(SALTS)).cast("int")).otherwise(0)
    salts = F.explode(F.when(missing, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))
    other = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in shared],
        *[F.col(c) for c in right.columns if c not in shared],
        salts.alias("_r_salt"),
    )
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in shared])
    rows = left.withColumn("_salt", salt).join(other, match & (F.col("_salt") == F.col("_r_salt")), "left")
    return rows.drop("_salt", "_r_salt", *[f"_r_{c}" for c in shared])


def fits(table: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a table is small enough to broadcast: its rows first, then the length of its rows as text."""
    if table.limit(max_rows + 1).count() > max_rows:
        return False
    size = F.sum(F.octet_length(F.to_json(F.struct(*table.columns))).cast("bigint"))
    return (table.agg(size.alias("size")).first()["size"] or 0) <= max_bytes


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    tasks: int | None = None,
) -> DataFrame:
    """Join many rows to a written lookup table with one row per key.

    The table's size is checked first. Small: broadcast. Large: a shuffled join on (key, salt), where
    the salt comes from another column of the rows, so a hot key is shared out over many tasks. `tasks`
    says over how many, where the caller knows what the rows hold; else the session's setting does.
    """
    if fits(table, max_rows):
        return rows.join(F.broadcast(table), key, how)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(SALTS)).cast("int"))
    salty = table.withColumn("_salt", salts)
    if tasks:
        salted, salty = salted.repartition(tasks, key, "_salt"), salty.repartition(tasks, key, "_salt")
    # By its file alone the table may look small enough to be broadcast after all, with a row for every salt.
    return salted.join(salty.hint("merge"), [key, "_salt"], how).drop("_salt")


def pending(docs: DataFrame, done: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents without a record in `done`."""
    return docs.join(done.select(key), key, "left_anti")


def drop_listed(rows: DataFrame, column: str, words: list[str]) -> DataFrame:
    """Anti join against a fixed word list, as a set test inside the scan's stage."""
    return rows.filter(~F.col(column).isin(words))
