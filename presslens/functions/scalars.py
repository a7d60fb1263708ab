"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Hour of day -> minutes looked back.
LOOKBACK_BY_HOUR = [(0, 6, 240), (7, 20, 100), (20, 23, 120)]
# Minimum lead length, score gate, parse gate, entity text length.
LEAD_MIN_CHARS = 600
LEAD_MIN_CHARS_RESEARCH = 100
SCORE_MIN_CHARS = 80
PARSE_MIN_CHARS = 10
ENTITY_TEXT_CHARS = 5000
# Fixed value: the negative marker in the names of labelled files.
NEGATIVE_MARKER = "no_covid_label"
# Fixed value: time format of a snapshot name.
SNAPSHOT_FORMAT = "yyyy-MM-dd-HH-mm"


def lookback_minutes(hour: Column) -> Column:
    """Minutes to look back for an hour of day; the first matching range wins."""
    first, *rest = LOOKBACK_BY_HOUR
    expr = F.when(hour.between(first[0], first[1]), F.lit(first[2]))
    for low, high, minutes in rest:
        expr = expr.when(hour.between(low, high), F.lit(minutes))
    return expr


def choose_text(lead: Column, body: Column, threshold: int = LEAD_MIN_CHARS) -> Column:
    """The body when the lead is short; a null lead stays null."""
    return F.when(lead.isNull(), F.lit(None)).when(F.length(lead) < threshold, body).otherwise(lead)


def unite(*cols: Column, sep: str = " ") -> Column:
    return F.concat_ws(sep, *cols)


def label01(flag: Column) -> Column:
    return F.when(flag, F.lit("1")).when(~flag, F.lit("0"))


def source_code(doc_id: Column) -> Column:
    """Capital letters at the start of an id, directly before a digit."""
    return F.nullif(F.regexp_extract(doc_id, "^([A-Z]+)[0-9]", 1), F.lit(""))


def label_from_path(path: Column, negative: str = NEGATIVE_MARKER) -> Column:
    """False when the file's base name carries the negative marker before its first hyphen."""
    base = F.element_at(F.split(path, "/"), -1)
    return F.substring_index(base, "-", 1) != negative


def truncate(text: Column, chars: int = ENTITY_TEXT_CHARS) -> Column:
    return F.substring(text, 1, chars)


def score_gate(clean: Column, chars: int = SCORE_MIN_CHARS) -> Column:
    """Cleaned text when it is long enough to be scored, else null."""
    return F.when(F.length(clean) > chars, clean)


def snapshot_name(ts: Column, prefix: str = "", suffix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.date_format(ts, SNAPSHOT_FORMAT), F.lit(suffix))


def normalise_strings(df: DataFrame) -> DataFrame:
    """Every column as string, empty strings as null."""
    return df.select([F.nullif(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def zero_fill(df: DataFrame) -> DataFrame:
    return df.fillna(0)


def flatten_lists(df: DataFrame) -> DataFrame:
    """One row per element of each list column; scalars are repeated, order is kept in `pos`."""
    lists = [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    if not lists:
        return df
    scalars = [c for c in df.columns if c not in lists]
    zipped = F.arrays_zip(*[F.col(c) for c in lists])
    rows = df.select(*scalars, F.posexplode_outer(zipped).alias("pos", "item"))
    return rows.select(*scalars, "pos", *[F.col(f"item.{c}").alias(c) for c in lists])


def front(df: DataFrame, *cols: str, **renamed: str) -> DataFrame:
    """Named columns first, then the rest; `new=old` renames."""
    head = [F.col(c) for c in cols] + [F.col(old).alias(new) for new, old in renamed.items()]
    used = set(cols) | set(renamed.values())
    return df.select(*head, *[F.col(c) for c in df.columns if c not in used])


def clean_names(df: DataFrame, strip: str = "@") -> DataFrame:
    return df.toDF(*[c.replace(strip, "") for c in df.columns])


def stamp(df: DataFrame, **constants) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def drop_null(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


def with_model_card(df: DataFrame, card: DataFrame) -> DataFrame:
    """Put the one-row card on every row as a scalar subquery: no join, and two rows are an error."""
    one = card.select(F.struct(*card.columns).alias("card")).scalar()
    out = df.withColumn("_card", one)
    return out.select(*df.columns, *[F.col(f"_card.{c}").alias(c) for c in card.columns])
