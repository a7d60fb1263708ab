"""Article feed: time-windowed pulls and the pull schedule."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.functions.scalars import lookback_minutes
from presslens.operators.dedupe import keep_first, newest

# Fixed value: most records per pull.
PULL_CAP = 250
# Hours with a second run, and its minute.
TWO_RUN_HOURS, SECOND_RUN_MINUTE = (7, 20), 40
LONGEST_LOOKBACK_HOURS = 4

# Columns of the feed table.
FEED_SCHEMA = T.StructType(
    [
        T.StructField("titleArticle", T.StringType()),
        T.StructField("urlArticle", T.StringType()),
        T.StructField("modeSearch", T.StringType()),
        T.StructField("sourcecountrySearch", T.StringType()),
        T.StructField("termSearch", T.StringType()),
        T.StructField("periodtimeSearch", T.StringType()),
        T.StructField("isOR", T.BooleanType()),
        T.StructField("countMaximumRecords", T.IntegerType()),
        T.StructField("urlArticleMobile", T.StringType()),
        T.StructField("datetimeArticle", T.TimestampType()),
        T.StructField("urlImage", T.StringType()),
        T.StructField("domainArticle", T.StringType()),
        T.StructField("languageArticle", T.StringType()),
        T.StructField("countryArticle", T.StringType()),
    ]
)


def read_feed(
    spark: SparkSession, path: str, schema: T.StructType = FEED_SCHEMA, on_error: str = "raise"
) -> DataFrame:
    """A stored feed.

    `on_error="empty"`: a pull that left no file is an empty table of the full schema, and files that
    cannot be read give no rows. Any other mistake, such as a wrong schema, still raises.
    """
    reader = spark.read.schema(schema)
    if on_error == "empty":
        reader = reader.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if on_error != "empty" or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def feed_pull(
    df: DataFrame,
    as_of: datetime,
    lookback: int,
    filters: dict | None = None,
    cap: int | None = None,
    key: str = "urlArticle",
    ts: str = "datetimeArticle",
    tie: str = "titleArticle",
) -> DataFrame:
    """Newest articles of the last minutes, at most `cap` if one is set, then one row per key (the newest)."""
    kind = df.schema[ts].dataType  # literals of the column's own type are pushed to the scan
    start, end = (F.lit(t.isoformat(" ")).cast(kind) for t in (as_of - timedelta(minutes=lookback), as_of))
    rows = df.filter((F.col(ts) > start) & (F.col(ts) <= end))
    for column, value in (filters or {}).items():
        rows = rows.filter(F.col(column) == value)
    capped = rows if cap is None else newest(rows, [F.desc(ts), F.asc(tie)], cap)
    age = F.lit(0) - F.unix_micros(F.col(ts).cast("timestamp"))
    return keep_first(capped, [key], [age, tie])


def pull_runs(ts: Column) -> Column:
    """All scheduled runs whose lookback window holds the moment, in time order.

    A run at r with lookback L covers (r - L, r]. There are at most ten candidates per row.
    """
    ts = ts.cast("timestamp")
    hour = F.date_trunc("hour", ts)
    minutes = [60 * h + m for h in range(LONGEST_LOOKBACK_HOURS + 1) for m in (0, SECOND_RUN_MINUTE)]
    candidates = F.array(*[hour + F.expr(f"INTERVAL {m} MINUTES") for m in minutes])

    def covers(run: Column) -> Column:
        scheduled = (F.minute(run) == 0) | F.hour(run).between(*TWO_RUN_HOURS)
        waited = F.unix_micros(run) - F.unix_micros(ts)
        lookback = lookback_minutes(F.hour(run)).cast("bigint") * 60_000_000
        return scheduled & (waited >= 0) & (waited < lookback)

    return F.filter(candidates, covers)


def pull_windows(df: DataFrame, ts: str = "ts") -> DataFrame:
    """One row per article and run that pulls it; stateless, so it works on streams too."""
    return df.withColumn("run_ts", F.explode(pull_runs(F.col(ts))))
