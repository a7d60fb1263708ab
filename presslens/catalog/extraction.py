"""Queries over the feed, stored pages and streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from presslens.catalog.registry import query, table
from presslens.functions.scalars import LOOKBACK_BY_HOUR, NEGATIVE_MARKER, label_from_path, lookback_minutes
from presslens.session import new_path
from presslens.sinks.tables import write_rejects
from presslens.sources import feed, markup, pages
from presslens.streaming import flows

TIME = "yyyy-MM-dd HH:mm:ss"
SQL_TIME = "%Y-%m-%d %H:%M:%S"


# ---- feed ----------------------------------------------------------------------------------------


@query(
    "feed_window_pull",
    f"""WITH newest AS (SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-05 12:00:00' AND ts <= TIMESTAMP '2024-01-15 12:00:00'
    AND event_type = 'click' ORDER BY ts DESC, event_id LIMIT 250)
    SELECT user_id, event_id, strftime(ts, '{SQL_TIME}') AS ts FROM
    (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) r FROM newest) WHERE r = 1""",
)
def _(spark, sf):
    pulled = feed.feed_pull(
        table(spark, sf, "events"), datetime(2024, 1, 15, 12), 14_400, {"event_type": "click"},
        feed.PULL_CAP, key="user_id", ts="ts", tie="event_id",
    )
    return pulled.select("user_id", "event_id", F.date_format("ts", TIME).alias("ts"))


@query("feed_fetch_failure_to_empty", "SELECT event_id, user_id, event_type, value, props FROM events")
def _(spark, sf):
    # one pull succeeds, the next one's file is missing and adds no row
    schema = table(spark, sf, "events").schema
    good = feed.read_feed(spark, f"{sf}/events.parquet", schema)
    failed = feed.read_feed(spark, f"{sf}/events-not-there.parquet", schema, on_error="empty")
    return good.unionByName(failed).drop("ts")


LOOKBACK = "CASE " + " ".join(f"WHEN hour({{0}}) BETWEEN {low} AND {high} THEN {minutes}" for low, high, minutes in LOOKBACK_BY_HOUR) + " END"


@query("lookback_by_hour", f"SELECT event_id, {LOOKBACK.format('ts')} AS minutes FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_id", lookback_minutes(F.hour("ts")).alias("minutes"))


PATHS = f"'data/labeled_data/' || CASE WHEN lang = 'en' THEN '{NEGATIVE_MARKER}' ELSE source END || '-' || doc_id || '.json'"


@query("label_from_filename", f"SELECT doc_id, split_part(split_part({PATHS}, '/', 3), '-', 1) <> '{NEGATIVE_MARKER}' AS is_covid FROM documents")
def _(spark, sf):
    name = F.when(F.col("lang") == "en", F.lit(NEGATIVE_MARKER)).otherwise(F.col("source"))
    path = F.concat(F.lit("data/labeled_data/"), name, F.lit("-"), F.col("doc_id"), F.lit(".json"))
    return table(spark, sf, "documents").select("doc_id", label_from_path(path).alias("is_covid"))


# ---- pages ---------------------------------------------------------------------------------------


# The references that the test pages have, `&amp;` last.
WRITTEN = {"nbsp": " ", "lt": "<", "gt": ">", "quot": '"', "#39": "'", "copy": "©", "middot": "·", "amp": "&"}


def sql_plain(markup: str) -> str:
    text = f"regexp_replace({markup}, '<[^>]*>', ' ', 'g')"
    for entity, char in ((f"&{name};", char) for name, char in WRITTEN.items()):
        text = f"replace({text}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return f"nullif(trim(regexp_replace({text}, '\\s+', ' ', 'g')), '')"


BODY = f"regexp_replace(html, '{pages.NOISE}', ' ', 'g')"
TITLE = sql_plain(f"regexp_extract(html, '{pages.TITLE}', 1)")
MAINTEXT = sql_plain(f"regexp_extract({BODY}, '{pages.ARTICLE}', 1)")
PARAGRAPHS = f"""list_filter(list_transform(regexp_extract_all({BODY}, '{pages.PARAGRAPH}', 1),
    lambda p: {sql_plain('p')}), lambda p: p IS NOT NULL)"""
PARSED = f"SELECT page_id, url, {TITLE} AS title, {MAINTEXT} AS maintext FROM pages"
# With the fallback: headings and paragraphs where title or article are missing.
COMPLETED = f"""SELECT page_id, url, coalesce({TITLE}, {sql_plain(f"regexp_extract(html, '{pages.HEADING}', 1)")}) AS title,
    coalesce({MAINTEXT}, nullif(array_to_string({PARAGRAPHS}, ' '), '')) AS maintext FROM pages"""


@query("page_article_extract", f"SELECT page_id, url, title, maintext, NULL::VARCHAR AS description FROM ({PARSED})")
def _(spark, sf):
    return pages.extract_articles(table(spark, sf, "pages")).select("page_id", "url", "title", "maintext", "description")


@query(
    "page_article_parse",
    f"""SELECT page_id, url, coalesce(title, heading) AS title, maintext, NULL::VARCHAR AS description, '' AS authors, NULL::VARCHAR AS date_publish,
    '2024-01-31 12:00:00' AS date_download FROM
    (SELECT *, {sql_plain(f"regexp_extract(html, '{pages.HEADING}', 1)")} AS heading FROM (SELECT *, {TITLE} AS title, {MAINTEXT} AS maintext FROM pages))""",
)
def _(spark, sf):
    """All fields, by the tag stack instead of patterns."""
    parsed = markup.parse_articles(table(spark, sf, "pages"), "2024-01-31 12:00:00")
    times = [F.date_format(c, TIME).alias(c) for c in ("date_publish", "date_download")]
    return parsed.select("page_id", "url", "title", "maintext", "description", F.array_join("authors", "|").alias("authors"), *times)


@query(
    "extract_with_fallback",
    f"""SELECT page_id, title, paragraphs[1] AS description, array_to_string(paragraphs, ' ') AS maintext FROM
    (SELECT page_id, {sql_plain(f"regexp_extract(html, '{pages.HEADING}', 1)")} AS title, {PARAGRAPHS} AS paragraphs FROM pages)""",
)
def _(spark, sf):
    # without <title> and <article> every field has to come from the fallback
    bare = F.regexp_replace("html", "(?is)</?article[^>]*>|<title.*?</title>", "")
    parsed = pages.extract_articles(table(spark, sf, "pages").withColumn("html", bare), fallback=True)
    return parsed.select("page_id", "title", "description", "maintext")


LINKS = f"regexp_extract_all(regexp_extract(html, '{pages.NAV}', 1), '{pages.LINK}', 1)"


@query(
    "authors_explode",
    f"""SELECT page_id, url, pos - 1 AS pos, {sql_plain('links[pos]')} AS author FROM
    (SELECT page_id, url, links, unnest(range(1, len(links) + 1)) AS pos FROM (SELECT page_id, url, {LINKS} AS links FROM pages))""",
)
def _(spark, sf):
    listed = table(spark, sf, "pages").select("page_id", "url", pages.link_texts(F.col("html")).alias("authors"))
    return pages.explode_authors(listed).withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "parse_failure_to_empty",
    f"""SELECT page_id, title FROM (SELECT page_id, {TITLE} AS title,
    {sql_plain(f"regexp_extract({BODY}, '{pages.ARTICLE}', 1)")} AS maintext
    FROM (SELECT page_id, regexp_replace(html, '(?is)<title>[a-m].*?</title>', '') AS html FROM pages))
    WHERE title IS NOT NULL AND maintext IS NOT NULL""",
)
def _(spark, sf):
    # pages whose title starts with a-m lose it, and so fail to parse
    broken = F.regexp_replace("html", "(?is)<title>[a-m].*?</title>", "")
    parsed = pages.extract_articles(table(spark, sf, "pages").withColumn("html", broken), errors="drop")
    return parsed.select("page_id", "title")


SPLIT_AT = 800


@query(
    "parse_reject_split",
    f"""SELECT page_id, url, CASE WHEN maintext IS NULL THEN 'no text' WHEN length(maintext) < {SPLIT_AT} THEN 'short text'
    ELSE 'kept' END AS status FROM ({PARSED})""",
)
def _(spark, sf):
    kept, rejects = pages.split_rejects(pages.extract_articles(table(spark, sf, "pages")), SPLIT_AT)
    sides = kept.withColumn("reason", F.lit("kept")).unionByName(rejects)
    return sides.select("page_id", "url", F.col("reason").alias("status"))


@query(
    "reject_log",
    f"""SELECT title, url, CASE WHEN maintext IS NULL THEN 'no text' ELSE 'short text' END AS reason, '2024-01-31-12-00' AS snapshot
    FROM ({PARSED}) WHERE maintext IS NULL OR length(maintext) < {SPLIT_AT}""",
)
def _(spark, sf):
    _, rejects = pages.split_rejects(pages.extract_articles(table(spark, sf, "pages")), SPLIT_AT)
    path = new_path(spark, "rejects")
    write_rejects(rejects, path, "2024-01-31 12:00:00")
    schema = "title string, url string, reason string, snapshot string"
    return spark.read.schema(schema).parquet(path)


# ---- streams -------------------------------------------------------------------------------------

RUNS = f"""runs AS (SELECT event_id, user_id, ts, r AS run_ts FROM
    (SELECT event_id, user_id, ts, date_trunc('hour', ts) + to_minutes(CAST(60 * h + m AS INTEGER)) AS r FROM events,
      (SELECT unnest([0, 1, 2, 3, 4]) AS h), (SELECT unnest([0, 40]) AS m))
    WHERE (minute(r) = 0 OR hour(r) BETWEEN 7 AND 20) AND r >= ts AND ts > r - to_minutes({LOOKBACK.format('r')}))"""


def stream(spark, sf):
    events = table(spark, sf, "events")
    return flows.read_stream(spark, f"{sf}/events*.parquet", events.schema)


@query("stream_ingest", "SELECT event_id, user_id, event_type, value, props FROM events")
def _(spark, sf):
    rows = stream(spark, sf).select("event_id", "user_id", "event_type", "value", "props")
    return flows.run_to_table(rows, "ingest")


@query("stream_lookback_windows", f"WITH {RUNS} SELECT event_id, strftime(run_ts, '{SQL_TIME}') AS run_ts FROM runs")
def _(spark, sf):
    rows = feed.pull_windows(stream(spark, sf)).select("event_id", F.date_format("run_ts", TIME).alias("run_ts"))
    return flows.run_to_table(rows, "windows")


@query("stream_dedupe", f"WITH {RUNS} SELECT DISTINCT event_id, user_id FROM runs")
def _(spark, sf):
    # every run sends the article again; the copies share their time, so the salt is the run
    copies = feed.pull_windows(stream(spark, sf))
    once = flows.dedupe_stream(copies, ["event_id"], salts=4, salt_on="run_ts")
    return flows.run_to_table(once.select("event_id", "user_id"), "dedupe")


@query(
    "articles_per_window",
    f"""SELECT strftime(date_trunc('hour', ts), '{SQL_TIME}') AS window_start, count(*) AS articles FROM events
    WHERE date_trunc('hour', ts) + to_minutes(60) <= (SELECT max(ts) FROM events) - to_minutes(240) GROUP BY 1""",
)
def _(spark, sf):
    # a window is emitted once the watermark, 240 minutes behind the newest article, has passed it
    counted = flows.window_counts(stream(spark, sf))
    return flows.run_to_table(counted.select(F.date_format("window_start", TIME).alias("window_start"), "articles"), "windows")
