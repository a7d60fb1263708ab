"""Queries over projections, filters, scalar functions, sorts, unions and reshapes."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.catalog.registry import RAW_CORPUS_SQL, query, raw_corpus, sql_clean_delete, table
from presslens.functions import scalars as sc
from presslens.functions import text as tx
from presslens.operators import dedupe
from presslens.plans.scoring import keep_positive
from presslens.sources.archive import stack


@query("null_url_filter", "SELECT page_id, url FROM pages WHERE nullif(regexp_extract(url, '[?#].*$'), '') IS NOT NULL")
def _(spark, sf):
    tail = F.nullif(F.regexp_extract("url", "[?#].*$", 0), F.lit(""))
    return sc.drop_null(table(spark, sf, "pages").withColumn("tail", tail), "tail").select("page_id", "url")


@query(
    "stringify_and_null_empty",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
    nullif(event_type, '') AS event_type, nullif(regexp_replace(props, '^.*[02468]}$', ''), '') AS props FROM events""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    odd = F.regexp_replace("props", "^.*[02468]}$", "").alias("props")
    return sc.normalise_strings(events.select("event_id", "user_id", "event_type", odd))


@query(
    "flatten_list_columns",
    """SELECT doc_id, i - 1 AS pos, lines[i] AS line, length(lines[i]) AS chars FROM
    (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM
      (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""",
)
def _(spark, sf):
    lines = F.split("text", "\n")
    sizes = F.transform(lines, lambda x: F.length(x).cast("bigint"))
    docs = table(spark, sf, "documents").select("doc_id", lines.alias("line"), sizes.alias("chars"))
    return sc.flatten_lists(docs).withColumn("pos", F.col("pos").cast("bigint"))


@query("rename_reorder", "SELECT doc_id, source AS outlet, text, lang, n_chars FROM documents")
def _(spark, sf):
    return sc.front(table(spark, sf, "documents"), "doc_id", outlet="source")


def _chosen(threshold):
    return f"""SELECT doc_id, CASE WHEN length(leading_paragraph) < {threshold} THEN remaining_content
        ELSE leading_paragraph END AS chosen FROM ({RAW_CORPUS_SQL})"""


@query("text_choice_by_length", _chosen(600))
def _(spark, sf):
    chosen = sc.choose_text(F.col("leading_paragraph"), F.col("remaining_content"), 600)
    return raw_corpus(spark, sf).select("doc_id", chosen.alias("chosen"))


@query("text_choice_research", _chosen(100))
def _(spark, sf):
    lead, body = F.col("leading_paragraph"), F.col("remaining_content")
    chosen = sc.choose_text(lead, body, sc.LEAD_MIN_CHARS_RESEARCH)
    return raw_corpus(spark, sf).select("doc_id", chosen.alias("chosen"))


@query("unite_columns", f"SELECT doc_id, concat_ws(' ', headlines, remaining_content) AS text FROM ({RAW_CORPUS_SQL})")
def _(spark, sf):
    text = sc.unite(F.col("headlines"), F.col("remaining_content"))
    return raw_corpus(spark, sf).select("doc_id", text.alias("text"))


@query("label_to_01", "SELECT doc_id, CASE WHEN quality = 1 THEN '1' WHEN quality = 0 THEN '0' END AS label FROM labels")
def _(spark, sf):
    return table(spark, sf, "labels").select("doc_id", sc.label01(F.col("quality") == 1).alias("label"))


@query(
    "label_not_null",
    "SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL",
)
def _(spark, sf):
    joined = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return sc.drop_null(joined, "quality").select("doc_id", "quality")


@query(
    "source_id_extract",
    "SELECT doc_id, nullif(regexp_extract(upper(source), '^([A-Z]+)[0-9]', 1), '') AS newspaper_id FROM documents",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", sc.source_code(F.upper("source")).alias("newspaper_id"))


EDGE = "' ' || chr(9) || chr(10) || chr(13)"


@query(
    "clean_text_space",
    r"""SELECT doc_id, trim(regexp_replace(text,
    '[^\p{L}\p{M}\p{N}\s\-]|(f|ht)tps?://.*[.|/].*', ' ', 'g'), """ + EDGE + ") AS clean FROM documents",
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.clean_space(F.col("text")).alias("clean"))


@query("clean_text_delete", f"SELECT doc_id, {sql_clean_delete()} AS clean FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.clean_delete(F.col("text")).alias("clean"))


@query(
    "min_length_gate",
    f"SELECT doc_id, CASE WHEN length(c) > 80 THEN c END AS gated FROM (SELECT doc_id, {sql_clean_delete()} c FROM documents)",
)
def _(spark, sf):
    gated = sc.score_gate(tx.clean_delete(F.col("text")))
    return table(spark, sf, "documents").select("doc_id", gated.alias("gated"))


@query("truncate_entity_text", "SELECT doc_id, substr(text, 1, 5000) AS entity_text FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", sc.truncate(F.col("text")).alias("entity_text"))


@query(
    "null_to_zero",
    """SELECT d.doc_id, coalesce(quality, 0) AS quality, coalesce(toxic, 0) AS toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return sc.zero_fill(docs.join(table(spark, sf, "labels"), "doc_id", "left"))


@query("keep_positive", "SELECT doc_id, CAST(toxic AS VARCHAR) AS prediction FROM labels WHERE toxic = 1")
def _(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", F.col("toxic").cast("string").alias("prediction"))
    return keep_positive(labels)


@query(
    "attach_model_card",
    """SELECT doc_id, lang, (SELECT avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END) FROM labels) AS model_accuracy,
    (SELECT count(*) FROM labels) AS sample_size FROM documents""",
)
def _(spark, sf):
    right = F.avg(F.when(F.col("quality") == F.col("toxic"), 1.0).otherwise(0.0))
    card = table(spark, sf, "labels").agg(right.alias("model_accuracy"), F.count("*").alias("sample_size"))
    return sc.with_model_card(table(spark, sf, "documents").select("doc_id", "lang"), card)


@query(
    "constant_and_run_columns",
    """SELECT doc_id, quality, 'random forests' AS model, 500 AS n_tree, 'gini' AS splitrule,
    '2024-01-31' AS fitted_on FROM labels""",
)
def _(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return sc.stamp(labels, model="random forests", n_tree=500, splitrule="gini", fitted_on="2024-01-31")


@query("snapshot_name", "SELECT event_id, 'news_' || strftime(ts, '%Y-%m-%d-%H-%M') || '.csv' AS name FROM events")
def _(spark, sf):
    name = sc.snapshot_name(F.col("ts"), "news_", ".csv")
    return table(spark, sf, "events").select("event_id", name.alias("name"))


@query("strip_name_prefix", "SELECT event_id, event_type AS types, props AS surfaceForm FROM events")
def _(spark, sf):
    events = table(spark, sf, "events")
    raw = events.select("event_id", F.col("event_type").alias("@types"), F.col("props").alias("@surfaceForm"))
    return sc.clean_names(raw)


@query("lowercase_trim", f"SELECT doc_id, trim(lower(text), {EDGE}) AS folded FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.strip(F.lower("text")).alias("folded"))


@query("char_length", "SELECT doc_id, length(text) AS chars FROM documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.length("text").cast("bigint").alias("chars"))


# ---- keep-first, rank, sort, limit ---------------------------------------------------------------


@query(
    "distinct_keep_first",
    """SELECT doc_id, text, lang, source, n_chars FROM
    (SELECT *, row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) r FROM documents) WHERE r = 1""",
)
def _(spark, sf):
    return dedupe.keep_first_by_text(table(spark, sf, "documents"), "text", ["lang"], ["doc_id"])


@query(
    "first_per_id",
    """SELECT conv_id, turn, role, text FROM
    (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) r FROM conversations) WHERE r = 1""",
)
def _(spark, sf):
    return dedupe.first_per_id(table(spark, sf, "conversations"), "conv_id", ["turn"])


@query("row_id", "SELECT conv_id, turn, conv_id || '-' || turn AS row_id, text FROM conversations")
def _(spark, sf):
    key = F.concat_ws("-", "conv_id", "turn").alias("row_id")
    return table(spark, sf, "conversations").select("conv_id", "turn", key, "text")


@query("latest_record", "SELECT event_id, event_type, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def _(spark, sf):
    return dedupe.latest(table(spark, sf, "events"), "ts", "event_id").select("event_id", "event_type", "user_id")


@query("order_desc", "SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source ORDER BY n DESC, lang, source")
def _(spark, sf):
    counts = table(spark, sf, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), "lang", "source")


@query("cap_records", "SELECT event_id, user_id, event_type FROM events ORDER BY ts DESC, event_id LIMIT 250")
def _(spark, sf):
    events = table(spark, sf, "events")
    return dedupe.newest(events, [F.desc("ts"), F.asc("event_id")], 250).select("event_id", "user_id", "event_type")


@query(
    "union_by_name",
    """SELECT doc_id, lang, source, NULL::VARCHAR AS n_chars FROM documents
    UNION ALL SELECT doc_id, NULL, source, CAST(n_chars AS VARCHAR) FROM documents""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    sizes = docs.select(F.col("n_chars").cast("string").alias("n_chars"), "source", "doc_id")
    return stack(docs.select("doc_id", "lang", "source"), sizes)


@query(
    "union_same_schema",
    "SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id AS id, text FROM benchmark",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "text")
    return docs.unionByName(table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text"))
