"""The registered training-data queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.text import bind
from presslens.llm import alignment, decontaminate, language, lines, nearcopy, packing, quality, runs, sentences, sharding, suffix, tokens, toxicity
from presslens.llm.store import Scratch, texts

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


SHARDS = 40

# CRC-32 bit by bit: eight rounds make the table of 256 values, list_reduce runs over the bytes.
_ROUND = "(CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
_CRC = "WITH RECURSIVE bits(b, c, k) AS (SELECT range, range, 0 FROM range(256) UNION ALL SELECT b, " + _ROUND + """, k + 1
    FROM bits WHERE k < 8), crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8)"""
_TEXT_CRC = """(SELECT xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, size - 15),
    lambda i: ('0x' || substr(hx, 2 * i - 1, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])),
    4294967295))"""


@query(
    "op8_proportional_shards",
    f"""{_CRC}, r AS (SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 16 AS size, hex(encode(coalesce(text, ''))) AS hx,
        md5('mix:' || doc_id) AS draw FROM documents),
    p AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY draw, doc_id) - 0.5::DOUBLE)
        / count(*) OVER (PARTITION BY source) AS place FROM r),
    s AS (SELECT *, row_number() OVER (ORDER BY place, draw, doc_id) - 1 AS spot, count(*) OVER () AS total FROM p)
    SELECT doc_id, size::BIGINT AS size, {_TEXT_CRC} AS text_crc32, 'rows' AS law, (spot * {SHARDS} // total)::INT AS shard,
    (spot - (spot * {SHARDS} // total * total + {SHARDS - 1}) // {SHARDS})::BIGINT AS slot, NULL::INT AS grown_shard
    FROM s, crc""",
)
def _(spark, sf):
    return sharding.proportional_shards(table(spark, sf, "documents"), SHARDS)


@query("op1_risk_controlled_quality")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    rows = docs.select("doc_id", F.col("lang").alias("stratum"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    measured = Scratch(spark, "quality").put(quality.measure(rows, "text"), "measured")
    labels = table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("good"))
    found = quality.verdicts(measured, labels, "stratum")
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "cutoff_level"
    )


@query("op3_digest_cache_tokens")
def _(spark, sf):
    return tokens.token_counts(table(spark, sf, "documents"), tokenizer())


@query("op4_bounded_space_packing")
def _(spark, sf):
    return packing.pack(table(spark, sf, "documents"), tokenizer())


@query("op7_superminhash_near_copies")
def _(spark, sf):
    return nearcopy.near_duplicates(table(spark, sf, "documents")).drop("class_id")


@query("op10_sentence_span_dedup")
def _(spark, sf):
    return sentences.drop_repeated_spans(table(spark, sf, "documents"))


@query("op9_positional_index_decontamination")
def _(spark, sf):
    found = decontaminate.Index(table(spark, sf, "documents"), table(spark, sf, "benchmark")).contamination()
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
        decontaminate.items_digest().alias("items_sha256"), decontaminate.contaminated().alias("contaminated"),
    )


@query("op6_string_kernel_language")
def _(spark, sf):
    return language.identify(table(spark, sf, "documents"), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)


@query("op2_ordinal_severity")
def _(spark, sf):
    """Grades: 0 not toxic, 1 toxic, 2 toxic and of low quality."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    grade = F.when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1)).when(F.col("toxic") == 0, 0)
    return toxicity.severity(docs, labels.select("doc_id", grade.alias("grade")))


@query("op5_difference_cover_dedup")
def _(spark, sf):
    found = suffix.drop_repeated_strings(table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth text, by the CRC-32 of its id, repeats a stretch of its words from some word on."""
    draw = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(draw / 10)

    def repeated(words):
        n = F.size(words)
        a = F.pmod(g, n).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")

        def from_numbers(first, period):
            return F.transform(words, lambda w, i: F.when(i < first, w).otherwise(F.get(words, first + F.pmod(i - first, period))))

        return F.when(n > 0, bind(a, lambda first: bind(p, lambda period: F.array_join(from_numbers(first, period), " "))))

    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    text = F.when(F.pmod(draw, F.lit(10)) == 0, F.coalesce(bind(words, repeated), F.col("text"))).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


@query("op13_periodic_runs")
def _(spark, sf):
    found = runs.periodic_runs(with_planted_runs(table(spark, sf, "documents"))).withColumn("best", runs.strongest())
    best = [F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")]
    exponent = F.expr("1000 * best.length div best.period").alias("exponent_milli")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *best, exponent,
        F.sha2(runs.listing(), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op12_bloom_line_dedup",
    f"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place FROM documents),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {lines.MIN_CHARS} GROUP BY key
        HAVING count(DISTINCT doc_id) >= {lines.MIN_DOCS}),
    d AS (SELECT k.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM k LEFT JOIN r ON k.key = r.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256 FROM d GROUP BY doc_id""",
)
def _(spark, sf):
    found = lines.drop_repeated_lines(table(spark, sf, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op11_fragment_alignment")
def _(spark, sf):
    return alignment.align(table(spark, sf, "documents"), tokenizer(), tokenizer("piece_bpe_32k.model"))
