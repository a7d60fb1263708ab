"""Entity mentions by gazetteer, entity-type counts, surface-form counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from presslens.functions import text as tx
from presslens.functions.scalars import truncate
from presslens.operators.joins import lookup_join
from presslens.session import BROADCAST_ROWS, materialise

# The entity types asked for, their name space, the least confidence.
ENTITY_TYPES = [
    "Activity", "AnatomicalStructure", "ChemicalSubstance", "Disease", "Drug",
    "Organisation", "Person", "Protein", "Work",
]
TYPE_PATTERN = r"DBpedia:(\w+)"
MIN_CONFIDENCE = 0.5


def type_names(types) -> F.Column:
    """Type names inside a text such as `DBpedia:Person,Schema:Person`."""
    return F.regexp_extract_all(F.col(types) if isinstance(types, str) else types, F.lit(TYPE_PATTERN), 1)


def wanted_surfaces(
    gazetteer: DataFrame, min_conf: float = MIN_CONFIDENCE, types: list[str] | None = None
) -> DataFrame:
    """(surface, types) of gazetteer rows with enough confidence and a wanted type."""
    wanted = F.array(*[F.lit(t) for t in types or ENTITY_TYPES])
    rows = gazetteer.filter(F.col("confidence") >= min_conf)
    rows = rows.filter(F.arrays_overlap(type_names("types"), wanted))
    surface = F.array_join(tx.tokenize(F.col("surface")), " ")
    listed = F.flatten(F.sort_array(F.collect_set(F.split("types", ","))))
    rows = rows.groupBy(surface.alias("surface")).agg(F.array_join(F.array_distinct(listed), ",").alias("types"))
    return rows.filter("surface <> ''")


def trie(surfaces: DataFrame) -> DataFrame:
    """(level, prefix, longer, types): every beginning of a surface by its number of words.

    `types` is set where the beginning is a surface itself, `longer` where a surface goes on.
    """
    words = F.split("surface", " ")
    size = F.size(words)
    level = F.explode(F.sequence(F.lit(1), size))
    rows = surfaces.select("types", words.alias("words"), size.alias("size"), level.alias("level"))
    rows = rows.select("level", F.array_join(F.slice("words", F.lit(1), F.col("level")), " ").alias("prefix"), "types", (F.col("level") < F.col("size")).alias("longer"))
    ends = F.max(F.when(~F.col("longer"), F.col("types"))).alias("types")
    return rows.groupBy("level", "prefix").agg(F.max("longer").alias("longer"), ends)


def annotate(
    docs: DataFrame,
    gazetteer: DataFrame,
    min_conf: float = MIN_CONFIDENCE,
    types: list[str] | None = None,
    text: str = "text",
    max_chars: int | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row per mention: doc_id, start, surfaceForm, types; the longest match at each position.

    Surfaces are split into words as texts are, so `COVID-19` is found however it is written; a
    surface listed twice has the types of both rows; surfaces may have any number of words. The words
    from a position on are followed down a trie of all surfaces, one level per join, by the beginning
    they spell; most positions end at the first. A level holds one row per beginning, however many
    surfaces share it, and is broadcast only while it is small.
    """
    body = F.col(text) if max_chars is None else truncate(F.col(text), max_chars)
    words = docs.select("doc_id", tx.tokenize(body).alias("words"))
    nodes = materialise(trie(wanted_surfaces(gazetteer, min_conf, types)), "trie")
    width = nodes.agg(F.max("level")).first()[0] or 1

    def step(rows, level, how):
        table = nodes.filter(F.col("level") == level).select("prefix", F.col("longer").alias("_longer"), F.col("types").alias("_types"))
        return lookup_join(rows, table, "prefix", "doc_id", how, max_rows)

    rows = tx.word_windows(words, "words", width, ["doc_id"])
    ahead = [F.col(f"w{k}") for k in range(1, width)]
    rows = step(rows.select("doc_id", "pos", F.col("w0").alias("prefix"), *ahead), 1, "inner")
    found = F.struct(F.col("prefix").alias("surface"), F.col("_types").alias("types"))
    none = F.lit(None).cast("struct<surface: string, types: string>")
    for level in range(1, width + 1):
        hit = F.when(F.col("_types").isNotNull(), found).otherwise(F.col("hit") if level > 1 else none)
        rows = rows.select("doc_id", "pos", "prefix", hit.alias("hit"), F.coalesce("_longer", F.lit(False)).alias("longer"), *ahead[level - 1 :])
        if level < width:
            # Where no surface goes on, a text that no surface has keeps rows from meeting in one task.
            following = F.concat_ws(" ", "prefix", f"w{level}")
            off = F.concat_ws("\x01", F.lit(""), F.col("doc_id").cast("string"), F.col("pos").cast("string"))
            prefix = F.when(F.col("longer") & F.col(f"w{level}").isNotNull(), following).otherwise(off)
            rows = step(rows.select("doc_id", "pos", prefix.alias("prefix"), "hit", *ahead[level:]), level + 1, "left")
    best = rows.filter("hit IS NOT NULL")
    return best.select("doc_id", F.col("pos").alias("start"), F.col("hit.surface").alias("surfaceForm"), "hit.types")


def entity_counts(mentions: DataFrame, types: list[str] | None = None, id_col: str = "doc_id") -> DataFrame:
    """One row per document with mentions, one `entity_count_<type>` column per known type."""
    types = types or ENTITY_TYPES
    rows = mentions.select(id_col, F.explode(type_names("types")).alias("type"))
    counted = [F.count_if(F.col("type") == t).alias(f"entity_count_{t}") for t in types]
    return rows.groupBy(id_col).agg(*counted)


def with_entity_counts(docs: DataFrame, counts: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of every document; none found, or a failed annotation, gives zeros."""
    columns = [c for c in counts.columns if c.startswith("entity_count_")]
    return docs.join(counts, id_col, "left").fillna(0, columns)


def surface_counts(mentions: DataFrame, by: str) -> DataFrame:
    return mentions.groupBy(by, "surfaceForm").agg(F.count("*").alias("n"))
