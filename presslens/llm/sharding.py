"""Proportional stratified interleaving: shards of equal counts that all have the mixture of the whole.

Rows are shuffled by a seeded digest of their id and ranked within their source; the rank over the
size of the source is their place on a line from 0 to 1 on which every source is spread evenly. The
line is cut into pieces of equal counts. Ranks and places come from two windows, each over small
digest or place ranges plus the counts before them, so a source with a third of all rows is ranked
by thousands of tasks. DataFrame functions only.

Defined results: a null source is a source of its own; a null id or text is ranked like any other,
with size 16 and the checksum of no bytes for a null text; rows repeated in every column fill
neighbouring places; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslens.llm.store import Scratch

PLACES = 1 << 16
OVERHEAD = 16


def proportional_shards(
    docs: DataFrame, shards: int, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per row of `docs`."""
    scratch = Scratch(docs.sparkSession, "shards")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    draw = F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col).cast("string")).cast("binary"))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        draw.alias("draw"),
        F.substring(draw, 1, 3).alias("range"),
    )
    order = ["draw", "doc_id", "size", "text_crc32"]

    by_source = Window.partitionBy("source")
    counts = rows.groupBy("source", "range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(by_source.orderBy("range")) - F.col("n")
    counts = counts.select("source", "range", before.alias("before"), F.sum("n").over(by_source).alias("of")).alias("c")
    inside = F.row_number().over(Window.partitionBy("source", "range").orderBy(*order))
    ranked = rows.withColumn("inside", inside).alias("r")
    match = F.col("r.source").eqNullSafe(F.col("c.source")) & (F.col("r.range") == F.col("c.range"))
    place = (F.col("before") + F.col("inside") - F.lit(0.5)) / F.col("of")
    placed = ranked.join(counts, match).select("doc_id", "size", "text_crc32", "draw", place.alias("place"))
    piece = F.least(F.floor(F.col("place") * PLACES), F.lit(PLACES - 1)).cast("int")
    placed = scratch.put(placed.withColumn("piece", piece), "placed")

    # At most PLACES rows: the only window without a key.
    line = placed.groupBy("piece").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("piece")) - F.col("n")
    line = line.select("piece", before.alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    inside = F.row_number().over(Window.partitionBy("piece").orderBy("place", *order))
    spot = placed.withColumn("inside", inside).join(line, "piece")
    spot = spot.withColumn("spot", F.col("before") + F.col("inside") - 1)
    spot = spot.withColumn("shard", F.expr(f"spot * {shards} div total").cast("int"))
    start = F.expr(f"(shard * total + {shards - 1}) div {shards}")
    return spot.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("spot") - start).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
