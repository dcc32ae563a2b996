"""Sharding by proportional stratified interleaving.

Rows are put in a seeded order within each source. Row ``r`` of ``n`` stands at the fraction ``(2r - 1) / 2n``; sorted by
this fraction, every stretch of the sequence holds the sources in proportion. The sequence is cut into shards whose row
counts differ by one at most, so each shard matches the mixture to a row or two per source.

No source and no shard is ever sorted in one task. A rank within a source is the number of rows in lower ranges of the
seeded hash and the place inside of the range. The place in the whole sequence is found in the same way, over ranges of
the fraction; how many rows of a source lie below a range follows from its count alone.

Law ``rows``: shard counts are one apart at most. Defined results: a NULL text has no bytes; a NULL source is a source;
equal rows may swap places, which changes nothing; fewer rows than shards leave shards empty; an empty table gives no
rows. Ties of the fraction go by source, NULL last, then by the seeded hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, stored

RANGES = 1024


def _placed(docs: DataFrame, carry: Column, text: str, source: str, id_col: str, shards: int, seed: int) -> DataFrame:
    """One row per row of ``docs``: doc (what ``carry`` says), text measures, shard and slot."""
    order = F.xxhash64(F.lit(seed), docs[id_col], docs[text])
    raw = F.coalesce(docs[text], F.lit(""))
    rows = docs.select(
        carry.alias("doc"), docs[id_col].alias("id"), docs[source].alias("source"), order.alias("order"),
        (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw.cast("binary")).alias("text_crc32"),
    ).withColumn("range", F.shiftright("order", 54))
    counts = stored(rows.groupBy("source", "range").agg(F.count("*").alias("n")), "ranges")
    per_source = Window.partitionBy("source")
    below = F.sum("n").over(per_source.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(
        F.col("source").alias("s_source"), F.col("range").alias("s_range"),
        F.coalesce(below, F.lit(0).cast("long")).alias("below"), F.sum("n").over(per_source).alias("of"),
    )
    local = F.row_number().over(Window.partitionBy("source", "range").orderBy("order", "id"))
    ranked = (
        rows.withColumn("local", local)
        .join(starts, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("range") == F.col("s_range")))
        .withColumn("rank", F.col("below") + F.col("local"))
        .withColumn("stretch", F.expr(f"((2 * rank - 1) * {RANGES}) div (2 * of)"))
    )
    # rows of a source with n rows that lie below stretch b: the odd numbers up to (2nb - 1) / RANGES
    sources = counts.groupBy("source").agg(F.sum("n").alias("n"))
    lower = sources.select("n", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(RANGES - 1).cast("long"))).alias("b"))
    lower = lower.groupBy(F.col("b").alias("s_stretch")).agg(
        F.sum(F.expr(f"case when b = 0 then 0 else ((2 * n * b - 1) div {RANGES} + 1) div 2 end")).alias("lower"),
        F.sum("n").alias("total"),
    )
    fraction = (2 * F.col("rank") - 1) / (2 * F.col("of"))
    inside = F.row_number().over(
        Window.partitionBy("stretch").orderBy(fraction, F.col("source").asc_nulls_last(), "order", "id")
    )
    sequence = ranked.withColumn("inside", inside).join(lower, F.col("stretch") == F.col("s_stretch"))
    place = sequence.withColumn("place", F.col("lower") + F.col("inside") - 1)
    # the first total % shards shards hold one row more
    base, more = F.expr(f"total div {shards}"), F.col("total") % shards
    first = more * (base + 1)
    shard = F.when(F.col("place") < first, F.expr(f"place div (total div {shards} + 1)")).otherwise(
        more + F.expr(f"try_divide(place - (total % {shards}) * (total div {shards} + 1), total div {shards})").cast("long")
    )
    start = F.when(F.col("shard") <= more, F.col("shard") * (base + 1)).otherwise(first + (F.col("shard") - more) * base)
    return (
        place.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (F.col("place") - start).cast("long"))
        .select("doc", "size", "text_crc32", "shard", "slot")
    )


def interleaved(
    docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", shards: int = 16, seed: int = 29
) -> DataFrame:
    """One row per row: id, size (UTF-8 bytes and 1), text_crc32, law, shard, slot and grown_shard (NULL)."""
    placed = _placed(docs, docs[id_col], text, source, id_col, shards, seed)
    return placed.select(
        F.col("doc").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def sharded_documents(
    docs: DataFrame, text: str = "text", source: str = "source", id_col: str = "doc_id", shards: int = 16, seed: int = 29
) -> DataFrame:
    """The columns of ``docs`` as struct ``doc``, with shard and slot; other names cannot clash with those of ``docs``.

    Places are found on row numbers; the rows themselves are only joined to them.
    """
    kept = numbered(docs, "rows")
    doc = kept["doc"]
    narrow = kept.select("row", doc[id_col].alias("id"), doc[text].alias("text"), doc[source].alias("source"))
    placed = _placed(narrow, narrow["row"], "text", "source", "id", shards, seed)
    return kept.join(placed.select(F.col("doc").alias("row"), "shard", "slot"), "row").select("doc", "shard", "slot")
