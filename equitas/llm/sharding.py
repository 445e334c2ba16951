"""Operator 1: contiguous shards of equal bytes, from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .handover import handover, only
from .prefix import prefix_sums


def shard_by_bytes(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Put every document into one of ``shards`` contiguous runs of doc_id order.

    Documents in order of doc_id (nulls first, then text_crc32) are laid end to
    end; the total is cut at equal targets, and a document belongs to the shard
    in which its first byte lies. Sizes of shards therefore differ from the
    target by less than the longest document.

    Returns doc_id, size (UTF-8 bytes plus 1; null text: 1), text_crc32 (null
    text: of no bytes, 0), law ('bytes'), shard, slot (position in the shard,
    from 0), grown_shard (null: this law moves rows when a shard is added),
    global_slot (position in the whole order) and first_byte. Rows that repeat
    an id and text are all placed, in any order among themselves. An empty
    table gives no rows; further input columns are ignored.

    One scan reads the texts; all else moves (id, size, crc) rows.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    text = F.coalesce(F.col("text"), F.lit(""))
    thin = only(docs, "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = prefix_sums(thin, [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")],
                         {"first_byte": "size"}, index="global_slot")
    placed = handover(placed, "placed")
    total = placed.agg(F.sum("size")).first()[0] or 1
    # first_byte < total, so the quotient stays below the number of shards
    cut = placed.withColumn("shard", F.expr(f"cast(first_byte * {shards} div {total} as int)"))
    starts = cut.groupBy("shard").agg(F.min("global_slot").alias("_start"))   # one row per shard
    return cut.join(F.broadcast(starts), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("global_slot") - F.col("_start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "global_slot", "first_byte")
