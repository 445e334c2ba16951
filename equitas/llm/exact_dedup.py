"""Operator 10: exact dedup by a tree-merge of sorted digest runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .handover import BLANK, columns_of, fresh, handover, only, width

#: Runs that one merge takes at a time.
FAN_IN = 16
#: What tells two texts apart: SHA-256, and two further checks that must agree.
TEXT_KEY = ["digest", "n_bytes", "check"]


def normal_text(column: str = "text"):
    """The text with each stretch of white space as one space; null as empty."""
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")), BLANK, " ")


def _merge(runs: DataFrame) -> DataFrame:
    """One row per (run, text): the smallest row and how many rows it stands for."""
    return runs.groupBy("run", "section", *TEXT_KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def merge_tree(leaves: DataFrame, runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """Merge the runs of all partitions, ``fan_in`` at a time, until one is left.

    ``leaves`` holds one sorted run per input partition (run, section, text key,
    best, n). In each round the runs of ``fan_in`` neighbours are exchanged
    section by section, read in digest order and merged: of rows whose digest,
    length and check agree the smallest stays, and their counts add up. The
    last run is spread over all sections, so no task holds it whole.
    """
    if fan_in < 2:
        raise ValueError("fan_in must be at least 2")
    n, level = width(leaves.sparkSession), leaves
    while runs > 1:
        dealt = level.withColumn("run", F.expr(f"run div {fan_in}").cast("int")).repartition(n, "run", "section")
        level = _merge(dealt.sortWithinPartitions("run", "section", *TEXT_KEY))
        runs = -(-runs // fan_in)
    return level


def exact_groups(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """For every row, the row that stays of all with the same normalised text.

    Normalised: every stretch of space, tab, LF, VT, FF or CR becomes one space;
    a null text counts as empty. Of equal texts the smallest doc_id stays (null
    ids last; of rows that also repeat the id, exactly one).

    Returns doc_id, keep_id, group_size, kept, text_sha256. An empty table
    gives no rows; further input columns are ignored.

    Up: each partition combines its own rows into a sorted run before anything
    is exchanged, so a text with a third of all rows is one row per partition
    from then on. Down: the answers go from the last run to the runs of the
    partitions, and from there to the rows, joined on (run, text), so a hot text
    is spread over as many keys as there are partitions.
    """
    spark = docs.sparkSession
    plain = normal_text()
    rows = handover(only(docs, "doc_id", "text").select(
        "doc_id", F.unhex(F.sha2(plain.cast("binary"), 256)).alias("digest"),
        F.octet_length(plain).alias("n_bytes"), F.xxhash64(plain).alias("check"),
        F.spark_partition_id().alias("run"), F.monotonically_increasing_id().alias("row")), "digests")
    section = F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") % (4 * width(spark))
    best = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    leaves = handover(_merge(rows.withColumns(
        {"section": section.cast("int"), "best": best, "n": F.lit(1).cast("long")})), "runs")
    count = (leaves.agg(F.max("run")).first()[0] or 0) + 1
    merged = merge_tree(leaves, count, fan_in).select(
        *TEXT_KEY, F.col("best").alias("keep"), F.col("n").alias("group_size"))
    answers = leaves.select("run", *TEXT_KEY).join(merged, TEXT_KEY)
    out = rows.join(answers, ["run", *TEXT_KEY])
    return out.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(docs: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """The documents that stay, with all their columns.

    Documents meet the kept (id, digest) pairs on one key; a row that repeats a
    kept id and text is cut by its rank on the same key, so texts move once.
    """
    name, rank = fresh(docs, "_text_key"), fresh(docs, "_copy")
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    kept = exact_groups(docs, fan_in).where("kept").select(F.concat_ws(":", ident, F.col("text_sha256")).alias(name))
    keyed = docs.withColumn(name, F.concat_ws(":", ident, F.sha2(normal_text().cast("binary"), 256)))
    once = Window.partitionBy(name).orderBy(F.lit(1))
    return (keyed.join(kept, name, "left_semi").withColumn(rank, F.row_number().over(once))
            .where(F.col(rank) == 1).select(*columns_of(docs)))
