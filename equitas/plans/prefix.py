"""Distributed ordered prefix sums.

A global ``sum() over (order by v)`` or ``row_number()`` without a partition
puts every row into one task. This module gives the same results with
bounded tasks:

1. range-partition the rows on ``keys + order`` (Spark samples the bounds, so a
   hot key is split over many partitions) and checkpoint the result, so that
   the partition id assigned to each row is fixed for every later branch;
2. sum each (key, partition) block, a table with at most ``keys x P`` rows,
   and turn those block totals into per-key exclusive offsets;
3. add a window sum inside each (key, partition) block plus its offset.

Order columns must be unique within ``keys`` (callers aggregate first).
When a size check shows that no key has more than ``WINDOW_MAX_ROWS`` rows,
a plain window per key is used instead (its tasks are bounded by that size, and
the whole-number sums are the same). Without a key the ranges are always used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import default_parallelism, reliable_checkpoint

PID = "_pid"
# Keys with at most this many rows are summed by one window each: one task
# sorts and scans them (seconds of work; the window buffer spills to disk).
WINDOW_MAX_ROWS = 200_000
# Rows per range partition on the distributed path: the range count grows
# with the data instead of staying at the session's shuffle width.
ROWS_PER_RANGE = 4_000_000


def _null_safe_join(left: DataFrame, right: DataFrame, cols: Sequence[str],
                    broadcast_right: bool) -> DataFrame:
    r = right
    for c in cols:
        r = r.withColumnRenamed(c, f"_r_{c}")
    if broadcast_right:
        r = F.broadcast(r)
    cond = [left[c].eqNullSafe(r[f"_r_{c}"]) for c in cols]
    out = left.join(r, cond, "inner")
    return out.drop(*[f"_r_{c}" for c in cols])


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   sum_cols: Sequence[str], num_partitions: int | None = None,
                   with_key_totals: bool = False, size_hint: int | None = None,
                   most_rows: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum of ``c`` within ``keys`` ordered by
    ``order``) for every ``c`` in ``sum_cols``; optionally ``tot_<c>`` per key.

    ``size_hint`` is an estimate of the largest key's row count (e.g. from
    HyperLogLog); with a 2x margin under the window bound it replaces the
    exact size-check job. ``most_rows`` is a proven bound of that count and
    needs no margin.
    """
    keys, order, sum_cols = list(keys), list(order), list(sum_cols)
    spark = df.sparkSession
    total = 0
    if num_partitions is None and not keys:
        total = df.count()
    elif num_partitions is None:
        # size check: when no key holds more than WINDOW_MAX_ROWS rows, one
        # window per key is bounded and skips the sample / checkpoint / join
        if most_rows is not None and most_rows <= WINDOW_MAX_ROWS:
            largest = most_rows
        elif size_hint is not None and size_hint * 2 <= WINDOW_MAX_ROWS:
            largest = size_hint
        else:
            sizes = df.groupBy(*keys).count().agg(F.max("count"), F.sum("count")).first()
            largest, total = sizes[0] or 0, sizes[1] or 0
        if largest <= WINDOW_MAX_ROWS:
            run = Window.partitionBy(*keys).orderBy(*order).rowsBetween(
                Window.unboundedPreceding, Window.currentRow)
            cols = [F.sum(c).over(run).alias(f"cum_{c}") for c in sum_cols]
            if with_key_totals:
                whole = Window.partitionBy(*keys)
                cols += [F.sum(c).over(whole).alias(f"tot_{c}") for c in sum_cols]
            return df.select("*", *cols)
    p = num_partitions or max(default_parallelism(spark), -(-total // ROWS_PER_RANGE))
    ranged = df.repartitionByRange(p, *[F.col(c).asc_nulls_first() for c in keys + order])
    ranged = reliable_checkpoint(ranged.withColumn(PID, F.spark_partition_id()))

    blocks = ranged.groupBy(*keys, PID).agg(*[F.sum(c).alias(f"_blk_{c}") for c in sum_cols])
    before = Window.partitionBy(*keys).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offs = [F.coalesce(F.sum(f"_blk_{c}").over(before), F.lit(0)).alias(f"_off_{c}")
            for c in sum_cols]
    if with_key_totals:
        whole = Window.partitionBy(*keys)
        offs += [F.sum(f"_blk_{c}").over(whole).alias(f"tot_{c}") for c in sum_cols]
    offsets = blocks.select(*keys, PID, *offs)

    inside = Window.partitionBy(*keys, PID).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(c).over(inside).alias(f"_loc_{c}") for c in sum_cols])
    # Offsets hold one row per (key, block): at most P rows when there is no key.
    joined = _null_safe_join(local, offsets, keys + [PID], broadcast_right=not keys)
    out = joined.select(
        *[c for c in local.columns if not c.startswith("_loc_") and c != PID],
        *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"cum_{c}") for c in sum_cols],
        *([F.col(f"tot_{c}") for c in sum_cols] if with_key_totals else []),
    )
    return out


def row_index(df: DataFrame, order: Sequence[str], name: str = "row_idx",
              keys: Sequence[str] = ()) -> DataFrame:
    """0-based dense position by ``order`` (unique), like ``row_number() - 1``,
    without a single-partition window."""
    tmp = df.withColumn("_one", F.lit(1).cast("long"))
    out = running_totals(tmp, keys, order, ["_one"])
    return out.withColumn(name, F.col("cum__one") - 1).drop("_one", "cum__one")
