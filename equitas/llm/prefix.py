"""Ordered prefix sums from per-partition totals, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .handover import handover, width

#: Ranges per shuffle task: enough for the tasks that sum them to come out even.
RANGES_PER_TASK = 4


def prefix_sums(df: DataFrame, order: Sequence[Column], sums: Mapping[str, str],
                group: str | None = None, index: str = "index") -> DataFrame:
    """Add, for every row, what stands before it in the given order.

    ``sums`` maps a new column to the long column whose total over all earlier
    rows (of the same ``group``, if given) it receives; ``index`` is the number
    of earlier rows. Null values count 0. Rows equal in ``order`` stand in some
    order among themselves. ``group`` must be a column without nulls.

    Rows are range-partitioned on (group, order), so a group of any size is cut
    into many ranges. Each range sums itself; the totals, one row per range and
    group, are summed over the ranges before and added. An empty input gives an
    empty output.
    """
    spark = df.sparkSession
    keys = ([F.col(group)] if group else [])
    tied = df.withColumn("_row", F.monotonically_increasing_id())
    order = [*order, F.col("_row").asc()]
    ranged = handover(
        tied.repartitionByRange(RANGES_PER_TASK * width(spark), *keys, *order)
        .withColumn("_range", F.spark_partition_id()), "ranges")

    value = {name: F.coalesce(F.col(c), F.lit(0)) for name, c in sums.items()}
    part = ["_range", *([group] if group else [])]
    totals = ranged.groupBy(*part).agg(
        F.count(F.lit(1)).alias("_n"), *(F.sum(v).alias(f"_t_{k}") for k, v in value.items()))
    # one row per range (and group that reaches into it), not per row of the input
    earlier = Window.orderBy("_range") if group is None else Window.partitionBy(group).orderBy("_range")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        *part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n0"),
        *(F.coalesce(F.sum(f"_t_{k}").over(earlier), F.lit(0)).alias(f"_b_{k}") for k in value))
    if group is None:
        base = F.broadcast(base)   # at most RANGES_PER_TASK x width rows

    inside = Window.partitionBy(*part).orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.select(
        "*", (F.row_number().over(inside) - 1).alias("_i"),
        *(F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_s_{k}") for k, v in value.items()))
    joined = summed.join(base, part)
    return joined.select(
        *df.columns, (F.col("_n0") + F.col("_i")).alias(index),
        *((F.col(f"_b_{k}") + F.col(f"_s_{k}")).alias(k) for k in value))
