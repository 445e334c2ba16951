"""Narrow an exact quantile to the values that can hold it, before any shuffle.

1. One aggregation of quantile sketches per key (map-side partials, one row per
   key and task in the shuffle) gives a bracket of values around every wanted rank.
2. One pass counts what lies between the brackets and groups what lies inside
   by value, so the shuffle carries some thousandths of the distinct values.

A sketch only guides the second pass: whether each wanted rank lies inside its
bracket is checked on exact counts, and a miss falls back to grouping all values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import reliable_checkpoint

#: Rank error of a sketch is one row in so many; brackets reach twice as far on either side.
ACCURACY = 10_000
#: Keys whose brackets travel as a broadcast table (a few numbers each).
MAX_KEYS = 10_000

_INTERVALS = T.ArrayType(T.StructType([T.StructField("lo", T.DoubleType()), T.StructField("hi", T.DoubleType())]))


def key_sizes(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float]) -> list[tuple] | None:
    """(key values, rows, sketched values around each rank) per key; None above MAX_KEYS keys."""
    reach = 2 / ACCURACY
    points = [min(1.0, max(0.0, p + side)) for p in probs for side in (-reach, reach)]
    v = F.col(value).cast("double")
    rows = (df.where(F.col(value).isNotNull()).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx(v, points, ACCURACY).alias("_q"))
            .limit(MAX_KEYS + 1).collect())
    if len(rows) > MAX_KEYS:
        return None
    return [(tuple(r[: len(keys)]), r["_n"], r["_q"] or []) for r in rows]


def bracket(sketch: list[tuple], probs: Sequence[float]) -> dict[tuple, list[tuple]]:
    """Disjoint intervals (low, high) per key, in order; None is an open end."""
    reach = 2 / ACCURACY
    out = {}
    for key, n, q in sketch:
        ends = []
        for i, p in enumerate(probs):
            lo = None if p <= reach or math.isnan(q[2 * i]) else q[2 * i]
            hi = None if p >= 1 - reach or math.isnan(q[2 * i + 1]) else q[2 * i + 1]
            ends.append((None, None) if n <= ACCURACY else (lo, hi))
        ends.sort(key=lambda e: -math.inf if e[0] is None else e[0])
        merged: list[tuple] = []
        for lo, hi in ends:
            if merged and (merged[-1][1] is None or lo is None or lo <= merged[-1][1]):
                last = merged[-1][1]
                merged[-1] = (merged[-1][0], None if hi is None or last is None else max(hi, last))
            else:
                merged.append((lo, hi))
        out[key] = merged
    return out


def inside_counts(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                  intervals: dict[tuple, list[tuple]]) -> DataFrame | None:
    """(keys, _seg, _out, value, _c): values inside the intervals, counted one by one.

    What lies beyond interval ``_seg`` and below the next one is a single row of
    ``_out`` 1 without a value. None if a wanted rank falls on such a row.
    """
    keys = list(keys)
    spark = df.sparkSession
    v = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull()).select(*keys, value)
    if keys:
        schema = T.StructType([*(T.StructField(f"_k{i}", df.schema[k].dataType) for i, k in enumerate(keys)),
                               T.StructField("_iv", _INTERVALS)])
        table = spark.createDataFrame([(*k, iv) for k, iv in intervals.items()], schema)   # MAX_KEYS rows at most
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        rows = rows.join(F.broadcast(table), same).select(*keys, value, "_iv")
    else:
        flat = intervals.get((), [])
        rows = rows.withColumn("_iv", F.array(*(F.struct(
            F.lit(lo).cast("double").alias("lo"), F.lit(hi).cast("double").alias("hi")) for lo, hi in flat)))
    seg = F.size(F.filter("_iv", lambda x: x["lo"].isNull() | (v >= x["lo"])))
    top = F.get("_iv", F.col("_seg") - 1)["hi"]
    placed = rows.withColumn("_seg", seg)
    held = (F.col("_seg") > 0) & (top.isNull() | (v <= top))
    placed = placed.select(*keys, "_seg", F.when(held, 0).otherwise(1).alias("_out"),
                           F.when(held, F.col(value)).alias(value))
    counted = reliable_checkpoint(placed.groupBy(*keys, "_seg", "_out", value).agg(F.count(F.lit(1)).alias("_c")))

    runs: dict[tuple, list[tuple]] = {}
    for r in counted.groupBy(*keys, "_seg", "_out").agg(F.sum("_c").alias("_c")).collect():
        runs.setdefault(tuple(r[: len(keys)]), []).append((r["_seg"], r["_out"], r["_c"]))
    for parts in runs.values():
        n = sum(c for _, _, c in parts)
        wanted = {f(p * (n - 1)) for p in probs for f in (math.floor, math.ceil)}
        below = 0
        for _, out, c in sorted(parts):
            if out and any(below <= w < below + c for w in wanted):
                return None
            below += c
    return counted
