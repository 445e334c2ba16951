"""Exact, distributed quantiles with linear interpolation.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, which the final merge holds in a single task. Here the
rows are first reduced to (key, value, count); a distributed running count
(:mod:`.prefix`) then tells which distinct value holds each wanted row rank.
Only the handful of rows that hold a target rank leave the executors.

Numeric values of large keys are bracketed first (:mod:`.brackets`): only the
values that can hold a wanted rank are shuffled, the others are counted.

There is one formula at every size: the two bracketing values, interpolated once.

``approx=True`` switches to ``percentile_approx`` (one pass, bounded sketch).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import prefix
from .brackets import bracket, inside_counts, key_sizes
from .prefix import running_totals


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probs: Sequence[float], with_codes: bool = False,
                    approx: bool = False, accuracy: int = 100000,
                    distinct_hint: int | None = None, count_col: str | None = None) -> DataFrame:
    """Return ``keys..., q_idx, prob, value`` (and ``code``, ``low_value`` when
    ``with_codes``): the interpolated quantile of ``value`` within each key.

    ``code`` is the same quantile taken over the 0-based dense rank of the
    values, and ``low_value`` the value at the lower bracketing row rank; they
    let callers bin non-numeric columns by rank without a join.

    ``count_col`` marks pre-aggregated input: each row stands for that many
    rows holding ``value`` (the result is the same as on the expanded rows).
    """
    keys = list(keys)
    probs = [float(p) for p in probs]
    if approx:
        if with_codes or count_col:
            raise ValueError("codes and pre-counted rows need the exact path")
        agg = df.groupBy(*keys).agg(
            F.percentile_approx(F.col(value).cast("double"), probs, accuracy).alias("_qs"))
        return agg.select(*keys, F.posexplode("_qs").alias("q_idx", "value")).select(
            *keys, "q_idx", F.element_at(F.array(*[F.lit(p) for p in probs]),
                                         F.col("q_idx") + 1).alias("prob"), "value")

    most_rows = narrowed = None
    hinted = distinct_hint is not None and distinct_hint * 2 <= prefix.WINDOW_MAX_ROWS
    if not (count_col or with_codes or hinted) and isinstance(df.schema[value].dataType, T.NumericType):
        sketch = key_sizes(df, keys, value, probs)
        if sketch is not None:
            most_rows = max((n for _, n, _ in sketch), default=0)
            if most_rows > prefix.WINDOW_MAX_ROWS:
                narrowed = inside_counts(df, keys, value, probs, bracket(sketch, probs))
    if narrowed is not None:
        ranked = running_totals(narrowed, keys, ["_seg", "_out", value], ["_c"], with_key_totals=True)
        ranked = ranked.where(F.col("_out") == 0)
    else:
        weight = F.sum(F.col(count_col).cast("long")) if count_col else F.count(F.lit(1))
        counted = (df.where(F.col(value).isNotNull())
                   .groupBy(*keys, value).agg(weight.alias("_c")))
        sums = ["_c"]
        if with_codes:
            counted = counted.withColumn("_one", F.lit(1).cast("long"))
            sums.append("_one")
        # rows per key here are distinct values per key: the estimate sizes the plan
        ranked = running_totals(counted, keys, [value], sums, with_key_totals=True,
                                size_hint=distinct_hint, most_rows=most_rows)

    n = F.col("tot__c")
    below = F.col("cum__c") - F.col("_c")
    holds = []
    for i, p in enumerate(probs):
        pos = F.lit(p) * (n - 1)
        lo = F.floor(pos)
        hi = F.ceil(pos)
        holds.append(F.struct(
            F.lit(i).alias("q_idx"), F.lit(p).alias("prob"), pos.alias("pos"),
            ((below <= lo) & (lo < F.col("cum__c"))).alias("is_lo"),
            ((below <= hi) & (hi < F.col("cum__c"))).alias("is_hi")))
    hit = F.filter(F.array(*holds), lambda s: s["is_lo"] | s["is_hi"])
    code = (F.col("cum__one") - 1).cast("double") if with_codes else F.lit(None).cast("double")
    picked = ranked.select(*keys, F.col(value).alias("_v"), code.alias("_code"),
                           F.explode(hit).alias("_h"))
    agg = picked.groupBy(*keys, F.col("_h.q_idx").alias("q_idx")).agg(
        F.first("_h.prob").alias("prob"),
        F.first("_h.pos").alias("pos"),
        F.max(F.when(F.col("_h.is_lo"), F.col("_v"))).alias("_v_lo"),
        F.max(F.when(F.col("_h.is_hi"), F.col("_v"))).alias("_v_hi"),
        F.max(F.when(F.col("_h.is_lo"), F.col("_code"))).alias("_c_lo"),
        F.max(F.when(F.col("_h.is_hi"), F.col("_code"))).alias("_c_hi"),
    )
    frac = F.col("pos") - F.floor("pos")
    cols = [*keys, "q_idx", "prob"]
    if with_codes:
        cols += [(F.col("_c_lo") + (F.col("_c_hi") - F.col("_c_lo")) * frac).alias("code"),
                 F.col("_v_lo").alias("low_value")]
        numeric = dict(df.dtypes)[value] not in ("string", "boolean")
        if numeric:
            cols.append(_lerp("_v_lo", "_v_hi", frac).alias("value"))
        return agg.select(*cols)
    return agg.select(*cols, _lerp("_v_lo", "_v_hi", frac).alias("value"))


def _lerp(lo: str, hi: str, frac):
    a = F.col(lo).cast("double")
    b = F.col(hi).cast("double")
    return F.when(a == b, a).otherwise(a + (b - a) * frac)


def exact_median_row(df: DataFrame, cols: Sequence[str], approx: bool = False) -> dict:
    """Medians of several numeric columns in one distributed job.

    Returns a small driver-side dict ``{column: median}`` (one value per column).
    """
    cols = list(cols)
    if not cols:
        return {}
    stacked = unpivot_numeric(df, cols)
    q = exact_quantiles(stacked, ["_attr"], "_val", [0.5], approx=approx)
    got = {r["_attr"]: r["value"] for r in q.collect()}
    return {c: got.get(c) for c in cols}


def unpivot_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(attr, value as double) rows; the stack is pipelined in the scan stage."""
    cols = list(cols)
    return df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("_attr"), F.col(f"`{c}`").cast("double").alias("_val")) for c in cols
    ])).alias("_s")).select("_s._attr", "_s._val")
