"""Column profiles: counts, nulls, cardinality, flags and numeric statistics.

All columns are profiled together: one aggregate pass for counts and moments; one
job of distinct counts with an aggregate per column (exact by default, HyperLogLog
with ``approx=True``), so that rows are not multiplied by the columns; one
distributed exact-quantile job for every numeric median; one job for sample
values, bounded by a random part of the rows first. Output is one row per column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.quantiles import exact_quantiles, unpivot_numeric

# Profile thresholds.
LIKELY_ID_RATIO = 0.95
LIKELY_ID_MIN_ROWS = 10
BINARY_MAX = 2
LOW_CARDINALITY_MAX = 15
SAMPLE_VALUES = 5
#: Share of the rows that bounds the sample values before they are shuffled.
SAMPLE_SHARE = 0.001

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, _NUMERIC)


def _q(c: str) -> str:
    return f"`{c}`"


def count_values(tables: Mapping[str, DataFrame], columns: Sequence[tuple[str, str]], distinct) -> dict:
    """(table, column) -> (rows, distinct values): one aggregate per table, all in one job."""
    wanted: dict[str, list[str]] = {}
    for t, c in columns:
        wanted.setdefault(t, []).append(c)
    parts = []
    for t, cols in wanted.items():
        for some in ([[c] for c in cols] if distinct is F.count_distinct else [cols]):
            # an exact count has an aggregate of its own, so rows are not multiplied by the columns
            row = tables[t].agg(F.count(F.lit(1)).alias("n"), *[
                distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(some)])
            parts.append(row.select(F.explode(F.array(*[
                F.struct(F.lit(t).alias("table"), F.lit(c).alias("column"), "n", F.col(f"d{i}").alias("d"))
                for i, c in enumerate(some)])).alias("s")).select("s.*"))
    if not parts:
        return {}
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.union(p)
    return {(r["table"], r["column"]): (r["n"], r["d"]) for r in rows.collect()}   # one row per column


def profile_columns(df: DataFrame, columns: Sequence[str] | None = None,
                    approx: bool = False, with_samples: bool = True,
                    with_medians: bool = True) -> DataFrame:
    """One row per column with the profile fields (see module doc)."""
    spark = df.sparkSession
    cols = list(columns or df.columns)
    numeric = [c for c in cols if is_numeric(df.schema[c].dataType)]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.count(F.col(_q(c))).alias(f"nn{i}")]
        if c in numeric:
            x = F.col(_q(c)).cast("double")
            aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"), F.avg(x).alias(f"av{i}"),
                     F.stddev_samp(x).alias(f"sd{i}")]
    stats = df.agg(*aggs)
    counts = count_values({"": df}, [("", c) for c in cols],
                          F.approx_count_distinct if approx else F.count_distinct)
    row = stats.first()     # one row of statistics
    card = {c: counts["", c][1] for c in cols}
    wide = spark.createDataFrame([tuple(row)], stats.schema)
    null_d = F.lit(None).cast("double")
    long = wide.select(F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(i).alias("position"),
            F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
            F.col("_n").alias("total_count"), (F.col("_n") - F.col(f"nn{i}")).alias("null_count"),
            F.lit(card[c]).cast("long").alias("cardinality"),
            F.lit(c in numeric).alias("is_numeric"),
            (F.col(f"mn{i}") if c in numeric else null_d).alias("min"),
            (F.col(f"mx{i}") if c in numeric else null_d).alias("max"),
            (F.col(f"av{i}") if c in numeric else null_d).alias("mean"),
            (F.col(f"sd{i}") if c in numeric else null_d).alias("std"),
        ) for i, c in enumerate(cols)])).alias("p")).select("p.*")
    n = F.col("total_count")
    long = long.select(
        "*",
        (F.col("null_count") / F.greatest(n, F.lit(1))).alias("null_pct"),
        (F.col("cardinality") / F.greatest(n, F.lit(1))).alias("unique_ratio"),
    ).select(
        "*",
        ((F.col("unique_ratio") > LIKELY_ID_RATIO) & (n > LIKELY_ID_MIN_ROWS)).alias("is_likely_id"),
        (F.col("cardinality") <= BINARY_MAX).alias("is_binary"),
        (F.col("cardinality") <= LOW_CARDINALITY_MAX).alias("is_low_cardinality"),
    )
    if numeric and with_medians:
        hint = max(card[c] or 0 for c in numeric)
        med = exact_quantiles(unpivot_numeric(df, numeric), ["_attr"], "_val", [0.5], approx=approx,
                              distinct_hint=hint)
        long = long.join(med.select(F.col("_attr").alias("column"), F.col("value").alias("median")),
                         "column", "left")  # both sides have one row per column
    else:
        long = long.withColumn("median", F.lit(None).cast("double"))
    if with_samples:
        long = long.join(sample_values(df, cols), "column", "left")
    return long


def _text_items(df: DataFrame, columns: Sequence[str], upto: dict | None = None) -> DataFrame:
    """(column, num, txt) rows of non-null values, those beyond a column's ``upto`` (num, txt) left out."""
    items = []
    for c in columns:
        number = is_numeric(df.schema[c].dataType)
        num = F.col(_q(c)).cast("double") if number else F.lit(None).cast("double")
        txt = F.col(_q(c)).cast("string")
        last = (upto or {}).get(c)
        if last is not None and number:
            txt = F.when((num < F.lit(last[0])) | ((num == F.lit(last[0])) & (txt <= F.lit(last[1]))), txt)
        elif last is not None:
            txt = F.when(txt <= F.lit(last[1]), txt)
        items.append(F.struct(F.lit(c).alias("column"), num.alias("num"), txt.alias("txt")))
    return df.select(F.explode(F.array(*items)).alias("s")).select("s.*").where(F.col("txt").isNotNull())


def _smallest(long: DataFrame, k: int) -> DataFrame:
    """The ``k`` smallest distinct values per column; Spark limits the groups before it shuffles them."""
    order = Window.partitionBy("column").orderBy(F.col("num").asc_nulls_last(), F.col("txt").asc())
    return long.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def sample_values(df: DataFrame, columns: Sequence[str], k: int = SAMPLE_VALUES) -> DataFrame:
    """column, sample_values: the ``k`` smallest distinct non-null values as text.

    Deterministic stand-in for "first k non-null rows" (Spark rows have no
    file order). Numbers sort numerically, everything else as text.

    The k-th smallest value of any part of the rows bounds the k smallest of
    all. A random part gives the bound, so some k / SAMPLE_SHARE values of a
    column are shuffled, whatever its size; the answer does not depend on it.
    """
    part = _smallest(_text_items(df.sample(SAMPLE_SHARE, 42), columns), k).where(F.col("rank") == k)
    upto = {r["column"]: (r["num"], r["txt"]) for r in part.collect()}      # one row per column
    return _smallest(_text_items(df, columns, upto), k).groupBy("column").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "txt"))),
                    lambda s: s["txt"]).alias("sample_values"))


def feature_stats(df: DataFrame, features: Sequence[str], approx: bool = False) -> DataFrame:
    """min / max / mean / median / std per numeric feature (scenario sliders)."""
    nums = [f for f in features if f in df.columns and is_numeric(df.schema[f].dataType)]
    p = profile_columns(df, nums, approx=approx, with_samples=False)
    return p.select(F.col("column").alias("feature"), "min", "max", "mean", "median", "std")
