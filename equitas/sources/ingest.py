"""Bronze ingest, validation, preview and the sinks of every stage."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import python_list_text

# Validation minimums (reported, never blocking).
MIN_ROWS = 50
MIN_COLUMNS = 3


def load_csv(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """CSV with a header row; types inferred unless a schema is given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def _is_float(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN of float columns as null, so that one notion of "missing" holds from here on."""
    if not any(_is_float(f.dataType) for f in df.schema.fields):
        return df
    return df.select(*[
        F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)).alias(f.name) if _is_float(f.dataType)
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def ingest(spark: SparkSession, source=None, *, path: str | None = None,
           table_name: str | None = None, fmt: str | None = None) -> DataFrame:
    """Resolve a source in the order: DataFrame > path > catalog table; NaN becomes null.

    Paths pick their reader from ``fmt`` or the suffix (csv / json / parquet /
    orc); a bare name is read from the catalog (``spark.table``).
    """
    return nan_to_null(_resolve(spark, source, path, table_name, fmt))


def _resolve(spark: SparkSession, source, path: str | None, table_name: str | None,
             fmt: str | None) -> DataFrame:
    if isinstance(source, DataFrame):
        return source
    if isinstance(source, str) and path is None and table_name is None:
        if "/" in source or "." in source.rsplit("/", 1)[-1]:
            path = source
        else:
            table_name = source
    if path is not None:
        kind = (fmt or path.rstrip("/").rsplit(".", 1)[-1]).lower()
        if kind == "csv":
            return load_csv(spark, path)
        if kind in ("json", "jsonl"):
            return spark.read.json(path)
        if kind == "orc":
            return spark.read.orc(path)
        return spark.read.parquet(path)
    if table_name is not None:
        return spark.table(table_name)
    raise ValueError("no source given: pass a DataFrame, a path or a table name")


def cached_dataset(spark: SparkSession, name: str, cache_dir: str, source=None,
                   refresh: bool = False) -> DataFrame:
    """A named dataset read through a Parquet cache under ``cache_dir``.

    The cached copy is used when it exists (unless ``refresh``); otherwise
    ``source`` (anything :func:`ingest` takes) is read once, written to the
    cache, and the cached copy is returned, so later runs skip the source.
    """
    path = f"{cache_dir.rstrip('/')}/{name}"
    if not refresh:
        try:
            return spark.read.parquet(path)
        except AnalysisException:   # not cached yet
            pass
    if source is None:
        raise FileNotFoundError(f"dataset {name!r} is not cached and no source was given")
    ingest(spark, source).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def validate(df: DataFrame) -> DataFrame:
    """One row: totals, null counts per column, issues; never raises."""
    cols = df.columns
    df = nan_to_null(df)
    nulls = df.agg(F.count(F.lit(1)).alias("total_rows"),
                   *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    ncols = len(cols)
    null_map = F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                                 F.array(*[F.col(f"n{i}") for i in range(ncols)])) if cols \
        else F.create_map().cast("map<string,bigint>")
    total_nulls = sum((F.col(f"n{i}") for i in range(ncols)), F.lit(0).cast("long"))
    rows = F.col("total_rows")
    issues = F.array_compact(F.array(
        F.when(rows < MIN_ROWS, F.format_string(
            f"Dataset too small: %d rows (minimum {MIN_ROWS} expected)", rows)),
        F.lit(f"Too few columns: {ncols} (minimum {MIN_COLUMNS} expected)") if ncols < MIN_COLUMNS
        else F.lit(None).cast("string"),
    ))
    return nulls.select(
        rows.alias("total_rows"), F.lit(ncols).alias("total_columns"),
        null_map.alias("null_counts"), total_nulls.alias("total_nulls"),
        (total_nulls > 0).alias("has_nulls"), (F.size(issues) == 0).alias("valid"),
        issues.alias("issues"))


def column_types(df: DataFrame) -> DataFrame:
    """(position, column, dtype): the columns as they were read; no rows are touched."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string")


def preview(df: DataFrame, n: int = 5) -> tuple[list[tuple[str, str]], DataFrame]:
    """(column dtypes, first ``n`` rows). Rows have no file order in Spark: this is
    ``limit(n)``, a preview only."""
    return df.dtypes, df.limit(n)


# --------------------------------------------------------------------------- sinks

def write_silver(features: DataFrame, sensitive: Sequence[str], path: str,
                 fmt: str = "parquet") -> None:
    """Silver features and the sensitive columns as two outputs (overwrite)."""
    features.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/features")
    keep = [c for c in sensitive if c in features.columns]
    features.select(*[F.col(f"`{c}`") for c in keep]).write.mode("overwrite").format(fmt).save(
        f"{path.rstrip('/')}/sensitive_attributes")


def write_gold(gold: DataFrame, path: str, formats: Sequence[str] = ("parquet", "json", "csv")) -> None:
    """Gold as Parquet (native arrays), JSON records and CSV (factor list as text)."""
    base = path.rstrip("/")
    for fmt in formats:
        out = gold
        if fmt == "csv":
            out = gold.withColumn("top_factors", python_list_text(F.col("top_factors")))
            out.write.mode("overwrite").option("header", True).csv(f"{base}/csv")
        else:
            out.write.mode("overwrite").format(fmt).save(f"{base}/{fmt}")


def write_importance(importance: DataFrame, path: str, top: int = 20) -> None:
    """Global importance, largest first, top ``top`` rows, as JSON records."""
    (importance.orderBy(F.col("importance").desc(), F.col("feature")).limit(top)
     .coalesce(1).write.mode("overwrite").json(path))


def metrics_rows(spark: SparkSession, run_id: str, stage: str,
                 values: Mapping[str, float]) -> DataFrame:
    """Long metrics rows ``(run_id, stage, key, value, ts)`` for :func:`log_metrics`."""
    ts = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    rows = [(run_id, stage, k, float(v) if v is not None else None, ts) for k, v in values.items()]
    return spark.createDataFrame(rows, "run_id string, stage string, key string, value double, "
                                       "ts timestamp_ntz")


def log_metrics(df: DataFrame, path: str) -> None:
    """Append metrics; every audit finding is kept (nothing is overwritten)."""
    df.write.mode("append").partitionBy("stage").parquet(path)


def audit_metrics(report: DataFrame, run_id: str) -> DataFrame:
    """Per-attribute DPD / EOD / flag rows from an audit report, lazily."""
    ts = F.current_timestamp().cast("timestamp_ntz")
    items = F.array(
        F.struct(F.concat(F.lit("dpd_"), "attribute").alias("key"), F.col("dpd").alias("value")),
        F.struct(F.concat(F.lit("eod_"), "attribute").alias("key"), F.col("eod").alias("value")),
        F.struct(F.concat(F.lit("flagged_"), "attribute").alias("key"),
                 F.col("any_breach").cast("double").alias("value")))
    return report.select(F.explode(items).alias("m")).select(
        F.lit(run_id).alias("run_id"), F.lit("fairness_audit").alias("stage"),
        "m.key", "m.value", ts.alias("ts"))
