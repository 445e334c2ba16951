"""Real-time bias monitor: DPD / EOD per event-time window.

Two chained aggregations, the same in batch and in Structured Streaming:

1. ``groupBy(window, attribute, group)`` -> n, positive predictions, positives,
   true positives (partial aggregation: one row per group per task);
2. ``groupBy(window(window_time(window)), attribute)`` -> max - min of the
   rates, the groups at both ends (ties to the smallest label), breach flags
   (fixed threshold) and their count.

In streaming, a watermark on the event time closes windows; rows later than
the watermark are dropped and a window is emitted once (append mode).
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.audit import BIAS_THRESHOLD
from ..session import shared_root


def event_time(df: DataFrame, ts: str) -> Column:
    """Event time as TIMESTAMP; a TIMESTAMP_NTZ column is read as UTC wall time."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        tz = df.sparkSession.conf.get("spark.sql.session.timeZone")
        return F.to_utc_timestamp(F.col(ts).cast("timestamp"), tz)
    return F.col(ts)


def group_counts(df: DataFrame, attributes: Sequence[tuple[str, Column]], pred: Column, label: Column,
                 window: str) -> DataFrame:
    """Stage 1 over a frame with an ``event_ts`` column."""
    items = F.array(*[F.struct(F.lit(name).alias("attribute"), expr.cast("string").alias("grp"))
                      for name, expr in attributes])
    long = df.select("event_ts", F.explode(items).alias("a"), pred.cast("long").alias("_p"),
                     label.cast("long").alias("_y"))
    return long.groupBy(F.window("event_ts", window).alias("window"), F.col("a.attribute").alias("attribute"),
                        F.col("a.grp").alias("grp")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_p").alias("n_pred_pos"), F.sum("_y").alias("n_pos"),
        F.sum(F.col("_p") * F.col("_y")).alias("n_true_pos"))


def window_bias(counts: DataFrame, window: str) -> DataFrame:
    """Stage 2: one row per (window, attribute)."""
    rate = F.col("n_pred_pos") / F.col("n")
    tpr = F.when(F.col("n_pos") > 0, F.col("n_true_pos") / F.col("n_pos")).otherwise(F.lit(0.0))
    g = counts.select(F.window(F.window_time("window"), window).alias("w"), "attribute", "grp",
                      "n", rate.alias("rate"), tpr.alias("tpr"))
    def pick(metric: str, sign: int):
        # extreme group by the metric; ties go to the smallest group label
        return F.min_by("grp", F.struct((F.lit(sign) * F.col(metric)).alias("k"), F.col("grp")))

    agg = g.groupBy("w", "attribute").agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum("n").alias("n_rows"),
        F.max("rate").alias("_rmax"), F.min("rate").alias("_rmin"),
        F.max("tpr").alias("_tmax"), F.min("tpr").alias("_tmin"),
        pick("rate", -1).alias("_dpd_max"), pick("rate", 1).alias("_dpd_min"),
        pick("tpr", -1).alias("_eod_max"), pick("tpr", 1).alias("_eod_min"))
    two = F.col("n_groups") >= 2
    dpd = F.when(two, F.col("_rmax") - F.col("_rmin")).otherwise(F.lit(0.0))
    eod = F.when(two, F.col("_tmax") - F.col("_tmin")).otherwise(F.lit(0.0))
    dpd_flag, eod_flag = dpd >= BIAS_THRESHOLD, eod >= BIAS_THRESHOLD
    return agg.select(F.unix_seconds(F.col("w.start")).alias("window_start"), "attribute", "n_groups", "n_rows",
                      dpd.alias("dpd"), eod.alias("eod"), dpd_flag.alias("dpd_flagged"), eod_flag.alias("eod_flagged"),
                      (dpd_flag.cast("int") + eod_flag.cast("int")).alias("breaches"),
                      *[F.when(two, F.col(f"_{m}")).alias(f"{m}_group")
                        for m in ("dpd_max", "dpd_min", "eod_max", "eod_min")])


def bias_by_window(df: DataFrame, ts: str, attributes: Sequence[tuple[str, Column]], pred: Column,
                   label: Column, window: str = "1 day") -> DataFrame:
    """Batch twin of the monitor (every window, including the last one)."""
    src = df.withColumn("event_ts", event_time(df, ts))
    return window_bias(group_counts(src, attributes, pred, label, window), window)


def _query_key(source_path: str, out: DataFrame, attributes, pred: Column, label: Column,
               window: str, watermark: str, file_glob: str | None) -> str:
    """Stable name for a monitor's folder: the same query over the same source
    resumes from its checkpoint in any process; a changed query starts afresh."""
    parts = [source_path, window, watermark, file_glob or "", out.schema.simpleString(),
             str(pred), str(label), *[f"{n}={e}" for n, e in attributes]]
    return hashlib.sha256("\x1f".join(parts).encode()).hexdigest()[:20]


def run_monitor(spark: SparkSession, source_path: str, schema: T.StructType, ts: str,
                attributes: Sequence[tuple[str, Column]], pred: Column, label: Column,
                window: str = "1 day", watermark: str = "1 hour", out_dir: str | None = None,
                max_files_per_trigger: int | None = None, file_glob: str | None = None) -> DataFrame:
    """Run the streaming monitor over a parquet folder with ``availableNow``
    and return the emitted (closed) windows as a DataFrame.

    Output and the stream's checkpoint go under ``out_dir`` (default: a folder
    in the shared checkpoint root named after the query), so a restarted query
    resumes, in any later application.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_glob:
        # stream only the matching files of the folder (e.g. one table file)
        reader = reader.option("pathGlobFilter", file_glob)
    stream = reader.parquet(source_path)
    src = stream.withColumn("event_ts", event_time(stream, ts)).withWatermark("event_ts", watermark)
    out = window_bias(group_counts(src, attributes, pred, label, window), window)
    key = _query_key(source_path, out, attributes, pred, label, window, watermark, file_glob)
    base = out_dir or f"{shared_root(spark)}/bias-monitor-{key}"
    q = (out.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", os.path.join(base, "_checkpoint"))
         .trigger(availableNow=True).start(os.path.join(base, "windows")))
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(os.path.join(base, "windows"))
