"""Bias monitor of numeric attributes: quartile groups by the last closed window.

The groups of a window are the quartile bins of the window closed before it
(the first window has its own), so a drift of the values shows as a change of
the groups' rates. Values are counted on a grid of three significant digits:
at most 900 cells a decade and sign, however many rows or distinct values, so
a window's counts, all that is kept or sent per attribute, have a size bound.

* Batch twin: counts per (window, attribute, cell) by one aggregate, edges by
  a running sum over the cells, the edges before by a lag over the windows.
* Stream: tasks reduce all their rows to cells, and one state per attribute
  keeps the open windows' cells in a map (one entry per window, read and written
  once a batch), the edges of the last closed window and a timer. A window closes when an event is later than its end by the allowed
  lateness; a stream without input for ``idle`` seconds closes what is open.
  Rows of a closed window are late and dropped.

Null, NaN and infinite values belong to no group and are left out.
"""

from __future__ import annotations

import math
import os
import time
from collections.abc import Iterator, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..operators.audit import BIAS_THRESHOLD
from ..session import exists
from .monitor import event_time

COUNTS = ("n", "n_pred_pos", "n_pos", "n_true_pos")
OUT_SCHEMA = ("window_start long, attribute string, n_groups long, n_rows long, dpd double, eod double, "
              "dpd_flagged boolean, eod_flagged boolean")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Cells that a task holds before it hands them on, and that a state adds up at a time.
HELD_CELLS = 1 << 17
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def grid_cell(value: Column) -> Column:
    """Lower end of the value's cell on the grid of three significant digits.

    Only whole powers of ten up to 10^22 are exact doubles, so the scale is
    multiplied or divided, whichever is whole.
    """
    v = value.cast("double")
    e = F.floor(F.log10(F.abs(v)))
    up, down = F.pow(F.lit(10.0), F.lit(2) - e), F.pow(F.lit(10.0), e - F.lit(2))
    return F.when(v == 0, F.lit(0.0)).when(e < 2, F.floor(v * up) / up).otherwise(F.floor(v / down) * down)


def _cells(df: DataFrame, attributes: Sequence[tuple[str, Column]], pred: Column, label: Column,
           seconds: int) -> DataFrame:
    """One row per row and attribute with a value: its window, cell, prediction and label."""
    items = F.array(*[F.struct(F.lit(n).alias("attribute"), e.cast("double").alias("v")) for n, e in attributes])
    long = df.select("event_ts", F.explode(items).alias("a"), F.coalesce(pred.cast("long"), F.lit(0)).alias("p"),
                     F.coalesce(label.cast("long"), F.lit(0)).alias("y"))
    sec = F.floor(F.unix_micros("event_ts") / F.lit(1_000_000))
    return long.where("a.v IS NOT NULL AND NOT isnan(a.v) AND abs(a.v) < double('infinity')").select(
        F.col("a.attribute").alias("attribute"), (sec - F.pmod(sec, F.lit(seconds))).cast("long").alias("w"),
        grid_cell(F.col("a.v")).alias("cell"), F.lit(1).cast("long").alias("n"), F.col("p").alias("n_pred_pos"),
        F.col("y").alias("n_pos"), (F.col("p") * F.col("y")).alias("n_true_pos"), sec.cast("long").alias("last"))


def bias_by_value_window(df: DataFrame, ts: str, attributes: Sequence[tuple[str, Column]], pred: Column,
                         label: Column, seconds: int = 86_400) -> DataFrame:
    """Batch twin of the monitor, every window."""
    src = df.withColumn("event_ts", event_time(df, ts))
    counts = _cells(src, attributes, pred, label, seconds).groupBy("attribute", "w", "cell").agg(
        *[F.sum(c).alias(c) for c in COUNTS])
    # rows of one (attribute, window): its cells, a number bounded by the grid
    own = Window.partitionBy("attribute", "w")
    ranked = counts.withColumn("cum", F.sum("n").over(own.orderBy("cell").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))).withColumn("all", F.sum("n").over(own))
    edges = ranked.groupBy("attribute", "w").agg(F.array_distinct(F.array(*[
        F.min(F.when(F.col("cum") * 4 >= F.col("all") * j, F.col("cell"))) for j in (1, 2, 3)])).alias("edges"))
    before = edges.select("attribute", "w", F.coalesce(
        F.lag("edges").over(Window.partitionBy("attribute").orderBy("w")), F.col("edges")).alias("edges"))
    binned = counts.join(before, ["attribute", "w"]).select(
        "attribute", "w", F.size(F.filter("edges", lambda x: x < F.col("cell"))).alias("bin"), *COUNTS)
    groups = binned.groupBy("attribute", "w", "bin").agg(*[F.sum(c).alias(c) for c in COUNTS])
    rate = F.col("n_pred_pos") / F.col("n")
    tpr = F.when(F.col("n_pos") > 0, F.col("n_true_pos") / F.col("n_pos")).otherwise(F.lit(0.0))
    dpd, eod = F.max(rate) - F.min(rate), F.max(tpr) - F.min(tpr)
    return groups.groupBy(F.col("w").alias("window_start"), "attribute").agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum("n").alias("n_rows"), dpd.alias("dpd"), eod.alias("eod"),
        (dpd >= BIAS_THRESHOLD).alias("dpd_flagged"), (eod >= BIAS_THRESHOLD).alias("eod_flagged"))


def quartile_edges(cells: list[tuple[float, int]]) -> list[float]:
    """Distinct inner quartile edges of (cell, rows), sorted: the first cell that reaches each quarter."""
    total, out, cum, j = sum(n for _, n in cells), [], 0, 1
    for cell, n in cells:
        cum += n
        while j <= 3 and cum * 4 >= total * j:
            if not out or out[-1] != cell:
                out.append(cell)
            j += 1
    return out


class ValueMonitor(StatefulProcessor):
    """State of one attribute: cells of the open windows, edges of the last closed one, a timer."""

    def __init__(self, seconds: int, lateness: int, idle: int):
        self.seconds, self.lateness, self.idle = seconds, lateness, idle

    def init(self, handle) -> None:
        self.handle = handle
        self.cells = handle.getMapState("cells", "w long", "cell array<double>, " + ", ".join(
            f"{c} array<long>" for c in COUNTS))
        self.closed = handle.getValueState("closed", "w long, edges array<double>, last long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        past, edges, last = self.closed.get() or (None, None, None)
        held: list[pd.DataFrame] = []
        for part in rows:
            part = part if past is None else part[part["w"] > past]
            if not len(part):
                continue
            newest = int(part["last"].max())
            last = newest if last is None else max(last, newest)
            held.append(_counted(part, ["w", "cell"]))
            if sum(map(len, held)) > HELD_CELLS:
                held = [_counted(pd.concat(held), ["w", "cell"])]
        if held:
            for w, own in pd.concat(held).groupby("w"):
                if self.cells.containsKey((int(w),)):
                    own = pd.concat([own, self._window(int(w))])
                own = _counted(own, ["cell"])
                self.cells.updateValue((int(w),), tuple(own[c].tolist() for c in ("cell", *COUNTS)))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + 1000 * self.idle)
        until = None if last is None else last - self.lateness - self.seconds
        yield from self._close(key[0], past, edges, last, until)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        past, edges, last = self.closed.get() or (None, None, None)
        yield from self._close(key[0], past, edges, last, None if last is None else last)

    def _window(self, w: int) -> pd.DataFrame:
        """The cells kept for a window."""
        return pd.DataFrame(dict(zip(("cell", *COUNTS), map(list, self.cells.getValue((w,))))))

    def _close(self, attribute: str, past, edges, last, until) -> Iterator[pd.DataFrame]:
        """Emit the open windows that start no later than ``until``, in order."""
        ready = [] if until is None else sorted(int(key[0]) for key in self.cells.keys() if key[0] <= until)
        out = []
        for w in ready:
            cells = sorted(self._window(w).itertuples(index=False, name=None))
            own = quartile_edges([(c[0], c[1]) for c in cells])
            use = own if edges is None else list(edges)
            groups: dict[int, list[int]] = {}
            for cell, *counts in cells:
                g = groups.setdefault(sum(x < cell for x in use), [0, 0, 0, 0])
                for i, c in enumerate(counts):
                    g[i] += c
            self.cells.removeKey((w,))
            rate = [g[1] / g[0] for g in groups.values()]
            tpr = [g[3] / g[2] if g[2] else 0.0 for g in groups.values()]
            dpd, eod = max(rate) - min(rate), max(tpr) - min(tpr)
            out.append((w, attribute, len(groups), sum(g[0] for g in groups.values()), dpd, eod,
                        dpd >= BIAS_THRESHOLD, eod >= BIAS_THRESHOLD))
            past, edges = w, own
        if last is not None:
            # before the first window is closed, every window is open
            self.closed.update((-(1 << 62) if past is None else past, edges, last))
        if out:
            yield pd.DataFrame(out, columns=["window_start", "attribute", "n_groups", "n_rows", "dpd", "eod",
                                             "dpd_flagged", "eod_flagged"])

    def close(self) -> None:
        pass


def _counted(rows: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    return rows.groupby(keys, as_index=False, sort=False)[list(COUNTS)].sum()


def _partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's rows reduced to cells before they move; it holds some HELD_CELLS of them at most."""
    def reduce(parts: list[pd.DataFrame]) -> pd.DataFrame:
        return pd.concat(parts).groupby(["attribute", "w", "cell"], as_index=False).agg(
            {**{c: "sum" for c in COUNTS}, "last": "max"})

    held: list[pd.DataFrame] = []
    for batch in batches:
        held.append(reduce([batch]))
        if sum(map(len, held)) > HELD_CELLS:
            held = [reduce(held)]
            if len(held[0]) > HELD_CELLS // 2:
                yield held.pop()
    if held:
        yield reduce(held)


def run_value_monitor(spark: SparkSession, source_path: str, schema: T.StructType, ts: str,
                      attributes: Sequence[tuple[str, Column]], pred: Column, label: Column, out_dir: str,
                      seconds: int = 86_400, lateness: int = 3_600, idle: int = 5,
                      max_files_per_trigger: int | None = None, file_glob: str | None = None) -> DataFrame:
    """Run the monitor over a Parquet folder until its input is read and the idle
    timer has closed the last window; return all windows emitted so far.

    Output and state lie under ``out_dir``; a later run with the same folder
    goes on from there with new files.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    stream = reader.parquet(source_path)
    cells = _cells(stream.withColumn("event_ts", event_time(stream, ts)), attributes, pred, label, seconds)
    out = cells.mapInPandas(_partial, cells.schema).groupBy("attribute").transformWithStateInPandas(
        ValueMonitor(seconds, lateness, idle), outputStructType=OUT_SCHEMA, outputMode="Append",
        timeMode="ProcessingTime")
    target = os.path.join(out_dir, "windows")
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)       # map state and timers need it; a query keeps the settings it starts with
    try:
        query = (out.writeStream.format("parquet").outputMode("append").trigger(processingTime="1 second")
                 .option("checkpointLocation", os.path.join(out_dir, "_checkpoint")).start(target))
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
    try:
        due = time.time() + idle
        while query.isActive and not _drained(query, due, idle):
            time.sleep(0.2)
        if query.exception() is not None:
            raise query.exception()
    finally:
        query.stop()
    if not exists(spark, target):           # a source without files never starts a batch
        return spark.createDataFrame([], OUT_SCHEMA)
    return spark.read.schema(OUT_SCHEMA).parquet(target)


def _drained(query, due: float, idle: int) -> bool:
    """True once a batch without new input has begun after every timer was due.

    Timers make batches run without input too, so that the stream's own wait
    for the end of its input would not return.
    """
    empty = -math.inf
    for p in query.recentProgress:
        began = datetime.fromisoformat(str(p["timestamp"]).replace("Z", "+00:00")).timestamp()
        if any(s["startOffset"] != s["endOffset"] for s in p["sources"]):
            due = max(due, began + p["durationMs"].get("triggerExecution", 0) / 1000 + idle)
        else:
            empty = began
    if not query.recentProgress:
        return time.time() > due and not query.status["isTriggerActive"]
    return empty > due
