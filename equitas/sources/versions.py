"""Sinks of several tables that appear together or not at all.

A commit writes its tables into a folder of its own and then one small manifest,
numbered one above the last; readers follow the manifest of the highest number.
So a write that breaks half way, or an executor or driver lost during it, leaves
the version before in place, and nobody reads tables of two versions. Only file
creation without overwriting is asked of the store, no renames.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove
from .ingest import write_gold, write_importance, write_silver

MANIFESTS, VERSIONS = "_manifests", "versions"


class Versions:
    """Versioned tables under one path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _path(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _manifests(self) -> list[tuple[int, dict]]:
        """(number, manifest) of every readable manifest, newest first; a torn one is passed over."""
        folder, fs = self._path(MANIFESTS)
        if not fs.exists(folder):
            return []
        files = sorted((f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().endswith(".json")),
                       key=lambda p: p.getName(), reverse=True)
        out = []
        for p in files:
            stream = fs.open(p)
            try:
                text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            try:
                out.append((int(p.getName().split(".")[0]), json.loads(text)))
            except ValueError:
                continue
        return out

    def _next_number(self) -> int:
        folder, fs = self._path(MANIFESTS)
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return 1 + max((int(n.split(".")[0]) for n in names if n.endswith(".json")), default=0)

    def commit(self, run_id: str, tables: Mapping[str, Callable[[str], None]], keep: int = 2) -> str:
        """Write every table by its function (given a folder), then make them the current version.

        If one fails nothing changes for readers, and what was written goes. The
        last ``keep`` versions stay; older ones are removed.
        """
        folder = f"{VERSIONS}/{run_id}-{uuid.uuid4().hex[:12]}"
        try:
            for name, write in tables.items():
                write(f"{self.path}/{folder}/{name}")
            path, fs = self._path(f"{MANIFESTS}/{self._next_number():010d}.json")
            stream = fs.create(path, False)
            try:
                stream.write(bytearray(json.dumps({"run_id": run_id, "folder": folder,
                                                   "tables": sorted(tables)}).encode()))
            finally:
                stream.close()
        except Exception:
            remove(self.spark, f"{self.path}/{folder}")
            raise
        for number, old in self._manifests()[keep:]:
            remove(self.spark, f"{self.path}/{MANIFESTS}/{number:010d}.json")
            remove(self.spark, f"{self.path}/{old['folder']}")
        return f"{self.path}/{folder}"

    def current(self) -> dict | None:
        """The newest manifest, or None before the first commit."""
        found = self._manifests()
        return found[0][1] if found else None

    def folder(self, table: str) -> str:
        now = self.current()
        if now is None or table not in now["tables"]:
            raise FileNotFoundError(f"no committed table {table} under {self.path}")
        return f"{self.path}/{now['folder']}/{table}"


def publish(spark: SparkSession, path: str, run_id: str, silver: DataFrame, sensitive: Sequence[str], gold: DataFrame,
            importance: DataFrame) -> Versions:
    """Silver, gold and importance tables of one run as one version."""
    out = Versions(spark, path)
    out.commit(run_id, {"silver": lambda p: write_silver(silver, sensitive, p), "gold": lambda p: write_gold(gold, p),
                        "importance": lambda p: write_importance(importance, p)})
    return out


def replace_metrics(metrics: DataFrame, path: str) -> None:
    """Metrics rows, one folder per (run_id, stage); a stage that a run writes again takes the place of its old rows."""
    (metrics.repartition("run_id", "stage").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id", "stage").parquet(path))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    schema = "key string, value double, ts timestamp_ntz, run_id string, stage string"
    return spark.read.schema(schema).parquet(path).select("run_id", "stage", "key", F.col("value"), "ts")
