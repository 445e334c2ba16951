"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "equitas",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Local/test session with AQE on and the UI off.

    On a cluster, use the cluster's own session; the library only reads
    settings from it (see :func:`checkpoint_dir`).
    """
    master = master or os.environ.get("EQUITAS_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("EQUITAS_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster must name a shared folder there. Only a local-mode session
    (tests, smoke runs) without the setting gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/DBFS) "
                "so that lineage cuts survive executor loss")
        configured = tempfile.mkdtemp(prefix="equitas-ckpt-")
    # the context's setter works at runtime; ``spark.conf.set`` rejects this core key
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir`` itself.

    :func:`checkpoint_dir` returns Spark's per-application subfolder (a new one
    for every SparkContext); state that must outlive the application, such as
    a streaming query's checkpoint, goes under this root instead.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured.rstrip("/") if configured else checkpoint_dir(spark).rstrip("/")


def reliable_checkpoint(df):
    """Cut lineage by writing ``df`` to the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def parquet_handover(df, folder: str, name: str):
    """Write ``df`` as Parquet under ``folder`` and return it as a scan of that table.

    Unlike a checkpoint, later steps read only the columns they use.
    """
    path = f"{folder}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder through the file system it lies in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/equitas-scratch/{spark.sparkContext.applicationId}"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new path in the shared store for a table that this application needs only until it ends."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def _remove_scratch() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        try:
            remove(spark, _own_folder(spark))
        except Exception:  # noqa: BLE001  the context may have gone already
            pass


atexit.register(_remove_scratch)


def exists(spark: SparkSession, folder: str) -> bool:
    """True if a folder is there, by the file system it lies in."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def default_parallelism(spark: SparkSession) -> int:
    """Number of range buckets to use for distributed prefix sums."""
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # noqa: BLE001
        n = 200
    return max(1, n)
