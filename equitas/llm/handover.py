"""Lineage cuts and small planning figures shared by the operators.

A hand-over is a Parquet table under the shared folder that the session names
in ``spark.checkpoint.dir``. Unlike an RDD checkpoint it keeps column pruning
and compression, and every executor can read it after another one is lost.
"""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_root

#: Matches what the contracts call white space.
BLANK = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def folder(spark: SparkSession) -> str:
    """This application's own folder for hand-overs in the shared store."""
    return f"{shared_root(spark)}/equitas-llm/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own for one hand-over."""
    return f"{folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def handover(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once (to a folder of its own without ``path``) and return it as a scan of that table.

    An empty ``df`` gives an empty table with the same columns.
    """
    spark = df.sparkSession
    path = path or new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> None:
    """Remove all hand-overs of this application, through Spark's own file system."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(folder(spark))
    path.getFileSystem(conf).delete(path, True)


def _clean_active() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        try:
            clean(spark)
        except Exception:  # noqa: BLE001  the context may have gone already
            pass


atexit.register(_clean_active)


def width(spark: SparkSession) -> int:
    """Tasks that one shuffle of this session is dealt to."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame, *keys: str, factor: int = 1) -> DataFrame:
    """Deal rows to the session's shuffle width by ``keys`` (round robin without)."""
    n = factor * width(df.sparkSession)
    return df.repartition(n, *keys) if keys else df.repartition(n)


def held_out(doc_id="doc_id"):
    """True for the test fold: crc32 of the id as text, modulo 5, is 0 (null id: of '')."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def only(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, found without regard to case, under those names.

    Operators call this first, so further columns of the input, whatever their
    names, cannot clash with the columns they add.
    """
    have = {}
    for c in df.columns:
        have.setdefault(c.lower(), c)
    return df.select(*(F.col(f"`{have[n.lower()]}`").alias(n) for n in names))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the like of it, that no column of ``df`` has."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def columns_of(df: DataFrame) -> list:
    """The columns of ``df`` by name, for selecting them again after a join."""
    return [F.col(f"`{c}`") for c in df.columns]
