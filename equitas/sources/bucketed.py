"""Tables kept bucketed and sorted on a key, for lookups and for joins between stages.

Rows are dealt to buckets by the hash of the key once, when the table is
written. A lookup of given keys then opens only their buckets (and, as each
bucket is one sorted file, only the row groups that can hold them); a lookup by
a table of keys, or a join with another table in as many buckets of the same
key, moves no row of the bucketed side.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import default_parallelism, remove, scratch_folder


@dataclass
class BucketedTable:
    """A catalog table ``name`` under ``path``, in ``buckets`` buckets of ``key``."""
    frame: DataFrame
    name: str
    path: str
    key: str
    buckets: int

    def find(self, keys: Sequence) -> DataFrame:
        """Rows of a few given keys. Null and unknown keys have no rows."""
        return self.frame.where(F.col(f"`{self.key}`").isin([k for k in keys if k is not None]))

    def lookup(self, ids: DataFrame) -> DataFrame:
        """Rows whose key is in the first column of ``ids``, each once however often the key is asked for."""
        kind = self.frame.schema[self.key].dataType
        wanted = ids.select(F.col(f"`{ids.columns[0]}`").cast(kind).alias(self.key)).distinct()
        return self.frame.join(wanted, self.key, "left_semi")

    def join(self, other: BucketedTable, how: str = "inner") -> DataFrame:
        """Both tables side by side on their keys (named alike), without an exchange where they have as many buckets."""
        if other.key != self.key:
            raise ValueError(f"keys differ: {self.key}, {other.key}")
        return self.frame.join(other.frame, self.key, how)

    def close(self) -> None:
        """Drop the table and its files."""
        spark = self.frame.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove(spark, self.path)


def bucketed_table(df: DataFrame, key: str, label: str = "table", buckets: int | None = None) -> BucketedTable:
    """Write ``df`` in buckets of ``key`` (by default as many as the session's shuffles have tasks).

    The one exchange is on the key, so every task writes one file, and rows of
    one key lie together: the key should be close to unique. Null keys share a
    bucket. The files lie in the shared folder until ``close`` or the end of
    the session. An empty ``df`` gives an empty table.
    """
    spark = df.sparkSession
    n = buckets or default_parallelism(spark)
    name, path = f"equitas_{label}_{uuid.uuid4().hex[:12]}", scratch_folder(spark, label)
    (df.repartition(n, F.col(f"`{key}`")).sortWithinPartitions(F.col(f"`{key}`"))
     .write.format("parquet").option("path", path).bucketBy(n, key).sortBy(key).saveAsTable(name))
    return BucketedTable(spark.table(name), name, path, key, n)
