"""Sorted pages of any depth through an order-statistic index.

The rows are sorted once, in ranges of the sort key with the entity id as its
last part (so equal keys are split too), and written with their position inside
their range. The index is the number of rows of every range. A page then opens
only the ranges that hold it and in them only the row groups whose positions it
wants, so its cost does not grow with its number; nothing is sorted again but
the page itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import default_parallelism, remove, shared_root

RANGE, PLACE = "_range", "_place"


@dataclass
class PageIndex:
    """A table in sorted ranges under ``path``, and how many rows each range has (one entry per range)."""
    table: DataFrame
    starts: list            # (range, rows before it, rows in it), in order
    path: str

    @property
    def total(self) -> int:
        return self.starts[-1][1] + self.starts[-1][2] if self.starts else 0

    def pages(self, page_size: int) -> int:
        return -(-self.total // page_size)

    def rows(self, first: int, n: int) -> DataFrame:
        """Rows ``first`` to ``first + n - 1`` of the order, in order."""
        wanted = F.lit(False)
        for r, before, size in self.starts:
            low, high = max(first - before, 0), min(first + n - before, size)
            if low < high:
                wanted = wanted | ((F.col(RANGE) == r) & (F.col(PLACE) >= low) & (F.col(PLACE) < high))
        return self.table.where(wanted).orderBy(RANGE, PLACE).drop(RANGE, PLACE)

    def page(self, page: int, page_size: int = 50) -> DataFrame:
        """Page 1 is the first; a page beyond the last has no rows."""
        if page < 1 or page_size < 1:
            raise ValueError("page >= 1 and page_size >= 1")
        return self.rows((page - 1) * page_size, page_size)

    def close(self) -> None:
        remove(self.table.sparkSession, self.path)


def page_index(df: DataFrame, order: Sequence, ranges: int | None = None) -> PageIndex:
    """Sort ``df`` by ``order`` (columns, which should end in a unique one) and index its rows.

    One shuffle of the rows, by sampled ranges; any number of pages can then be
    read. An empty table has an index without pages.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/equitas-pages-{uuid.uuid4().hex}"
    # a monotonic id is the partition in its upper bits and the row's place in the partition in the lower 33
    spot = F.monotonically_increasing_id()
    ordered = (df.repartitionByRange(ranges or default_parallelism(spark), *order).sortWithinPartitions(*order)
               .withColumn("_spot", spot))
    ordered.select("*", F.shiftright("_spot", 33).cast("int").alias(RANGE),
                   F.col("_spot").bitwiseAND((1 << 33) - 1).alias(PLACE)).drop("_spot").write.partitionBy(RANGE).parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField(PLACE, T.LongType()), T.StructField(RANGE, T.IntegerType())])
    table = spark.read.schema(schema).parquet(path)
    counts = table.groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")).orderBy(RANGE).collect()   # one row per range
    starts, before = [], 0
    for r in counts:
        starts.append((r[RANGE], before, r["n"]))
        before += r["n"]
    return PageIndex(table, starts, path)
