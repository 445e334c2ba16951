"""Column expressions that place a value into quantile bins.

The bins follow right-closed intervals over de-duplicated edges, the lowest
edge included: a value's bin is the number of edges strictly below it, minus
one, floored at zero. Edges are few (five per attribute), so they travel as
literals inside the expression and no join back to the rows is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_by_edges(col: Column, edges: Sequence) -> Column:
    """0-based bin of ``col`` for sorted, de-duplicated ``edges``; null stays null."""
    if not edges:
        return F.when(col.isNotNull(), F.lit(0))
    below = None
    for e in edges:
        term = F.when(col > F.lit(e), 1).otherwise(0)
        below = term if below is None else below + term
    return F.when(col.isNull(), F.lit(None).cast("int")).otherwise(
        F.greatest(below - 1, F.lit(0)).cast("int"))


def dedupe_edges(values: Sequence[float]) -> list:
    """Drop repeated edges, keeping the sorted order of the first copies."""
    out: list = []
    for v in sorted(x for x in values if x is not None):
        if not out or v != out[-1]:
            out.append(v)
    return out
