"""Exact order statistics of text columns without moving their values.

1. A bounded sample of each column, cut to short prefixes, brackets every wanted
   rank; where a bracket would still hold many rows, a second sample from inside
   it narrows it again.
2. One pass counts exactly what lies below and inside each bracket, and only what
   lies inside is grouped by value.

The samples only guide: whether the wanted ranks lie inside their bracket is
checked on the exact counts, and a column that misses one is reported, so that
the caller counts its values in full.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Sampled values per column (each at most PREFIX characters), and how many standard errors a bracket reaches.
SAMPLE, PREFIX, REACH = 20_000, 64, 5
#: Rows a bracket may hold before it is narrowed by a further sample.
INSIDE = 200_000
#: Follows every text that begins with what stands before it.
LAST = "\U0010ffff"


def _inside(v: Column, ends: tuple) -> Column:
    low, high = ends
    ok = v.isNotNull()
    if low is not None:
        ok = ok & (v >= F.lit(low))
    return ok & (v <= F.lit(high)) if high is not None else ok


def _sampled(df: DataFrame, cols: Sequence[str], brackets: dict, share: dict) -> dict:
    """(column, bracket) -> sorted prefixes of a random part of the rows inside."""
    items = [F.struct(F.lit(i).alias("c"), F.lit(j).alias("b"), F.when(
        _inside(F.col(f"`{c}`"), ends) & (F.rand(17 * i + j) < F.lit(share[c, j])),
        F.substring(F.col(f"`{c}`"), 1, PREFIX)).alias("v"))
        for i, c in enumerate(cols) for j, ends in enumerate(brackets[c]) if share[c, j] > 0]
    out: dict = {}
    if items:       # some SAMPLE short values per bracket
        rows = df.select(F.explode(F.array(*items)).alias("s")).select("s.*").where(F.col("v").isNotNull())
        for r in rows.collect():
            out.setdefault((cols[r["c"]], r["b"]), []).append(r["v"])
    return {k: sorted(v, key=lambda t: t.encode("utf-8", "surrogatepass")) for k, v in out.items()}


def _counted(df: DataFrame, cols: Sequence[str], brackets: dict) -> dict:
    """(column, bracket) -> (rows below it, rows inside), exactly."""
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`")
        for j, ends in enumerate(brackets[c]):
            below = F.lit(0).cast("long") if ends[0] is None else F.count_if(v < F.lit(ends[0]))
            aggs += [below.alias(f"b{i}_{j}"), F.count_if(_inside(v, ends)).alias(f"n{i}_{j}")]
    row = df.agg(*aggs).first()
    return {(c, j): (row[f"b{i}_{j}"], row[f"n{i}_{j}"]) for i, c in enumerate(cols) for j in range(len(brackets[c]))}


def text_ranks(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> dict[str, list[tuple] | None]:
    """Per column and probability: (value at or below the rank, value at or above it, fraction between them).

    Ranks are those of non-null rows in code-point order, rank p * (n - 1) as for
    interpolated quantiles. None for a column without values, or whose sample
    missed a rank.
    """
    cols = list(columns)
    brackets: dict[str, list[tuple]] = {c: [(None, None)] * len(probs) for c in cols}
    sizes = _counted(df, cols, {c: [(None, None)] for c in cols})
    n = {c: sizes[c, 0][1] for c in cols}
    cols = [c for c in cols if n[c]]
    where = {(c, j): (0, n[c]) for c in cols for j in range(len(probs))}
    for _ in range(2):
        share = {k: min(1.0, SAMPLE / size) if size > INSIDE else 0.0 for k, (_, size) in where.items()}
        drawn = _sampled(df, cols, brackets, share)
        if not drawn:
            break
        for (c, j), values in drawn.items():
            below, size = where[c, j]
            m = len(values)
            p = (probs[j] * (n[c] - 1) - below) / max(1, size - 1)
            reach = REACH * math.sqrt(max(p * (1 - p), 1 / m) / m) + 1 / m
            low, high = min(math.floor((p - reach) * m), m - 1), max(math.ceil((p + reach) * m), 0)
            old = brackets[c][j]
            brackets[c][j] = (values[low] if low > 0 else old[0],
                              values[high] + (LAST if len(values[high]) == PREFIX else "") if high < m else old[1])
        where = _counted(df, cols, brackets)

    wanted = {(c, j): (math.floor(p * (n[c] - 1)), math.ceil(p * (n[c] - 1))) for c in cols for j, p in enumerate(probs)}
    missed = {c for (c, j), (low, high) in wanted.items()
              if not where[c, j][0] <= low <= high < sum(where[c, j])}
    good = [c for c in cols if c not in missed]
    out: dict[str, list[tuple] | None] = {c: None for c in columns}
    if not good:
        return out
    items = [F.struct(F.lit(i).alias("c"), F.lit(j).alias("b"), F.when(
        _inside(F.col(f"`{c}`"), ends), F.col(f"`{c}`")).alias("v"))
        for i, c in enumerate(good) for j, ends in enumerate(brackets[c])]
    counted = (df.select(F.explode(F.array(*items)).alias("s")).select("s.*").where(F.col("v").isNotNull())
               .groupBy("c", "b", "v").agg(F.count(F.lit(1)).alias("k")))
    # windows over what lies inside one bracket
    upto = F.sum("k").over(Window.partitionBy("c", "b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    low_at, high_at = (F.coalesce(*(F.when((F.col("c") == i) & (F.col("b") == j),
                                           F.lit(wanted[c, j][side] - where[c, j][0]))
                                    for i, c in enumerate(good) for j in range(len(probs)))) for side in (0, 1))
    placed = counted.withColumn("upto", upto).withColumn("from", F.col("upto") - F.col("k"))
    hits = placed.where(((F.col("from") <= low_at) & (low_at < F.col("upto")))
                        | ((F.col("from") <= high_at) & (high_at < F.col("upto"))))
    found: dict = {}
    for r in hits.collect():                                          # at most two rows per column and rank
        found.setdefault((good[r["c"]], r["b"]), []).append(r["v"])
    for c in good:
        out[c] = []
        for j, p in enumerate(probs):
            at = sorted(found[c, j], key=lambda t: t.encode("utf-8", "surrogatepass"))
            out[c].append((at[0], at[-1], p * (n[c] - 1) - wanted[c, j][0]))
    return out


def text_edges(ranks: Sequence[tuple]) -> list[str]:
    """Upper thresholds of rank-coded quantile bins; edges of equal code are dropped, thresholds may repeat."""
    edges, last = [], None
    for low, high, part in ranks:
        code = (low, part if high != low else 0.0)
        if code != last:
            edges.append(low)
            last = code
    return edges
