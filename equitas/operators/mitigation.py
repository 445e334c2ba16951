"""Bias mitigation: reweighing and per-group decision thresholds.

* :func:`reweighing_weights` gives w(g, y) = P(g) P(y) / P(g, y) (Kamiran and
  Calders 2012) from one ``groupBy(group, label)`` with partial aggregation;
  the (group, label) table is joined back to the rows as a ``weightCol``.
* :func:`group_thresholds` picks, per group, the score quantile that gives
  every group the same positive rate; the quantiles are exact and computed
  by the distributed quantile job (a hot group is split across tasks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.quantiles import exact_quantiles
from ..session import reliable_checkpoint


def reweighing_weights(df: DataFrame, group: str, label: str) -> DataFrame:
    """(group, label, n, weight) with weight = n_g * n_y / (n * n_gy).

    The marginals are aggregates of the (group, label) table: per-group sums
    join back on the group key, and the label totals (two rows) and the grand
    total (one row) are broadcast, so no window holds all groups in one task.
    """
    g = df.groupBy(F.col(group).alias("grp"), F.col(label).cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n"))
    # fresh key names on the aggregated sides keep the self-joins unambiguous
    by_g = g.groupBy(F.col("grp").alias("_g")).agg(F.sum("n").alias("_n_g"))
    by_y = g.groupBy(F.col("label").alias("_y")).agg(F.sum("n").alias("_n_y"))  # two rows
    total = g.agg(F.sum("n").alias("_n_all"))                                      # one row
    out = (g.join(by_g, F.col("grp").eqNullSafe(F.col("_g")))
            .join(F.broadcast(by_y), F.col("label") == F.col("_y"))
            .crossJoin(F.broadcast(total)))
    return out.select("grp", "label", "n",
                      (F.col("_n_g") * F.col("_n_y") / (F.col("_n_all") * F.col("n"))).alias("weight"))


#: Rows up to which a table of groups is broadcast, once it is counted.
BROADCAST_GROUPS = 100_000


def _small(table: DataFrame) -> DataFrame:
    """The table of groups, computed once; broadcast if its counted rows are few."""
    kept = reliable_checkpoint(table)
    return F.broadcast(kept) if kept.count() <= BROADCAST_GROUPS else kept


def reweigh(df: DataFrame, group: str, label: str, name: str = "weight") -> DataFrame:
    """Attach the reweighing weight to every row.

    The weights, at most two rows a group, are counted and broadcast, so rows
    are not shuffled on a group that may hold a third of them.
    """
    w = _small(reweighing_weights(df, group, label).select(
        F.col("grp").alias("_g"), F.col("label").alias("_y"), F.col("weight").alias(name)))
    cond = [F.col(group).eqNullSafe(F.col("_g")), F.col(label).cast("int") == F.col("_y")]
    return df.join(w, cond, "left").drop("_g", "_y")


def group_thresholds(df: DataFrame, group: str, score: str, target_rate: float | None = None,
                     pred: str | None = None) -> DataFrame:
    """(group, threshold): the (1 - rate) quantile of the score within each group.

    ``target_rate`` defaults to the overall positive rate of ``pred`` (a small
    statistic collected first).
    """
    if target_rate is None:
        if pred is None:
            raise ValueError("give target_rate or a pred column")
        target_rate = df.agg(F.avg(F.col(pred).cast("double"))).first()[0] or 0.0
    q = exact_quantiles(df.select(F.col(group).alias("grp"), F.col(score).cast("double").alias("_s")),
                        ["grp"], "_s", [1.0 - float(target_rate)])
    return q.select("grp", F.col("value").alias("threshold"))


def apply_thresholds(df: DataFrame, group: str, score: str, thresholds: DataFrame,
                     name: str = "pred_adjusted") -> DataFrame:
    """Positive when the score is above its group's threshold."""
    t = _small(thresholds.select(F.col("grp").alias("_g"), F.col("threshold").alias("_t")))
    out = df.join(t, F.col(group).eqNullSafe(F.col("_g")), "left")
    return out.withColumn(name, F.coalesce((F.col(score) > F.col("_t")).cast("int"), F.lit(0))).drop("_g", "_t")
