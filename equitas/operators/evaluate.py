"""Model evaluation: confusion counts, rates, exact AUC, Brier, score stats.

Every metric is an aggregate. Exact ROC AUC reduces the rows to one row per
distinct score first and takes the running count of negatives with the
distributed prefix sum, so no global row-level window or sort is needed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.prefix import running_totals
from ..plans.quantiles import exact_quantiles


def _int(c: str) -> Column:
    return F.col(c).cast("long")


def confusion(df: DataFrame, label: str, pred: str) -> DataFrame:
    """One row: tn, fp, fn, tp."""
    y, p = _int(label), _int(pred)
    return df.agg(F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def classification_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """accuracy, precision, recall, f1 (a zero denominator gives 0) plus counts."""
    c = confusion(df, label, pred)
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    precision = _div(tp, tp + fp)
    recall = _div(tp, tp + fn)
    return c.select("*", _div(tp + tn, tp + tn + fp + fn).alias("accuracy"), precision.alias("precision"),
                    recall.alias("recall"), _div(2 * tp, 2 * tp + fp + fn).alias("f1"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact ROC AUC (ties count one half), one row ``auc``; null when a class is missing."""
    per_score = df.groupBy(F.col(score).alias("_s")).agg(
        F.sum(_int(label)).alias("_pos"), F.sum(1 - _int(label)).alias("_neg"))
    run = running_totals(per_score, [], ["_s"], ["_neg"])
    below = F.col("cum__neg") - F.col("_neg")
    return run.agg(
        (F.sum(F.col("_pos") * (below + F.col("_neg") / 2.0))
         / F.when((F.sum("_pos") > 0) & (F.sum("_neg") > 0), F.sum("_pos") * F.sum("_neg"))
         ).alias("auc"))


def brier(df: DataFrame, label: str, prob: str) -> Column:
    return F.avg(F.pow(F.col(prob) - F.col(label).cast("double"), 2))


def score_stats(df: DataFrame, prob: str, label: str | None = None) -> DataFrame:
    """mean, population std, min, max, exact median (and Brier when ``label``)."""
    p = F.col(prob)
    aggs = [F.avg(p).alias("mean"), F.stddev_pop(p).alias("std"), F.min(p).alias("min"),
            F.max(p).alias("max")]
    if label:
        aggs.append(brier(df, label, prob).alias("brier"))
    stats = df.agg(*aggs)
    med = exact_quantiles(df.select(p.cast("double").alias("_p")), [], "_p", [0.5]).select(
        F.col("value").alias("median"))
    return stats.crossJoin(med)  # two one-row frames


def improvement_pct(before: Column, after: Column) -> Column:
    return (before - after) / F.greatest(before, F.lit(1e-10)) * 100.0


# Tie preference, boosted trees first.
MODEL_PREFERENCE = {"gbt": 2, "boosted_trees": 2, "xgboost": 2, "random_forest": 1,
                    "logistic_regression": 0}


def best_model(metrics: DataFrame, metric: str = "auc") -> DataFrame:
    """``metrics`` has one row per model; the best by ``metric`` (boosted trees
    win ties), one row."""
    pref = F.coalesce(F.create_map(*[x for k, v in MODEL_PREFERENCE.items()
                                     for x in (F.lit(k), F.lit(v))])[F.col("model")], F.lit(-1))
    return metrics.agg(F.max_by("model", F.struct(F.col(metric), pref)).alias("best_model"),
                       F.max(F.col(metric)).alias(f"best_{metric}"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Per class: n, balanced weight n / (2 n_c); and scale_pos_weight n_neg / max(n_pos, 1)."""
    counts = df.groupBy(_int(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    tot = counts.agg(F.sum("n").alias("_t"), F.sum(F.when(F.col("label") == 0, F.col("n"))).alias("_neg"),
                     F.sum(F.when(F.col("label") == 1, F.col("n"))).alias("_pos"))
    return counts.crossJoin(tot).select(   # tot is one row
        "label", "n", (F.col("_t") / (2.0 * F.col("n"))).alias("balanced_weight"),
        (F.coalesce(F.col("_neg"), F.lit(0)) / F.greatest(F.coalesce(F.col("_pos"), F.lit(0)), F.lit(1))
         ).cast("double").alias("scale_pos_weight"))


def weight_column(df: DataFrame, label: str, mode: str = "balanced", name: str = "weight") -> DataFrame:
    """Attach a per-row weight from :func:`class_weights` (two-row table, broadcast)."""
    w = class_weights(df, label)
    col = "balanced_weight" if mode == "balanced" else "scale_pos_weight"
    if mode != "balanced":
        w = w.withColumn(col, F.when(F.col("label") == 1, F.col(col)).otherwise(F.lit(1.0)))
    return df.join(F.broadcast(w.select(F.col("label").alias("_lbl"), F.col(col).alias(name))),
                   _int(label) == F.col("_lbl"), "left").drop("_lbl")


def metrics_table(rows: Mapping[str, DataFrame]) -> DataFrame:
    """Stack per-model one-row metric frames into (model, metrics...)."""
    out = None
    for model, frame in rows.items():
        f = frame.select(F.lit(model).alias("model"), "*")
        out = f if out is None else out.unionByName(f)
    return out


def evaluate(df: DataFrame, label: str, prob: str, pred: str | None = None,
             threshold: float = 0.5) -> DataFrame:
    """AUC, accuracy, precision, recall, f1, confusion counts in one row."""
    if pred is None:
        df = df.withColumn("_pred", (F.col(prob) >= threshold).cast("int"))
        pred = "_pred"
    return classification_metrics(df, label, pred).crossJoin(roc_auc(df, label, prob))

