"""Attributions, per-row top factors and global importance.

* :func:`linear_attribution` is exact for a linear (logistic) model:
  ``phi_j = beta_j * (x_j - mean_j)`` for **every** row; the means are two
  aggregate passes and travel as literals (one number per feature).
* :func:`top_factors` sorts each row's own array, so it needs no explode and
  no shuffle.
* :func:`global_importance` is one aggregate (``avg(abs(phi_j))`` per feature)
  and an unpivot of that single row.
Tree models get their attributions from :mod:`.treeshap`.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PHI = "phi"


def feature_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Means of the values that are not null or NaN (0 for a feature without any).

    Sums are exact decimals, so reruns give the same means whatever order tasks
    finish in. The scale of each feature's decimal comes from its measured range
    and count, so that 38 digits hold both its sum and the digits of its smallest
    useful values. A feature with an infinite value has the mean of doubles.
    """
    feats = list(features)
    x = [F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None).cast("double")) for f in feats]
    seen = df.agg(*[e.alias(f"{k}{i}") for i, v in enumerate(x)
                    for k, e in (("n", F.count(v)), ("big", F.max(F.abs(v))), ("avg", F.avg(v)))]).first()
    exact = {}
    for i in range(len(feats)):
        n, big = seen[f"n{i}"], seen[f"big{i}"]
        if n and big and math.isfinite(big):
            scale = 36 - math.ceil(math.log10(big) + math.log10(n))
            if scale >= 0:
                exact[i] = min(scale, 37)
    sums = df.agg(*[F.sum(x[i].cast(f"decimal(38,{scale})")).alias(f"s{i}")
                    for i, scale in exact.items()]).first() if exact else None
    return {f: float(sums[f"s{i}"]) / seen[f"n{i}"] if i in exact else seen[f"avg{i}"] or 0.0
            for i, f in enumerate(feats)}


def linear_attribution(df: DataFrame, coefs: Mapping[str, float],
                       means: Mapping[str, float] | None = None,
                       name: str = PHI) -> DataFrame:
    """Add ``phi`` = array of per-feature contributions (in ``coefs`` order)."""
    feats = list(coefs)
    means = means if means is not None else feature_means(df, feats)
    terms = [(F.lit(float(coefs[f])) * (F.col(f"`{f}`").cast("double") - F.lit(float(means[f]))))
             for f in feats]
    return df.withColumn(name, F.array(*terms))


def factor_structs(phi: Column, features: Sequence[str]) -> Column:
    """array<struct<idx, feature, shap_value>> aligned with ``features``."""
    names = F.array(*[F.lit(f) for f in features])
    return F.transform(phi, lambda v, i: F.struct(
        i.alias("idx"), F.element_at(names, i + 1).alias("feature"), v.alias("shap_value")))


def top_factors(phi: Column, features: Sequence[str], k: int = 3) -> Column:
    """Top ``k`` by absolute value, ties to the higher feature index; each with
    direction and magnitude."""
    keyed = F.transform(factor_structs(phi, features), lambda s: F.struct(
        (-F.abs(s["shap_value"])).alias("neg_mag"), (-s["idx"]).alias("neg_idx"),
        s["feature"].alias("feature"), s["shap_value"].alias("shap_value")))
    best = F.slice(F.sort_array(keyed), 1, k)
    return F.transform(best, lambda s: F.struct(
        s["feature"].alias("feature"), s["shap_value"].alias("shap_value"),
        F.when(s["shap_value"] > 0, "increases risk").otherwise("decreases risk").alias("direction"),
        F.abs(s["shap_value"]).alias("magnitude")))


def factor_names(factors: Column) -> Column:
    return F.transform(factors, lambda s: s["feature"])


def factor_strength(factors: Column) -> Column:
    """Per factor: share of the largest magnitude (0..100, rounded) and a
    Strong / Moderate / Slight label."""
    biggest = F.greatest(F.array_max(F.transform(factors, lambda s: s["magnitude"])), F.lit(0.001))
    return F.transform(factors, lambda s: F.struct(
        s["feature"].alias("feature"),
        F.round(F.least(s["magnitude"] / biggest * 100.0, F.lit(100.0)), 0).alias("pct"),
    ))


def strength_label(pct: Column) -> Column:
    return F.when(pct > 70, "Strong").when(pct > 35, "Moderate").otherwise("Slight")


def global_importance(df: DataFrame, features: Sequence[str], phi: str = PHI,
                      top: int | None = None) -> DataFrame:
    """feature, importance (mean |phi|), relative (to the largest), rank."""
    feats = list(features)
    wide = df.agg(*[F.avg(F.abs(F.element_at(F.col(phi), i + 1))).alias(f"_{i}")
                    for i in range(len(feats))])
    long = wide.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("idx"), F.lit(f).alias("feature"), F.col(f"_{i}").alias("importance"))
        for i, f in enumerate(feats)])).alias("s")).select("s.*")
    # a handful of rows (one per feature): an unpartitioned window is fine here
    w = Window.orderBy(F.col("importance").desc(), F.col("idx").desc())
    out = long.select("feature", "importance",
                      (F.col("importance") / F.max("importance").over(Window.partitionBy())).alias("relative"),
                      F.row_number().over(w).alias("rank"))
    if top is not None:
        out = out.where(F.col("rank") <= top)
    return out
