"""Batch what-if scenarios.

* :func:`baseline` — one row of per-feature medians (else means, else 0).
* :func:`grid` — for every feature, 101 evenly spaced values from its min to
  its max with the other features at the baseline (a sensitivity sweep).
* :func:`score_scenarios` — score any table of feature vectors; features the
  table lacks default to 0, as in the single-vector simulator.

The statistics are one aggregate plus the distributed exact medians; the grid
is ``explode(sequence(0, steps))`` over a one-row frame per feature.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import decide, linear_score
from ..functions.text import intervention_tier
from .attribution import linear_attribution, top_factors
from .profile import feature_stats
from .treeshap import tree_shap

STEPS = 100


def baseline(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, min, max, baseline) with baseline = median, else mean, else 0."""
    st = feature_stats(df, features)
    return st.select("feature", "min", "max",
                     F.coalesce(F.col("median"), F.col("mean"), F.lit(0.0)).alias("baseline"))


def grid(df: DataFrame, features: Sequence[str], steps: int = STEPS) -> DataFrame:
    """(feature, step, value, <feature columns...>): one sweep per feature."""
    feats = list(features)
    base = baseline(df, feats)
    wide = base.groupBy().pivot("feature", feats).agg(F.first("baseline"))  # one row, one column per feature
    sweep = base.select("feature", "min", "max",
                        F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("step"))
    sweep = sweep.withColumn("value", F.col("min") + F.col("step") * (F.col("max") - F.col("min")) / steps)
    both = sweep.crossJoin(wide.select(*[F.col(f).alias(f"_b_{f}") for f in feats]))  # wide is one row
    return both.select("feature", "step", "value", *[
        F.when(F.col("feature") == f, F.col("value")).otherwise(F.col(f"_b_{f}")).alias(f) for f in feats])


def score_scenarios(scenarios: DataFrame, intercept: float, coefs: Mapping[str, float],
                    means: Mapping[str, float] | None = None, k: int = 5) -> DataFrame:
    """Probability, 0/1 prediction, tier and the top ``k`` factors per scenario.
    Missing feature columns are 0."""
    filled = scenarios
    for f in coefs:
        filled = filled.withColumn(f, F.coalesce(F.col(f"`{f}`"), F.lit(0.0)) if f in scenarios.columns else F.lit(0.0))
    p = linear_score(intercept, coefs)
    out = linear_attribution(filled.withColumn("prob", p), coefs, means=means)
    return out.withColumn("prediction", decide(F.col("prob"))) \
              .withColumn("intervention_tier", intervention_tier(F.col("prob"))) \
              .withColumn("factors", top_factors(F.col("phi"), list(coefs), k))


def score_fitted(scenarios: DataFrame, fitted, features: Sequence[str], calibrated=None, k: int = 5,
                 names: Sequence[str] | None = None) -> DataFrame:
    """Scenarios through a fitted model: probability, prediction, tier and top ``k`` factors.

    ``calibrated`` gives the probability if there is one, else ``fitted`` does.
    Factors are TreeSHAP for trees, and exact linear attributions (against
    feature value 0) for a logistic regression. Missing features are 0.
    ``names`` are what the factors are called, if not as the columns.
    """
    filled = scenarios
    for f in features:
        filled = filled.withColumn(f, F.coalesce(F.col(f"`{f}`").cast("double"), F.lit(0.0))
                                   if f in scenarios.columns else F.lit(0.0))
    if calibrated is not None:
        scored = calibrated.score(filled, name="prob")
    else:
        scored = fitted.score(filled).drop("margin")
    if fitted.name == "logistic_regression":
        coefs = {f: float(b) for f, b in zip(features, fitted.model.stages[-1].coefficients)}
        out = linear_attribution(scored, coefs, means={f: 0.0 for f in features})
    else:
        out = tree_shap(scored, fitted.model, features, scored.columns)
    return out.withColumn("prediction", decide(F.col("prob"))) \
              .withColumn("intervention_tier", intervention_tier(F.col("prob"))) \
              .withColumn("factors", top_factors(F.col("phi"), list(names or features), k))
