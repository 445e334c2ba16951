"""Model fitting, scoring and Platt calibration with MLlib.

* :func:`stratified_split` is order-free: per class, rows whose hash falls
  below the class's 20% hash quantile form the test set (the quantile is the
  distributed exact one, so no global window or sort is needed).
* :func:`fit` trains logistic regression, boosted trees (:mod:`.boosting`) or a
  random forest with class weights as a ``weightCol``.
* :func:`calibrate_cv` is Platt scaling with ``n_folds`` cross-fitting: each
  fold refits the base model on the other folds and fits a sigmoid to its own
  margins (Platt's smoothed targets); the calibrated probability is the mean of
  the fold models. Boosted trees of all folds grow in the same jobs, with the
  candidate model too (:func:`fit_with_folds`), and the sigmoids of all folds
  take their Newton steps in one aggregate. Folds are hashed per row.
* Independent fits (the folds, the candidate models) are submitted from a
  small thread pool, as ``CrossValidator(parallelism=...)`` does: each fit is
  a chain of short Spark jobs, and running several chains at once keeps the
  cluster busy between the jobs of any one chain.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..plans.quantiles import exact_quantiles
from .boosting import Boosted, fit_boosted, own_margins, with_margins
from .evaluate import class_weights

FEATURES = "features"
SEED = 42
# Independent model fits submitted at once (each one still uses every executor):
# enough for the five Platt folds to run in one round.
FIT_PARALLELISM = 5


def in_parallel(fn: Callable, items: Sequence, parallelism: int = FIT_PARALLELISM) -> list:
    """``[fn(x) for x in items]`` with up to ``parallelism`` fits in flight.

    Threads only submit Spark jobs; the work runs on the executors. Results
    keep the order of ``items``.
    """
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    # child threads carry the caller's job properties and tags
    target = inheritable_thread_target(SparkSession.active())(fn)
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as pool:
        return list(pool.map(target, items))


def split_hash(key_cols: Sequence[str], seed: int = SEED, kind: str = "xxhash") -> Column:
    """Row hash used for splits and folds. ``kind="md5"`` is a portable variant
    (first 15 hex digits of md5 of the key text) for cross-engine checks."""
    if kind == "md5":
        text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in key_cols])
        return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in key_cols])


def stratified_split(df: DataFrame, label: str, key_cols: Sequence[str], test_size: float = 0.2,
                     seed: int = SEED, kind: str = "xxhash", name: str = "is_test") -> DataFrame:
    """Add ``is_test``: per class, hashes at or below the class's ``test_size``
    quantile. Class shares are kept to within a row per class."""
    h = df.withColumn("_h", split_hash(key_cols, seed, kind).cast("double"))
    q = exact_quantiles(h.select(F.col(label).alias("_y"), "_h"), ["_y"], "_h", [test_size])
    cut = q.select(F.col("_y"), F.col("value").alias("_cut"))  # one row per class
    out = h.join(F.broadcast(cut), h[label].eqNullSafe(cut["_y"]), "left")
    return out.withColumn(name, F.coalesce(F.col("_h") <= F.col("_cut"), F.lit(False))).drop("_h", "_y", "_cut")


def assemble(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="keep")


def with_weights(df: DataFrame, label: str, mode: str) -> DataFrame:
    """``balanced`` = n / (2 n_c); ``scale_pos`` = n_neg / max(n_pos, 1) on positives."""
    w = class_weights(df, label)  # two rows
    col = "balanced_weight" if mode == "balanced" else "scale_pos_weight"
    w = w.select(F.col("label").alias("_lbl"),
                 (F.col(col) if mode == "balanced" else
                  F.when(F.col("label") == 1, F.col(col)).otherwise(F.lit(1.0))).alias("weight"))
    return df.join(F.broadcast(w), F.col(label).cast("long") == F.col("_lbl"), "left").drop("_lbl")


@dataclass
class Fitted:
    name: str
    model: PipelineModel
    features: list

    def score(self, df: DataFrame, prob: str = "prob", margin: str = "margin") -> DataFrame:
        """Probability of class 1 and the raw margin, for every row."""
        out = self.model.transform(df)
        arr = vector_to_array(F.col("probability"))
        raw = vector_to_array(F.col("rawPrediction"))
        return out.withColumn(prob, arr[1]).withColumn(margin, raw[1] - raw[0]).drop(
            FEATURES, "probability", "rawPrediction", "prediction")

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)


def estimator(kind: str, label: str, n_trees: int = 200, max_depth: int | None = None,
              reg_param: float = 0.0, max_iter: int = 1000):
    if kind == "logistic_regression":
        return LogisticRegression(featuresCol=FEATURES, labelCol=label, weightCol="weight",
                                  regParam=reg_param, elasticNetParam=0.0, standardization=False,
                                  maxIter=max_iter)
    if kind == "random_forest":
        return RandomForestClassifier(featuresCol=FEATURES, labelCol=label, weightCol="weight",
                                      numTrees=n_trees, maxDepth=max_depth or 10, seed=SEED)
    raise ValueError(kind)


def _weighted(train: DataFrame, features: Sequence[str], label: str, kind: str, weight_col: str | None) -> DataFrame:
    data = train.fillna(0, subset=[f"`{f}`" for f in features])
    if weight_col:
        data = data.withColumn("weight", F.col(f"`{weight_col}`").cast("double"))
    else:
        data = with_weights(data, label, "scale_pos" if kind == "gbt" else "balanced")
    return data.withColumn(label, F.col(f"`{label}`").cast("double"))


def fit(train: DataFrame, features: Sequence[str], label: str, kind: str = "gbt",
        n_trees: int = 200, max_depth: int | None = None, C: float = 1.0,
        weight_col: str | None = None) -> Fitted | Boosted:
    """Fit one model. Logistic regression uses L2 with ``regParam = 1 / (C * sum(w))``,
    which is the same objective as an unscaled ``C``-penalised fit.

    Rows are weighted by class (balanced; positives by n_neg / n_pos for boosted
    trees) unless ``weight_col`` names a weight already on the rows, e.g. the
    reweighing weights of :mod:`.mitigation`.
    """
    data = _weighted(train, features, label, kind, weight_col)
    if kind == "gbt":
        return fit_boosted(data, features, label, "weight", n_trees, max_depth or 6)[0]
    reg = 0.0
    if kind == "logistic_regression":
        total_w = data.agg(F.sum("weight")).first()[0] or 1.0
        reg = 1.0 / (C * total_w)
    pipe = Pipeline(stages=[assemble(features), estimator(kind, label, n_trees, max_depth, reg)])
    return Fitted(kind, pipe.fit(data), list(features))


def fit_with_folds(train: DataFrame, features: Sequence[str], label: str, key_cols: Sequence[str], n_folds: int = 5,
                   n_trees: int = 200, max_depth: int | None = None, whole: bool = True) -> list[Boosted]:
    """Boosted trees on all rows (unless not ``whole``) and on all but each fold's, in the same jobs."""
    data = _weighted(train.withColumn("_fold", fold_column(train, key_cols, n_folds)), features, label, "gbt", None)
    return fit_boosted(data, features, label, "weight", n_trees, max_depth or 6, fold="_fold", n_folds=n_folds,
                       whole=whole)


def fold_column(df: DataFrame, key_cols: Sequence[str], n_folds: int = 5, seed: int = SEED) -> Column:
    return F.pmod(split_hash(key_cols, seed + 1), F.lit(n_folds)).cast("int")


@dataclass
class Calibrated:
    folds: list          # [(Fitted base, A, B)]

    def score(self, df: DataFrame, name: str = "calibrated", beside: Boosted | None = None,
              before: str = "before") -> DataFrame:
        """Mean of the fold models' calibrated probabilities, and in ``before`` that of the model ``beside``.

        Boosted trees are all walked by one Python function, so a task needs one worker however many folds there are.
        """
        bases, margins = [base for base, _, _ in self.folds], [f"_m{i}" for i in range(len(self.folds))]
        more = [beside] if beside is not None else []
        if bases and all(isinstance(b, Boosted) and b.features == bases[0].features for b in [*bases, *more]):
            out = with_margins(df, [*bases, *more], [*margins, *["_beside"] * len(more)])
            if more:
                out = out.withColumn(before, F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("_beside")))).drop("_beside")
        else:
            out = df if beside is None else beside.score(df, prob=before, margin="_beside").drop("_beside")
            for base, m in zip(bases, margins):
                out = base.score(out, prob="_p", margin=m).drop("_p")
        parts = [F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(a) * F.col(m) + F.lit(b))))
                 for (_, a, b), m in zip(self.folds, margins)]
        avg = sum(parts, F.lit(0.0)) / F.lit(float(len(parts)))
        return out.withColumn(name, avg).drop(*margins)

    def save(self, path: str) -> None:
        """Each fold's model, and one row per fold with its sigmoid, under ``path``."""
        for i, (base, _, _) in enumerate(self.folds):
            base.save(f"{path}/fold{i}")
        rows = [(i, base.name, list(base.features), a, b) for i, (base, a, b) in enumerate(self.folds)]
        SparkSession.active().createDataFrame(
            rows, "fold int, name string, features array<string>, a double, b double"
        ).coalesce(1).write.mode("overwrite").parquet(f"{path}/sigmoids")


def load_calibrated(spark: SparkSession, path: str) -> Calibrated:
    """What :meth:`Calibrated.save` wrote."""
    rows = spark.read.parquet(f"{path}/sigmoids").orderBy("fold").collect()     # one row per fold
    return Calibrated([(load(f"{path}/fold{r['fold']}", r["name"], r["features"]), r["a"], r["b"]) for r in rows])


def platt_fit(scored: DataFrame, margin: str, label: str, fold: str | None = None, rounds: int = 50
              ) -> dict[int, tuple[float, float]]:
    """(A, B) of sigmoid(A * margin + B) per fold, fitted to Platt's smoothed targets.

    Newton steps of all folds share one aggregate each; a step that raises a
    fold's loss is halved.
    """
    data = scored.select((F.col(fold) if fold else F.lit(0)).cast("int").alias("k"),
                         F.col(margin).cast("double").alias("m"), (F.col(label) == 1).alias("y")).where("m is not null")
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    counts = {r["k"]: (r["p"], r["n"] - r["p"]) for r in data.groupBy("k").agg(
        F.count_if("y").alias("p"), F.count(F.lit(1)).alias("n")).collect()}          # one row per fold
    at = {k: (0.0, float(np.log((n + 1.0) / (p + 1.0))) * -1.0) for k, (p, n) in counts.items()}
    best: dict[int, tuple] = {}
    step = dict.fromkeys(at, 1.0)

    def by_fold(values: dict):
        out = F.lit(None).cast("double")
        for k, v in values.items():
            out = F.when(F.col("k") == k, F.lit(float(v))).otherwise(out)
        return out

    target = F.when(F.col("y"), by_fold({k: (p + 1.0) / (p + 2.0) for k, (p, _) in counts.items()})).otherwise(
        by_fold({k: 1.0 / (n + 2.0) for k, (_, n) in counts.items()}))
    data = data.withColumn("t", target)
    try:
        for _ in range(rounds):
            z = by_fold({k: v[0] for k, v in at.items()}) * F.col("m") + by_fold({k: v[1] for k, v in at.items()})
            now = data.withColumn("z", z).withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("z"))))
            loss = F.greatest("z", F.lit(0.0)) + F.log1p(F.exp(-F.abs("z"))) - F.col("t") * F.col("z")
            rest, curve = F.col("p") - F.col("t"), F.col("p") * (1 - F.col("p"))
            sums = now.groupBy("k").agg(
                F.sum(loss).alias("loss"), F.sum(rest * F.col("m")).alias("g0"), F.sum(rest).alias("g1"),
                F.sum(curve * F.col("m") * F.col("m")).alias("h00"), F.sum(curve * F.col("m")).alias("h01"),
                F.sum(curve).alias("h11")).collect()
            moved = False
            for r in sums:
                k = r["k"]
                if k not in best or r["loss"] <= best[k][0] + 1e-12:
                    gradient = np.array([r["g0"], r["g1"]])
                    curvature = np.array([[r["h00"] + 1e-10, r["h01"]], [r["h01"], r["h11"] + 1e-10]])
                    move = -np.linalg.solve(curvature, gradient)
                    best[k], step[k] = (r["loss"], at[k], move), 1.0
                    if np.abs(gradient).max() < 1e-8 * sum(counts[k]):
                        continue
                else:
                    step[k] /= 2
                    if step[k] < 1e-6:
                        continue
                _, base, move = best[k]
                at[k] = (base[0] + step[k] * move[0], base[1] + step[k] * move[1])
                moved = True
            if not moved:
                break
    finally:
        data.unpersist()
    return {k: (float(best[k][1][0]), float(best[k][1][1])) for k in at}


def calibrate_cv(train: DataFrame, features: Sequence[str], label: str, key_cols: Sequence[str],
                 kind: str = "gbt", n_folds: int = 5, n_trees: int = 200,
                 max_depth: int | None = None, parallelism: int = FIT_PARALLELISM,
                 bases: Sequence[Fitted | Boosted] | None = None) -> Calibrated:
    """Cross-fitted Platt scaling (needs at least ``n_folds`` rows per class).

    ``bases`` are the fold models, if :func:`fit_with_folds` has fitted them
    already. Other kinds than boosted trees fit up to ``parallelism`` folds at once.
    """
    data = train.withColumn("_fold", fold_column(train, key_cols, n_folds))
    per_class = data.groupBy(label).count().collect()
    if len(per_class) < 2 or min(r["count"] for r in per_class) < n_folds:
        raise ValueError(f"calibration needs at least {n_folds} rows of each class")
    if bases is None and kind == "gbt":
        bases = fit_with_folds(train, features, label, key_cols, n_folds, n_trees, max_depth, whole=False)
    elif bases is None:
        kept = data.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            bases = in_parallel(lambda k: fit(kept.where(F.col("_fold") != k), features, label, kind, n_trees,
                                              max_depth), range(n_folds), parallelism)
        finally:
            kept.unpersist()
    filled = data.fillna(0, subset=[f"`{f}`" for f in features])
    if all(isinstance(base, Boosted) for base in bases):            # one pass for all folds
        held = own_margins(filled, bases, "_fold", "margin").select("_fold", "margin", F.col(f"`{label}`").alias("_y"))
    else:
        held = reduce(DataFrame.unionAll, [
            base.score(filled.where(F.col("_fold") == k)).select("_fold", "margin", F.col(f"`{label}`").alias("_y"))
            for k, base in enumerate(bases)])
    sigmoids = platt_fit(held, "margin", "_y", "_fold")
    return Calibrated([(base, *sigmoids.get(k, (1.0, 0.0))) for k, base in enumerate(bases)])


def load(path: str, name: str, features: Sequence[str] | None = None) -> Fitted:
    """A saved model; the feature names come from its assembler stage unless given."""
    if name == "gbt":
        return Boosted.load(SparkSession.active(), path)
    model = PipelineModel.load(path)
    if features is None:
        features = model.stages[0].getInputCols()
    return Fitted(name, model, list(features))
