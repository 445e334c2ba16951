"""Model fits, calibration, splits and TreeSHAP invariants."""

import itertools
import math
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from equitas.operators.models import calibrate_cv, fit, load, stratified_split
from equitas.operators.treeshap import TreeArrays, extract_trees, leaf_sets, shap_batch, tree_shap

from shap_recursion import shap_row

FEATS = ["a", "b", "c"]


def _frame(spark, n=400):
    rnd = np.random.default_rng(0)
    a, b, c = rnd.normal(size=n), rnd.integers(0, 4, size=n), rnd.uniform(size=n)
    y = ((a + 0.5 * b + rnd.normal(scale=0.7, size=n)) > 1).astype(int)
    rows = [(i, float(a[i]), float(b[i]), float(c[i]), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int")


def _cond_expectation(t, x, subset, node=0):
    if t.feature[node] < 0:
        return t.value[node]
    f = t.feature[node]
    if f in subset:
        nxt = t.left[node] if x[f] <= t.threshold[node] else t.right[node]
        return _cond_expectation(t, x, subset, nxt)
    lw, rw = t.cover[t.left[node]], t.cover[t.right[node]]
    return (lw * _cond_expectation(t, x, subset, t.left[node])
            + rw * _cond_expectation(t, x, subset, t.right[node])) / (lw + rw)


def _brute_shap(trees, x, m):
    phi = np.zeros(m)
    for t in trees:
        for i in range(m):
            others = [j for j in range(m) if j != i]
            for r in range(m):
                for s in itertools.combinations(others, r):
                    w = math.factorial(r) * math.factorial(m - r - 1) / math.factorial(m)
                    phi[i] += t.weight * w * (_cond_expectation(t, x, set(s) | {i})
                                              - _cond_expectation(t, x, set(s)))
    return phi


def test_gbt_treeshap_matches_brute_force_and_margin(spark):
    df = _frame(spark)
    model = fit(df, FEATS, "y", kind="gbt", n_trees=5, max_depth=3)
    trees, space = extract_trees(spark, model.model)
    assert space == "log_odds"
    x = np.array([0.3, 2.0, 0.5])
    assert np.allclose(shap_row(trees, x, 3), _brute_shap(trees, x, 3), atol=1e-9)
    rows = np.random.default_rng(5).normal(size=(50, 3)) * [1.0, 2.0, 0.5] + [0.0, 1.5, 0.5]
    assert np.allclose(shap_batch(leaf_sets(trees), rows), [shap_row(trees, r, 3) for r in rows], atol=1e-9)
    out = tree_shap(df, model.model, FEATS, ["id", "a", "b", "c"]).join(
        model.score(df).select("id", F.col("margin").alias("m2")), "id")
    bad = out.where(F.abs(F.col("margin") - F.col("m2")) > 1e-6).count()
    assert bad == 0


def _random_tree(rng, depth, m):
    """A full tree of random splits, some of them on a feature that the path has split on before."""
    size = 2 ** (depth + 1) - 1
    feature, inner = np.full(size, -1), 2 ** depth - 1
    feature[:inner] = rng.integers(0, m, inner)
    left, cover = np.arange(size) * 2 + 1, np.zeros(size)
    cover[inner:] = rng.integers(1, 50, size - inner)
    for i in range(inner - 1, -1, -1):
        cover[i] = cover[2 * i + 1] + cover[2 * i + 2]
    return TreeArrays(feature, rng.normal(size=size), left, left + 1, rng.normal(size=size), cover, rng.uniform(0.1, 2))


def test_leaf_tables_equal_the_recursion():
    """With tables, with some and with none; stumps, leaves alone, infinite values and no rows."""
    rng = np.random.default_rng(3)
    trees = [_random_tree(rng, d, 7) for d in (0, 1, 2, 4, 6, 6)]
    x = rng.normal(size=(40, 7))
    x[0], x[1], x[2, :3] = -np.inf, np.inf, trees[1].threshold[0]
    want = np.array([shap_row(trees, r, 7) for r in x])
    sizes = []
    for limit in (64 << 20, 20_000, 0):
        sets = leaf_sets(trees, limit)
        assert sum(s.table.nbytes for s in sets if s.table is not None) <= limit
        sizes.append(sum(s.table is not None for s in sets))
        assert np.allclose(shap_batch(sets, x), want, atol=1e-9)
    assert sizes[0] == len(sets) > sizes[1] > sizes[2] == 0
    assert shap_batch(sets, x[:0]).shape == (0, 7) and not shap_batch(leaf_sets(trees[:1]), x).any()
    few = [_random_tree(rng, 3, 4) for _ in range(3)]
    row = rng.normal(size=4)
    assert np.allclose(shap_batch(leaf_sets(few), row[None])[0], _brute_shap(few, row, 4), atol=1e-9)


def test_random_forest_shap_sums_to_probability(spark):
    df = _frame(spark, 200)
    model = fit(df, FEATS, "y", kind="random_forest", n_trees=4, max_depth=3)
    out = tree_shap(df, model.model, FEATS, ["id"]).join(model.score(df).select("id", "prob"), "id")
    assert out.where(F.abs(F.col("margin") - F.col("prob")) > 1e-6).count() == 0


def test_logistic_regression_and_platt(spark):
    df = _frame(spark)
    lr = fit(df, FEATS, "y", kind="logistic_regression")
    scored = lr.score(df)
    assert scored.where((F.col("prob") < 0) | (F.col("prob") > 1)).count() == 0
    cal = calibrate_cv(df, FEATS, "y", ["id"], kind="logistic_regression", n_folds=3)
    out = cal.score(df).select("a", "calibrated")
    assert out.where((F.col("calibrated") < 0) | (F.col("calibrated") > 1)).count() == 0
    path = tempfile.mkdtemp(prefix="equitas-model-")
    lr.save(path)
    back = load(path, "logistic_regression")   # feature names from the saved assembler
    assert back.features == FEATS
    again = back.score(df).select("id", F.col("prob").alias("p2")).join(scored.select("id", "prob"), "id")
    assert again.where(F.abs(F.col("p2") - F.col("prob")) > 1e-12).count() == 0


def test_stratified_split_keeps_class_shares(spark):
    df = _frame(spark, 1000)
    out = stratified_split(df, "y", ["id"]).groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_test").alias("t")).collect()
    for r in out:
        assert abs(r["t"] - 0.2 * r["n"]) <= 1


def test_forest_query_fits_the_operators_depth(spark, monkeypatch):
    from equitas.operators.models import estimator
    from equitas.plans import catalog

    class Fitted(Exception):
        pass

    def fitted(data, features, label, kind, n_trees, max_depth=None):
        raise Fitted(estimator(kind, label, n_trees, max_depth))

    monkeypatch.setattr(catalog, "_doc_model_frame", lambda *_: None)
    monkeypatch.setattr(catalog, "fit", fitted)
    with pytest.raises(Fitted) as got:
        catalog.QUERIES["fit_score_rf"](spark, "")
    assert (got.value.args[0].getMaxDepth(), got.value.args[0].getNumTrees()) == (10, 200)


def test_shap_of_rows_between_the_same_thresholds(monkeypatch):
    """Rows that no threshold parts are worked out once, with the values they have alone."""
    from equitas.operators import treeshap
    tree = treeshap.TreeArrays(np.array([0, 1, -1, -1, -1]), np.array([0.5, 2.0, 0, 0, 0]), np.array([1, 3, -1, -1, -1]),
                               np.array([2, 4, -1, -1, -1]), np.array([0, 0, 1.0, 2.0, -3.0]),
                               np.array([10.0, 6, 4, 2, 4]), 1.0)
    sets = treeshap.leaf_sets([tree])
    x = np.random.default_rng(1).normal(size=(500, 2)) * 3
    x[0], x[1] = [0.5, 2.0], [-np.inf, np.inf]
    sizes, plain = [], treeshap.shap_batch
    monkeypatch.setattr(treeshap, "shap_batch", lambda s, v: sizes.append(len(v)) or plain(s, v))
    assert np.allclose(treeshap.shap_rows(sets, x), plain(sets, x), atol=1e-14) and max(sizes) <= 6
