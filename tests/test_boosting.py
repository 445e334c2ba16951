"""Second-order boosting against a plain one, its invariances, and end-to-end runs over awkward tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from equitas.operators import boosting
from equitas.operators.boosting import Boosted, fit_boosted
from equitas.operators.models import calibrate_cv, fit_with_folds, platt_fit
from equitas.plans.run import plain_names, run

FEATS = ["a", "b.c"]


def rows(n=700, seed=0):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(0, 40, n), np.round(rng.normal(size=n), 1)
    y = (a / 20 + b + rng.normal(scale=0.8, size=n) > 1).astype(int)
    return [(int(i), float(a[i]), float(b[i]), int(y[i]), float(1 + 3 * y[i]), int(i % 3)) for i in range(n)]


def frame(spark, data):
    return spark.createDataFrame(data, "id long, a double, `b.c` double, y int, w double, fold int")


def plain_boost(data, left_out, n_trees, depth, rate=0.1, ridge=1.0, min_child=1.0):
    """Margins of all rows by trying every value of every feature as a split, node by node."""
    x, y = np.array([r[1:3] for r in data]), np.array([r[3] for r in data])
    w = np.array([0.0 if r[5] == left_out else r[4] for r in data])
    margin = np.zeros(len(data))
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        todo = [(np.arange(len(data)), 0)]
        while todo:
            at, level = todo.pop()
            best = (1e-6, None, None)
            for f in range(2) if level < depth else ():
                for v in np.unique(x[:, f])[:-1]:
                    left = x[at, f] <= v
                    gl, hl, gr, hr = g[at][left].sum(), h[at][left].sum(), g[at][~left].sum(), h[at][~left].sum()
                    if hl >= min_child and hr >= min_child:
                        gain = gl ** 2 / (hl + ridge) + gr ** 2 / (hr + ridge) - (gl + gr) ** 2 / (hl + hr + ridge)
                        if gain > best[0] + 1e-9:
                            best = (gain, f, v)
            if best[1] is None:
                margin[at] -= rate * g[at].sum() / (h[at].sum() + ridge)
            else:
                left = x[at, best[1]] <= best[2]
                todo += [(at[left], level + 1), (at[~left], level + 1)]
    return margin


def test_equals_plain_boosting(spark):
    data = rows()
    df = frame(spark, data)
    models = fit_boosted(df, FEATS, "y", "w", n_trees=4, max_depth=3, fold="fold", n_folds=3)
    x = np.array([r[1:3] for r in data])
    for model, left_out in zip(models, [None, 0, 1, 2]):
        assert np.allclose(model.margins(x), plain_boost(data, left_out, 4, 3), atol=1e-8)
    got = {r["id"]: r for r in models[0].score(df).collect()}
    assert np.allclose([got[r[0]]["margin"] for r in data], models[0].margins(x), atol=1e-12)


def test_blocks_and_partitions_change_nothing(spark, monkeypatch):
    """One block in one job, and many blocks with a job a level, give the very same trees."""
    data = rows(900, 4)
    one = fit_boosted(frame(spark, data).coalesce(1), FEATS, "y", "w", n_trees=23, max_depth=3, fold="fold", n_folds=2)
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    monkeypatch.setattr(boosting, "TREE_CHUNK", 10)
    many = fit_boosted(frame(spark, data[::-1]).repartition(5), FEATS, "y", "w", n_trees=23, max_depth=3, fold="fold",
                       n_folds=2)
    for a, b in zip(one, many):
        for name in ("split", "threshold", "value", "cover", "gain"):
            assert (getattr(a, name) == getattr(b, name)).all(), name


def test_quantile_bins_of_many_values(spark):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("v"), (F.col("id") % 7).cast("double").alias("k"))
    many, few = boosting.bin_edges(df, ["v", "k"])
    assert len(many) <= 255 and (np.diff(many) > 0).all() and abs(many[127] - 10_000) < 100
    assert few.tolist() == [0, 1, 2, 3, 4, 5]


def test_saved_model_scores_alike(spark, tmp_path):
    df = frame(spark, rows(200))
    model = fit_boosted(df, FEATS, "y", "w", n_trees=3, max_depth=2)[0]
    model.save(str(tmp_path / "m"))
    again = Boosted.load(spark, str(tmp_path / "m"))
    x = np.random.default_rng(3).normal(size=(50, 2)) * 20
    assert again.features == FEATS and (again.margins(x) == model.margins(x)).all()


@pytest.mark.parametrize("data", [[], [(1, 1.0, None, 1, 1.0, 0)], [(i, 1.0, 2.0, 0, 1.0, 0) for i in range(9)]])
def test_nothing_to_split(spark, data):
    model = fit_boosted(frame(spark, data), FEATS, "y", "w", n_trees=2, max_depth=2)[0]
    assert (model.split[:, 0] == -1).all()


def test_sigmoids_are_optimal(spark):
    rng = np.random.default_rng(2)
    m = rng.normal(size=600) * 3
    data = [(int(i % 2), float(m[i]), int(rng.random() < 1 / (1 + np.exp(-(0.7 * m[i] - 0.4 + i % 2))))) for i in range(600)]
    got = platt_fit(spark.createDataFrame(data, "k int, m double, y int"), "m", "y", "k")
    for k in (0, 1):
        own = [(v, y) for f, v, y in data if f == k]
        n, p = len(own), sum(y for _, y in own)
        x, t = np.array([v for v, _ in own]), np.array([(p + 1) / (p + 2) if y else 1 / (n - p + 2) for _, y in own])
        rest = 1 / (1 + np.exp(-(got[k][0] * x + got[k][1]))) - t
        assert abs(rest.sum()) < 1e-4 and abs((rest * x).sum()) < 1e-4


def test_folds_fitted_beside_the_candidate(spark):
    df = frame(spark, rows(400)).withColumnRenamed("b.c", "b")
    apart = calibrate_cv(df, ["a", "b"], "y", ["id"], n_folds=3, n_trees=5, max_depth=2)
    together = calibrate_cv(df, ["a", "b"], "y", ["id"], n_folds=3, bases=fit_with_folds(
        df, ["a", "b"], "y", ["id"], 3, 5, 2)[1:])
    assert [f[1:] for f in apart.folds] == [f[1:] for f in together.folds]


def test_plain_names():
    assert plain_names(["a.b", "a_b", "c d", "a`b"]) == ["a_b_", "a_b", "c d", "a_b__"]


def awkward(spark, n=240):
    """Rows repeated unevenly, dotted names, and no column that identifies rows."""
    data = []
    for i in range(n):
        data += [(float(i % 37), float((i * 7) % 11), "fm"[i % 2], int((i % 37) + (i * 7) % 11 > 22))] * (1 + 5 * (i % 9 == 0))
    return spark.createDataFrame(data, "`a.b` double, load double, gender string, churn int")


@pytest.mark.parametrize("kind", ["gbt", "logistic_regression"])
def test_run_without_id_over_repeated_rows(spark, kind):
    df = awkward(spark)
    res = run(spark, df, target="churn", id_column="", sensitive=[("gender", "gender")], n_trees=5, max_depth=2,
              n_folds=3, kinds=(kind,))
    try:
        assert res.schema["id_column"] is None and "a.b" in res.features
        assert res.gold.count() == df.count() and res.gold.select("entity_id").distinct().count() == df.count()
        scored = [r for r in res.scored.select("risk_score").collect()]
        assert len(scored) == df.count()
        tests = res.gold.sparkSession.read.parquet(f"{res.folder}/scored").where("is_test")
        want = tests.agg(*[F.avg((F.col(c) - F.col("target_binary")) ** 2) for c in ("before", "risk_score")]).first()
        report = res.calibration.first()
        assert np.allclose([report["brier_before"], report["brier_after"]], want)
        names = {n for r in res.gold.select("top_factors").collect() for n in r["top_factors"]}
        assert names <= {f for f in res.features}
        more = res.score_scenarios(spark.createDataFrame([(5.0, 3.0)], "`a.b` double, load double"))
        assert "a.b" in more.columns and "a_b" not in more.columns and 0 <= more.first()["prob"] <= 1
    finally:
        res.close()


def test_rows_of_one_cell_are_merged(spark, monkeypatch):
    """Few possible cells: many partitions make one block, with the trees that unmerged rows give."""
    rng = np.random.default_rng(6)
    data = [(i, float(rng.integers(0, 5)), float(rng.integers(0, 3)), int(rng.random() < 0.4), 2.0, int(i % 2)) for i in
            range(2_000)]
    packed = []
    keep = boosting.parquet_handover
    monkeypatch.setattr(boosting, "parquet_handover", lambda df, *a: packed.append(keep(df, *a)) or Held(packed[-1]))

    class Held:
        def __init__(self, df):
            self.rdd, self.repartition = df.rdd, df.repartition
            self.n, self.rows = df.count(), sum(r["n"] for r in df.select("n").collect())

        def count(self):
            sizes.append((self.n, self.rows))
            return self.n

    sizes: list = []
    df = frame(spark, data).repartition(6)
    merged = fit_boosted(df, FEATS, "y", "w", n_trees=5, max_depth=3, fold="fold", n_folds=2)
    monkeypatch.setattr(boosting.math, "prod", lambda e: 1 << 40)       # as if cells were many
    apart = fit_boosted(df, FEATS, "y", "w", n_trees=5, max_depth=3, fold="fold", n_folds=2)
    assert sizes[0][0] == 1 and sizes[0][1] <= 60 and sizes[1] == (6, 2_000)
    for a, b in zip(merged, apart):
        for name in ("split", "threshold", "value", "cover", "gain"):
            assert (getattr(a, name) == getattr(b, name)).all(), name


def test_all_folds_are_scored_by_one_python_function(spark):
    df = frame(spark, rows(300)).withColumnRenamed("b.c", "b")
    whole, *bases = fit_with_folds(df, ["a", "b"], "y", ["id"], 3, 4, 2)
    cal = calibrate_cv(df, ["a", "b"], "y", ["id"], n_folds=3, bases=bases)
    out = cal.score(df, beside=whole)
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    x = np.array([r[1:3] for r in rows(300)])
    want = np.mean([1 / (1 + np.exp(-(a * base.margins(x) + b))) for base, a, b in cal.folds], axis=0)
    got = {r["id"]: r for r in out.collect()}
    assert np.allclose([got[i]["calibrated"] for i in range(300)], want, atol=1e-12)
    assert np.allclose([got[i]["before"] for i in range(300)], 1 / (1 + np.exp(-whole.margins(x))), atol=1e-12)


def test_scoring_of_repeated_and_extreme_rows():
    """Margins node by node from the thresholds, however many rows fall between the same ones."""
    rng = np.random.default_rng(8)
    split = np.array([[0, 1, -1, -1, -1, -2, -2], [1, -1, 0, -2, -2, -1, -1]])
    model = Boosted(["a", "b"], split, rng.normal(size=(2, 7)), rng.normal(size=(2, 7)), np.ones((2, 7)))
    x = np.concatenate([np.repeat(rng.normal(size=(9, 2)), 40, axis=0), rng.normal(size=(50, 2)),
                        [[np.inf, -np.inf], [model.threshold[0, 0], model.threshold[1, 0]]]])
    for r, m in zip(x, model.margins(x)):
        want = 0.0
        for t in range(2):
            at = 0
            while split[t, at] >= 0:
                at = 2 * at + 1 + (r[split[t, at]] > model.threshold[t, at])
            want += model.value[t, at]
        assert m == want
    assert (model.margins(x[-3:]) == model.margins(x)[-3:]).all()


def test_state_of_blocks_is_shared_by_the_workers_of_an_executor(monkeypatch, tmp_path):
    rng = np.random.default_rng(4)
    records = np.zeros(3000, boosting._record(2))
    records["bins"], records["w"] = rng.integers(0, 20, (3000, 2)), 1.0
    records["y"] = records["bins"].sum(axis=1) + rng.integers(0, 9, 3000) > 22
    blocks = [boosting._open(boosting._block(part, np.ones(len(part))).iloc[0]) for part in np.split(records, 3)]
    settings = dict(edges=[np.arange(19.0)] * 2, left_out=[None], total_weight=3000.0, depth=3, rate=0.1, ridge=1.0,
                    min_child=1.0)
    added, add = [], boosting._State.add

    def counted(state, *args):
        added.append(1)
        add(state, *args)

    def another_worker(job):
        boosting._MEMO.clear()
        return next(boosting._sums(iter(blocks), job))

    want = [boosting._Trainer(lambda job: next(boosting._sums(iter(blocks), job)), boosting._Here, **settings)]
    want = [want[0].tree() for _ in range(6)]
    monkeypatch.setenv("SPARK_LOCAL_DIRS", str(tmp_path))
    monkeypatch.setattr(boosting._State, "add", counted)
    trainer = boosting._Trainer(another_worker, boosting._Here, **settings, spread=True)
    got = [trainer.tree() for _ in range(6)]
    assert all((a[k] == b[k]).all() for a, b in zip(got, want) for k in a)
    assert len(added) == 5 * len(blocks)                # each finished tree once, not again for each job
    file = next(tmp_path.glob("*/*"))
    held = boosting._kept_file(trainer.run, file.name)  # another attempt has it: worked out anew, to the same
    assert boosting._kept_file(trainer.run, file.name) is None
    seventh = trainer.tree()
    held.close()
    list(boosting._forget(None, trainer.run))
    assert not list(tmp_path.iterdir())
    monkeypatch.delenv("SPARK_LOCAL_DIRS")
    again = boosting._Trainer(another_worker, boosting._Here, **settings, spread=True)
    assert all((seventh[k] == v).all() for k, v in [again.tree() for _ in range(7)][-1].items())
