"""Measured wrong answers of earlier versions, and the end-to-end run."""

import math

import pytest
from pyspark.sql import functions as F

from equitas.operators.attribution import feature_means, linear_attribution
from equitas.operators.discovery import discover
from equitas.operators.models import load_calibrated
from equitas.operators.silver import LIMITED, delta_pairs, encode, impute, plan_features, ratio_pairs, two_valued
from equitas.plans.quantiles import exact_quantiles
from equitas.plans.run import run
from equitas.sources.ingest import column_types, ingest, validate

NAMES = ["Sem 1 (grade)", "sem 2 (grade)", "Sem 3 (grade)", "sem 1 (credits)", "SEM 2 (credits)",
         "units 1 approved", "units 1 enrolled", "units 2 approved", "units 2 enrolled", "exam passed",
         "exam attempted", "tests correct", "total tests", "won", "played", "x10", "x2", "x3y4", "x5y4"]


def test_impute_integer_nan_and_empty_columns(spark):
    df = spark.createDataFrame(
        [(1, 1.0, None, None), (2, math.nan, None, None), (None, 3.0, None, None), (3, None, None, None),
         (4, None, None, None)], "a int, `b.c` double, f boolean, s string")
    clean = ingest(spark, df)
    assert clean.where("`b.c` is null").count() == 3
    assert validate(df).first().null_counts["b.c"] == 3
    out, fills = impute(clean)
    assert [r.a for r in out.collect()] == [1, 2, 2.5, 3, 4]
    assert [r["b.c"] for r in out.collect()] == [1, 2, 3, 2, 2]
    assert {r.f for r in out.collect()} == {None} and {r.s for r in out.collect()} == {"Unknown"}
    assert fills["a"] == 2.5


def test_means_at_any_scale(spark):
    df = spark.createDataFrame([(1e-12, 1e29, 1.0), (3e-12, 2e29, math.nan), (None, None, 3.0)],
                               "x double, y double, `z.w` double")
    assert feature_means(df, ["x", "y", "z.w"]) == {"x": 2e-12, "y": 1.5e29, "z.w": 2.0}
    phi = [r.phi for r in linear_attribution(df, {"x": 1.0, "z.w": 2.0}).collect()]
    assert phi[0] == [pytest.approx(-1e-12), -2.0]


def test_delta_pairs_are_all_found(spark):
    got = [tuple(r) for r in delta_pairs(spark, NAMES).collect()]
    assert got == [
        ("Sem 1 (grade)", "sem 2 (grade)", "sem_grade"), ("Sem 1 (grade)", "Sem 3 (grade)", "sem_grade"),
        ("sem 2 (grade)", "Sem 3 (grade)", "sem_grade"), ("sem 1 (credits)", "SEM 2 (credits)", "sem_credits"),
        ("units 1 approved", "units 2 approved", "units_approved"),
        ("units 1 enrolled", "units 2 enrolled", "units_enrolled"), ("x10", "x2", "x"), ("x3y4", "x5y4", "xy")]


def test_ratio_pairs_are_all_found(spark):
    assert [tuple(r) for r in ratio_pairs(spark, NAMES).collect()] == [
        ("units 1 approved", "units 1 enrolled", "ratio_units_1"),
        ("units 2 approved", "units 2 enrolled", "ratio_units_2"),
        ("exam passed", "exam attempted", "ratio_exam"), ("tests correct", "total tests", "ratio_tests")]


def test_limited_pairs_say_what_they_drop(spark):
    df = spark.range(3).select(*[F.col("id").alias(f"v{i}") for i in range(7)])
    every = plan_features(df)
    some = plan_features(df, limits=LIMITED)
    assert len(every.deltas) == 21 and not every.dropped
    assert len(some.deltas) == 10 and len(some.dropped) == 11


def test_two_valued(spark):
    df = spark.range(10).selectExpr("id % 2 a", "id b", "5 c", "cast(null as int) d",
                                    "if(id < 3, null, id div 9) e")
    assert two_valued(df, ["a", "b", "c", "d", "e"]) == {"a": 1, "e": 1}


def test_quantiles_have_one_formula(spark):
    """Reduced and full-size groups give the same doubles."""
    df = spark.range(2000).select((F.lit("k")).alias("k"), (F.rand(3) * 1e3).alias("v"))
    rows = sorted(r.v for r in df.collect())
    got = {r.q_idx: r.value for r in exact_quantiles(df, ["k"], "v", [0.1, 0.25, 0.9]).collect()}
    for i, p in enumerate([0.1, 0.25, 0.9]):
        pos = p * (len(rows) - 1)
        lo, hi = rows[math.floor(pos)], rows[math.ceil(pos)]
        assert got[i] == lo + (hi - lo) * (pos - math.floor(pos))


def test_no_window_over_one_partition(spark):
    from equitas.operators.evaluate import roc_auc
    df = spark.range(100).selectExpr("id % 2 y", "id / 100 s")
    assert "Exchange SinglePartition\n" not in roc_auc(df, "y", "s")._jdf.queryExecution().toString()


def test_encode_scans_the_input_once_for_any_number_of_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50).selectExpr("id", "cast(id % 3 as string) a", "cast(id % 5 as string) b",
                               "cast(id % 7 as string) c").write.parquet(path)
    out, cols = encode(spark.read.parquet(path))
    assert cols == ["a", "b", "c"]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    assert {(r.id % 3, r.a) for r in out.collect()} == {(0, 0), (1, 1), (2, 2)}


def test_encode_leaves_free_text(spark):
    df = spark.range(300).selectExpr("cast(id as string) text", "cast(id % 3 as string) a")
    out, cols = encode(df, max_cardinality=20)
    assert cols == ["a"] and dict(out.dtypes)["text"] == "string"


def test_names_settle_discovery_without_values(spark):
    df = spark.range(40).selectExpr("id customer_id", "cast(id % 2 as string) gender", "id % 2 churn", "id / 7 other")
    classified, picks, _ = discover({"t": df}, match="token")
    got = {r["column"]: r["class"] for r in classified.collect()}
    assert got["gender"] == "gender" and got["churn"] == "target"
    assert picks.first().target_column == "churn"


def test_column_types(spark):
    df = spark.createDataFrame([], "a int, b string")
    assert [tuple(r) for r in column_types(df).collect()] == [(0, "a", "int"), (1, "b", "string")]


def test_run_end_to_end(spark, tmp_path):
    rows = [(i, float(i % 17), float((i * 7) % 13), "m" if i % 3 else "f",
             int((i % 17) + (i * 5) % 3 > 8)) for i in range(400)]
    df = spark.createDataFrame(rows, "case_id long, a double, b double, gender string, churn int")
    out = str(tmp_path / "out")
    res = run(spark, df, target="churn", id_column="case_id", sensitive=[("gender", "gender")],
              kinds=("gbt",), n_trees=4, n_folds=3, out_dir=out)
    gold = res.gold.collect()
    assert len(gold) == 400 and len({r.entity_id for r in gold}) == 400
    assert all(0 <= r.risk_score <= 1 for r in gold)
    assert all(r.intervention_tier == ("High" if r.risk_score > 0.7 else "Medium" if r.risk_score >= 0.4 else "Low")
               for r in gold if abs(r.risk_score - 0.7) > 1e-3 and abs(r.risk_score - 0.4) > 1e-3)
    report = res.calibration.first()
    assert 0 <= report.brier_after <= 1 and res.summary.first().id_source == "column"
    assert {r.stage for r in spark.read.parquet(f"{out}/metrics").select("stage").distinct().collect()} == {
        "model_gbt", "gold", "calibration", "fairness_audit"}
    assert spark.read.parquet(f"{out}/gold/parquet").count() == 400
    back = load_calibrated(spark, f"{out}/calibrated")
    again = {r.case_id: r.p for r in back.score(df, name="p").select("case_id", "p").collect()}
    assert all(abs(again[int(r.entity_id)] - r.risk_score) < 1e-3 for r in gold)
    told = res.explain(spark.createDataFrame([(5,), (999,)], "id long")).collect()
    assert {r.case_id for r in told} == {5} and [r["rank"] for r in told] == [1, 2]
    asked = res.score_scenarios(spark.createDataFrame([(16.0,)], "a double")).first()
    assert 0 <= asked.prob <= 1 and len(asked.factors) == 2
    res.close()
