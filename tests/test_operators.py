"""Operator semantics on tiny frames with hand-computed answers."""

import pytest
from pyspark.sql import functions as F

from equitas.functions.text import display_name, intervention_tier, reason_text
from equitas.operators.attribution import linear_attribution, top_factors
from equitas.operators.audit import fairness_audit
from equitas.operators.discovery import discover
from equitas.operators.evaluate import roc_auc
from equitas.operators.silver import (engineer_features, impute, plan_features, prepare_target,
                                      TARGET)


def _report(spark, rows, schema, sens):
    df = spark.createDataFrame(rows, schema)
    res = fairness_audit(df, sens, "pred", "y")
    return {r["attribute"]: r for r in res.report.collect()}, res, df


def test_single_group_is_not_flagged(spark):
    rep, _, _ = _report(spark, [("a", 1, 1), ("a", 0, 1)], "g string, pred int, y int", ["g"])
    r = rep["g"]
    assert (r["dpd"], r["eod"], r["dpd_flagged"], r["dpd_max_group"]) == (0.0, 0.0, False, None)


def test_group_without_positives_counts_tpr_zero(spark):
    rep, res, _ = _report(spark, [("a", 1, 1), ("b", 0, 0)], "g string, pred int, y int", ["g"])
    assert rep["g"]["eod"] == 1.0
    tpr = {r["grp"]: r["tpr"] for r in res.groups.collect()}
    assert tpr == {"a": 1.0, "b": 0.0}


def test_gap_of_exactly_threshold_is_flagged(spark):
    rows = [("a", 1 if i == 0 else 0, 0) for i in range(20)] + [("b", 0, 0) for _ in range(20)]
    rep, _, _ = _report(spark, rows, "g string, pred int, y int", ["g"])
    assert rep["g"]["dpd_flagged"] is True


def test_quartile_bins_drop_duplicate_edges(spark):
    rows = [(float(v), 0, 0) for v in (0, 0, 0, 0, 1, 2)]
    rep, res, df = _report(spark, rows, "x double, pred int, y int", ["x"])
    assert res.plans[0].edges == [0.0, 0.75, 2.0]
    sizes = {r["grp"]: r["n"] for r in res.groups.collect()}
    assert sizes == {"0": 4, "1": 2}


def test_constant_float_attribute_is_one_group(spark):
    rep, _, _ = _report(spark, [(5.0, 1, 1), (5.0, 0, 1), (5.0, 1, 0)], "x double, pred int, y int", ["x"])
    assert rep["x"]["n_groups"] == 1 and rep["x"]["dpd"] == 0.0


def test_group_scope_flags_only_extreme_groups(spark):
    rows = [("a", 1, 1)] * 10 + [("b", 0, 1)] * 10 + [("c", 1, 1)] * 5 + [("c", 0, 1)] * 5
    _, res, df = _report(spark, rows, "g string, pred int, y int", ["g"])
    flags = res.entity_flags(df, scope="group").groupBy("g").agg(F.max("bias_flag").alias("f")).collect()
    assert {r["g"]: r["f"] for r in flags} == {"a": True, "b": True, "c": False}


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("b",), (None,)], "s string")
    out, fills = impute(df)
    assert fills["s"] == "a" and [r["s"] for r in out.collect()].count("a") == 3


def test_zero_denominator_ratio_and_last_pair_wins(spark):
    df = spark.createDataFrame([(3, 0, 1, 2, 4)], "cnt_approved int, cnt_enrolled int, x_1 int, x_2 int, x_3 int")
    plan = plan_features(df)
    out = engineer_features(df, plan).collect()[0]
    assert out["ratio_cnt"] == 0.0
    assert out["delta_x"] == 4 - 2


def test_null_string_target_keyword(spark):
    df = spark.createDataFrame([("yes",), ("no",), (None,)], "t string")
    out, rule = prepare_target(df, "t")
    assert rule.kind == "keyword"
    assert [r[TARGET] for r in out.orderBy(F.col("t").asc_nulls_last()).collect()] == [0, 1, 0]


def test_linear_attribution_and_reason(spark):
    df = spark.createDataFrame([(1.0, 1.0)], "f1 double, f2 double")
    out = linear_attribution(df, {"f1": 2.0, "f2": -1.0}, means={"f1": 0.0, "f2": 0.0})
    top = top_factors(F.col("phi"), ["f1", "f2"], 3)
    r = out.select(top.alias("t"), reason_text(top, F.lit("Low")).alias("txt")).collect()[0]
    assert [f["feature"] for f in r["t"]] == ["f1", "f2"]
    assert r["txt"] == "Low risk. Key factors: f1 and (mitigating) f2. No immediate action required."


@pytest.mark.parametrize("score,tier", [(0.7, "Medium"), (0.70001, "High"), (0.4, "Medium"),
                                        (0.39999, "Low")])
def test_tier_edges(spark, score, tier):
    assert spark.range(1).select(intervention_tier(F.lit(score))).first()[0] == tier


def test_display_name(spark):
    got = spark.createDataFrame([("applicantIncome_total-Amount",)], "c string").select(
        display_name(F.col("c"))).first()[0]
    assert got == "applicant income total amount"


def test_discovery_on_small_sample(spark):
    rows = [(i, 20 + 3 * i, "M" if i % 2 else "F", ["Full-time", "Part-time", "Unemployed"][i % 3],
             1000 * i, i % 2, (i // 2) % 2) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "id long, age long, gender string, employment_type string, "
                                     "income long, has_debt long, risk_flag long")
    classified, picks, _ = discover({"t": df})
    cls = {r["column"]: (r["class"], r["feature_group"]) for r in classified.collect()}
    assert cls["id"][0] == "identifier" and cls["age"][0] == "age" and cls["gender"][0] == "gender"
    assert cls["employment_type"][0] == "target"          # contains the letter y
    assert cls["has_debt"][0] == "socioeconomic" and cls["risk_flag"][1] == "numerical"
    p = picks.first()
    assert p["target_column"] == "income" and p["id_column"] == "id" and p["entity_prefix"] == "ENT"
    assert p["sensitive_columns"] == ["age", "gender", "has_debt"]


def test_auc_matches_pairwise_count(spark):
    import random
    rnd = random.Random(1)
    rows = [(rnd.choice([0.1, 0.2, 0.3, 0.4]), rnd.randint(0, 1)) for _ in range(200)]
    df = spark.createDataFrame(rows, "s double, y int")
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(roc_auc(df, "y", "s").first()["auc"] - want) < 1e-12
