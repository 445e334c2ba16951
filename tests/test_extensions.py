"""Mitigation, scenarios, gold read-side operators and the streaming monitor,
on tiny frames with hand-computed answers."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from equitas.operators.gold import build_gold, gold_page, gold_summary, sort_gold, tier_share
from equitas.operators.mitigation import apply_thresholds, group_thresholds, reweigh, reweighing_weights
from equitas.operators.scenarios import baseline, grid, score_scenarios
from equitas.streaming.monitor import bias_by_window, run_monitor


def test_reweighing_weights_balance_groups(spark):
    rows = [("a", 1), ("a", 1), ("a", 0), ("b", 1), ("b", 0), ("b", 0)]
    df = spark.createDataFrame(rows, "g string, y int")
    w = {(r["grp"], r["label"]): r["weight"] for r in reweighing_weights(df, "g", "y").collect()}
    # n = 6, every marginal is 3: w = 3 * 3 / (6 * n_gy)
    assert w == {("a", 1): 0.75, ("a", 0): 1.5, ("b", 1): 1.5, ("b", 0): 0.75}
    out = reweigh(df, "g", "y").groupBy("g").agg(
        (F.sum(F.col("y") * F.col("weight")) / F.sum("weight")).alias("rate"))
    assert {r["g"]: r["rate"] for r in out.collect()} == {"a": 0.5, "b": 0.5}


def test_group_thresholds_equalise_positive_rates(spark):
    rows = [("a", i / 10) for i in range(1, 11)] + [("b", i / 20) for i in range(1, 11)]
    df = spark.createDataFrame(rows, "g string, s double")
    th = group_thresholds(df, "g", "s", target_rate=0.3)
    got = {r["grp"]: round(r["threshold"], 9) for r in th.collect()}
    # 0.7 quantile of ten evenly spaced values: 0.7 + 0.3 * (0.8 - 0.7)
    assert got == {"a": 0.73, "b": 0.365}
    adj = apply_thresholds(df, "g", "s", th).groupBy("g").agg(F.avg("pred_adjusted").alias("r"))
    assert {r["g"]: r["r"] for r in adj.collect()} == {"a": 0.3, "b": 0.3}


def test_group_thresholds_default_to_overall_rate(spark):
    rows = [("a", 0.9, 1), ("a", 0.1, 0), ("b", 0.8, 1), ("b", 0.2, 0)]
    df = spark.createDataFrame(rows, "g string, s double, p int")
    th = {r["grp"]: r["threshold"] for r in group_thresholds(df, "g", "s", pred="p").collect()}
    assert th == pytest.approx({"a": 0.5, "b": 0.5})


def _gold(spark):
    rows = [(i, s, [("f1", 0.5), ("f2", -0.1)], i % 2 == 0)
            for i, s in enumerate([0.9, 0.75, 0.5, 0.45, 0.2, 0.75, 0.05])]
    df = spark.createDataFrame(
        rows, "id long, score double, factors array<struct<feature:string,shap_value:double>>, flag boolean")
    df = df.withColumn("factors", F.transform("factors", lambda s: F.struct(
        s["feature"].alias("feature"), s["shap_value"].alias("shap_value"),
        F.when(s["shap_value"] > 0, "increases risk").otherwise("decreases risk").alias("direction"),
        F.abs(s["shap_value"]).alias("magnitude"))))
    return build_gold(df, "score", "factors", "flag", id_column="id")


def test_gold_sort_page_and_summary(spark):
    g = _gold(spark)
    first = [r["entity_id"] for r in gold_page(g, page=1, page_size=3).collect()]
    # 0.75 twice: the entity id breaks the tie
    assert first == ["0", "1", "5"]
    second = [r["entity_id"] for r in gold_page(g, page=2, page_size=3).collect()]
    assert second == ["2", "3", "4"]
    assert [r["entity_id"] for r in gold_page(g, page=3, page_size=3).collect()] == ["6"]
    asc = [r["entity_id"] for r in gold_page(g, page=1, page_size=2, sort_by="risk_score", desc=False).collect()]
    assert asc == ["6", "4"]
    assert sort_gold(g, sort_by="no_such_column").count() == 7
    s = gold_summary(g, page_size=3).first()
    assert (s["total_entities"], s["high_risk_count"], s["medium_risk_count"], s["low_risk_count"]) == (7, 3, 2, 2)
    assert (s["bias_flagged"], s["total_pages"]) == (4, 3)
    high_flagged = gold_summary(g, tier="High", bias_only=True).first()
    assert (high_flagged["total_entities"], high_flagged["bias_rate"]) == (1, 1.0)
    none = gold_summary(g.where(F.lit(False))).first()
    assert (none["total_entities"], none["bias_rate"], none["avg_risk_score"], none["total_pages"]) == (0, 0.0, 0.0, 0)
    shares = {r["intervention_tier"]: (r["n"], round(r["pct"], 6)) for r in tier_share(g).collect()}
    assert shares == {"High": (3, round(300 / 7, 6)), "Medium": (2, round(200 / 7, 6)),
                      "Low": (2, round(200 / 7, 6))}


def test_gold_without_id_numbers_entities_in_order(spark):
    df = spark.createDataFrame([(30, 0.1), (10, 0.8), (20, 0.5)], "k long, score double") \
        .withColumn("factors", F.array().cast("array<struct<feature:string,shap_value:double,"
                                             "direction:string,magnitude:double>>"))
    g = build_gold(df, "score", "factors", None, id_column=None, prefix="STU", order=["k"])
    got = {r["entity_id"]: r["risk_score"] for r in g.collect()}
    assert got == {"STU-00000": 0.8, "STU-00001": 0.5, "STU-00002": 0.1}


def test_scenario_baseline_grid_and_missing_features(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, 20.0), (4.0, None)], "a double, b double")
    b = {r["feature"]: (r["min"], r["max"], r["baseline"]) for r in baseline(df, ["a", "b"]).collect()}
    assert b == {"a": (1.0, 4.0, 2.0), "b": (10.0, 20.0, 15.0)}
    gr = grid(df, ["a", "b"], steps=4).orderBy("feature", "step").collect()
    assert len(gr) == 10
    sweep_a = [(r["a"], r["b"]) for r in gr if r["feature"] == "a"]
    assert sweep_a == [(1.0, 15.0), (1.75, 15.0), (2.5, 15.0), (3.25, 15.0), (4.0, 15.0)]
    sc = spark.createDataFrame([(1, 2.0)], "id int, a double")
    out = score_scenarios(sc, 0.0, {"a": 1.0, "b": 5.0}, means={"a": 0.0, "b": 0.0}, k=5).first()
    # b is absent: it counts as 0, so only a moves the score
    assert out["prob"] == pytest.approx(1 / (1 + 2.718281828459045 ** -2.0))
    assert out["prediction"] == 1 and out["intervention_tier"] == "High"
    assert [f["feature"] for f in out["factors"]][0] == "a"


def _write_events(path, name, rows):
    t = pa.table({"ts": pa.array([r[0] for r in rows], pa.timestamp("us")),
                  "g": pa.array([r[1] for r in rows]), "p": pa.array([r[2] for r in rows], pa.int32()),
                  "y": pa.array([r[3] for r in rows], pa.int32())})
    pq.write_table(t, os.path.join(path, name))


def test_stream_monitor_resumes_matches_batch_and_drops_late_rows(spark, tmp_path):
    src = tmp_path / "events"
    src.mkdir()
    d = lambda day, hour: dt.datetime(2024, 1, day, hour)
    first = [(d(1, 1), "a", 1, 1), (d(1, 2), "a", 0, 1), (d(1, 3), "b", 0, 1), (d(1, 4), "b", 0, 0),
             (d(2, 1), "a", 1, 0), (d(2, 2), "b", 1, 1), (d(2, 12), "b", 0, 0)]
    # arrives after a restart: a row for the already closed day 1, then later rows
    second = [(d(1, 5), "b", 1, 1), (d(3, 12), "a", 1, 1), (d(4, 12), "a", 0, 1)]
    _write_events(str(src), "f1.parquet", first)
    attrs = [("g", F.col("g"))]
    schema = spark.read.parquet(str(src)).schema
    day = lambda k: int(dt.datetime(2024, 1, k, tzinfo=dt.timezone.utc).timestamp())

    def monitor():
        out = run_monitor(spark, str(src), schema, "ts", attrs, F.col("p"), F.col("y"), window="1 day",
                          watermark="1 hour", out_dir=str(tmp_path / "monitor"))
        rows = [(r["window_start"], r["n_rows"], round(r["dpd"], 6), round(r["eod"], 6)) for r in out.collect()]
        assert len(rows) == len({r[0] for r in rows})   # each window is emitted once
        return {r[0]: r[1:] for r in rows}

    # day 1 closes once the watermark (latest event - 1 hour) passes its end
    assert monitor() == {day(1): (4, 0.5, 0.5)}
    closed = spark.read.parquet(str(tmp_path / "monitor" / "windows")).first()
    # day 1: a has rate 0.5 and TPR 0.5, b has 0 and 0
    assert (closed["dpd_max_group"], closed["dpd_min_group"], closed["eod_max_group"],
            closed["eod_min_group"], closed["breaches"]) == ("a", "b", "a", "b", 2)
    _write_events(str(src), "f2.parquet", second)
    got = monitor()   # resumes from the stream's checkpoint
    on_time = spark.createDataFrame(first + second[1:], schema)
    twin = {r["window_start"]: (r["n_rows"], round(r["dpd"], 6), round(r["eod"], 6))
            for r in bias_by_window(on_time, "ts", attrs, F.col("p"), F.col("y")).collect()}
    # closed windows only (day 4 is still open); the late row did not reach day 1
    assert set(got) == {day(1), day(2), day(3)}
    assert got == {k: v for k, v in twin.items() if k in got}


def test_window_bias_ties_pick_smallest_group(spark):
    d = dt.datetime(2024, 1, 1, 3)
    rows = [(d, "b", 1, 1), (d, "a", 1, 1), (d, "c", 0, 1)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, g string, p int, y int")
    r = bias_by_window(df, "ts", [("g", F.col("g"))], F.col("p"), F.col("y")).first()
    # a and b tie at the top (rate 1, TPR 1): the smaller label is reported
    assert (r["n_groups"], r["dpd"], r["eod"], r["breaches"]) == (3, 1.0, 1.0, 2)
    assert (r["dpd_max_group"], r["dpd_min_group"], r["eod_max_group"], r["eod_min_group"]) == ("a", "c", "a", "c")
    one = bias_by_window(df.where(F.col("g") == "a"), "ts", [("g", F.col("g"))], F.col("p"), F.col("y")).first()
    assert (one["dpd"], one["dpd_max_group"], one["breaches"]) == (0.0, None, 0)
