"""Sources and sinks: ingest dispatch, validation, preview, writers, metrics log."""

import os
import tempfile

from pyspark.sql import functions as F

from equitas.sources.ingest import (audit_metrics, cached_dataset, ingest, log_metrics, metrics_rows, preview, validate,
                                    write_gold, write_importance, write_silver)


def _tmp():
    return tempfile.mkdtemp(prefix="equitas-test-")


def test_ingest_csv_parquet_dataframe_and_table(spark):
    d = _tmp()
    csv = os.path.join(d, "t.csv")
    with open(csv, "w") as f:
        f.write("id,age,gender\n1,30,F\n2,40,M\n")
    df = ingest(spark, csv)
    assert dict(df.dtypes) == {"id": "int", "age": "int", "gender": "string"}
    pq = os.path.join(d, "t.parquet")
    df.write.parquet(pq)
    assert ingest(spark, path=pq).count() == 2
    assert ingest(spark, df) is df
    df.createOrReplaceTempView("people")
    assert ingest(spark, "people").count() == 2


def test_validate_reports_but_does_not_block(spark):
    df = spark.createDataFrame([(1, None), (2, "a")], "id int, s string")
    v = validate(df).first()
    assert v["total_rows"] == 2 and v["total_nulls"] == 1 and v["has_nulls"] and not v["valid"]
    assert v["issues"] == ["Dataset too small: 2 rows (minimum 50 expected)",
                           "Too few columns: 2 (minimum 3 expected)"]
    assert v["null_counts"] == {"id": 0, "s": 1}


def test_preview(spark):
    dtypes, rows = preview(spark.range(100))
    assert dtypes == [("id", "bigint")] and rows.count() == 5


def test_sinks_round_trip(spark):
    d = _tmp()
    gold = spark.createDataFrame(
        [("1", 0.5, ["a", "b"], "txt", "Medium", False)],
        "entity_id string, risk_score double, top_factors array<string>, reason_text string, "
        "intervention_tier string, bias_flag boolean")
    write_gold(gold, d)
    assert spark.read.parquet(f"{d}/parquet").first()["top_factors"] == ["a", "b"]
    assert spark.read.option("header", True).csv(f"{d}/csv").first()["top_factors"] == "['a', 'b']"
    assert spark.read.json(f"{d}/json").count() == 1
    write_silver(spark.createDataFrame([(1, "F")], "x int, g string"), ["g"], f"{d}/silver")
    assert spark.read.parquet(f"{d}/silver/sensitive_attributes").columns == ["g"]
    imp = spark.createDataFrame([(f"f{i}", float(i)) for i in range(30)], "feature string, importance double")
    write_importance(imp, f"{d}/imp")
    assert spark.read.json(f"{d}/imp").count() == 20


def test_metrics_log_appends(spark):
    d = _tmp()
    log_metrics(metrics_rows(spark, "r1", "model", {"auc": 0.9}), d)
    report = spark.createDataFrame([("g", 0.1, 0.0, True)], "attribute string, dpd double, eod double, any_breach boolean")
    log_metrics(audit_metrics(report, "r1"), d)
    got = spark.read.parquet(d)
    assert got.count() == 4 and got.where(F.col("key") == "dpd_g").first()["value"] == 0.1


def test_cached_dataset_reads_through(spark):
    d = _tmp()
    src = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    first = cached_dataset(spark, "people", f"{d}/cache", source=src)
    assert sorted(r["id"] for r in first.collect()) == [1, 2]
    # later reads use the cached copy, with or without a source
    assert cached_dataset(spark, "people", f"{d}/cache").count() == 2
    fresh = spark.createDataFrame([(3, "c")], "id int, s string")
    assert cached_dataset(spark, "people", f"{d}/cache", source=fresh).count() == 2
    assert cached_dataset(spark, "people", f"{d}/cache", source=fresh, refresh=True).count() == 1
    try:
        cached_dataset(spark, "nobody", f"{d}/cache")
        raise AssertionError("expected a missing dataset to fail")
    except FileNotFoundError:
        pass
