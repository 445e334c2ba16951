"""Sinks that appear together or not at all."""

import pytest
from pyspark.sql import functions as F

from equitas.sources.ingest import metrics_rows
from equitas.sources.versions import Versions, read_metrics, replace_metrics


def writer(df):
    return lambda path: df.write.parquet(path)


def test_a_broken_write_leaves_the_old_version(spark, tmp_path):
    sink = Versions(spark, str(tmp_path / "out"))
    assert sink.current() is None
    with pytest.raises(FileNotFoundError):
        sink.folder("a")
    sink.commit("r1", {"a": writer(spark.range(3)), "b": writer(spark.range(4))})

    def broken(path):
        spark.range(9).write.parquet(path)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        sink.commit("r2", {"a": writer(spark.range(30)), "b": broken})
    assert sink.current()["run_id"] == "r1"
    assert (spark.read.parquet(sink.folder("a")).count(), spark.read.parquet(sink.folder("b")).count()) == (3, 4)
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 1


def test_newest_manifest_wins_and_torn_ones_do_not(spark, tmp_path):
    sink = Versions(spark, str(tmp_path / "out"))
    for n in (1, 2, 3):
        sink.commit(f"r{n}", {"a": writer(spark.range(n))})
    assert spark.read.parquet(sink.folder("a")).count() == 3
    assert len(list((tmp_path / "out" / "versions").iterdir())) == 2          # older ones are gone
    (tmp_path / "out" / "_manifests" / "0000000009.json").write_text('{"run_id": "r9", "fol')
    assert sink.current()["run_id"] == "r3"
    sink.commit("r4", {"a": writer(spark.range(40))})
    assert spark.read.parquet(sink.folder("a")).count() == 40


def test_one_run_has_one_set_of_metrics(spark, tmp_path):
    path = str(tmp_path / "metrics")
    replace_metrics(metrics_rows(spark, "r1", "model", {"auc": 0.5, "old": 1.0}), path)
    replace_metrics(metrics_rows(spark, "r1", "gold", {"n": 3.0}), path)
    replace_metrics(metrics_rows(spark, "r2", "model", {"auc": 0.7}), path)
    replace_metrics(metrics_rows(spark, "r1", "model", {"auc": 0.6}), path)
    got = {(r["run_id"], r["stage"], r["key"]): r["value"] for r in read_metrics(spark, path).collect()}
    assert got == {("r1", "model", "auc"): 0.6, ("r1", "gold", "n"): 3.0, ("r2", "model", "auc"): 0.7}
    assert read_metrics(spark, path).where(F.col("run_id") == "r1").count() == 2
