"""Bracketed quantiles and the audit of many-valued attributes against the plain paths and numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from equitas.operators import audit
from equitas.plans import brackets, prefix
from equitas.plans.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


def _rows():
    rnd = np.random.default_rng(5)
    rows = [("x", float(v)) for v in rnd.normal(size=4000)]
    rows += [("hot", 1.5)] * 3000 + [("hot", float(v)) for v in range(200)]
    rows += [(None, float(v)) for v in rnd.integers(0, 50, 2500)]
    rows += [("few", 3.0), ("few", 4.0), ("few", None)]
    return rows


def _want(rows):
    out = {}
    for key in {k for k, _ in rows}:
        values = [v for k, v in rows if k == key and v is not None]
        for i, p in enumerate(PROBS):
            out[key, i] = float(np.quantile(values, p))
    return out


@pytest.mark.parametrize("accuracy", [100, 1000])
def test_bracketed_quantiles_are_exact(spark, monkeypatch, accuracy):
    monkeypatch.setattr(prefix, "WINDOW_MAX_ROWS", 10)
    monkeypatch.setattr(brackets, "ACCURACY", accuracy)
    rows = _rows()
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {(r["k"], r["q_idx"]): r["value"] for r in exact_quantiles(df, ["k"], "v", PROBS).collect()}
    want = _want(rows)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-12) for k in want)


def test_brackets_keep_few_values_and_count_the_rest(spark, monkeypatch):
    monkeypatch.setattr(brackets, "ACCURACY", 1000)
    df = spark.range(0, 20_000).select((F.col("id") * 7919 % 20_000).cast("double").alias("v"))
    sketch = brackets.key_sizes(df, [], "v", [0.25, 0.5])
    counted = brackets.inside_counts(df, [], "v", [0.25, 0.5], brackets.bracket(sketch, [0.25, 0.5]))
    assert counted.agg(F.sum("_c")).first()[0] == 20_000
    assert 2 < counted.count() < 400


def test_a_missed_bracket_falls_back_to_all_values(spark, monkeypatch):
    df = spark.range(0, 5000).select(F.col("id").cast("double").alias("v"))
    assert brackets.inside_counts(df, [], "v", [0.5], {(): [(10.0, 20.0)]}) is None
    monkeypatch.setattr(prefix, "WINDOW_MAX_ROWS", 10)
    monkeypatch.setattr("equitas.plans.quantiles.bracket", lambda sketch, probs: {(): [(10.0, 20.0)]})
    assert [r["value"] for r in exact_quantiles(df, [], "v", [0.5]).collect()] == [2499.5]


def test_nan_and_ties_and_whole_numbers(spark, monkeypatch):
    monkeypatch.setattr(prefix, "WINDOW_MAX_ROWS", 1)
    monkeypatch.setattr(brackets, "ACCURACY", 10)
    values = [2 ** 60 + i for i in range(40)] + [0, 0, 0, -5]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    got = [r["value"] for r in exact_quantiles(df, [], "v", [0.0, 0.5, 1.0]).orderBy("q_idx").collect()]
    assert got == [-5.0, float(2 ** 60), float(2 ** 60 + 39)]
    bad = spark.createDataFrame([(float(i),) for i in range(50)] + [(float("nan"),)] * 3, "v double")
    got = [r["value"] for r in exact_quantiles(bad, [], "v", [0.0, 0.5]).orderBy("q_idx").collect()]
    assert got == [0.0, 26.0]      # NaN stands last


def test_too_many_keys_take_the_plain_path(spark, monkeypatch):
    monkeypatch.setattr(prefix, "WINDOW_MAX_ROWS", 1)
    monkeypatch.setattr(brackets, "MAX_KEYS", 3)
    df = spark.createDataFrame([(k, float(v)) for k in range(5) for v in range(9)], "k int, v double")
    assert {r["k"]: r["value"] for r in exact_quantiles(df, ["k"], "v", [0.5]).collect()} == dict.fromkeys(range(5), 4.0)


def test_audit_of_wide_attributes_equals_the_value_table(spark, monkeypatch):
    rnd = np.random.default_rng(9)
    rows = [(float(a) if i % 11 else None, int(b), "ab"[i % 2], bool(i % 3 == 0), int(p), int(y)) for i, (a, b, p, y) in
            enumerate(zip(rnd.normal(size=900), rnd.integers(0, 40, 900), rnd.integers(0, 2, 900),
                          rnd.integers(0, 2, 900)))]
    df = spark.createDataFrame(rows, "f double, i int, t string, b boolean, pred int, y int").repartition(4)
    columns = ["f", "i", "t", "b"]

    def told():
        result = audit.fairness_audit(df, columns, "pred", "y")
        return (sorted(map(str, result.groups.collect())), sorted(map(str, result.report.collect())),
                sorted(map(str, result.entity_flags(df, "group").collect())))

    plain = told()
    monkeypatch.setattr(audit, "NARROW_VALUES", 20)
    assert audit.wide_attributes(df, columns) == ["f", "i"]
    assert told() == plain
    monkeypatch.setattr(prefix, "WINDOW_MAX_ROWS", 10)
    monkeypatch.setattr(brackets, "ACCURACY", 100)
    assert told() == plain
    only = audit.fairness_audit(df, ["f"], "pred", "y")
    assert only.report.count() == 1
