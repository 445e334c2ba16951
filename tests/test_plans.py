"""Distributed building blocks against brute force on small random inputs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from equitas.plans.prefix import row_index, running_totals
from equitas.plans.quantiles import exact_quantiles


def test_running_totals_match_cumsum(spark):
    rnd = random.Random(3)
    rows = [(k, i, rnd.randint(0, 9)) for k in ("a", "b", "c") for i in range(rnd.randint(1, 60))]
    # a hot key: a third of all rows
    rows += [("hot", 1000 + i, 1) for i in range(len(rows) // 2)]
    df = spark.createDataFrame(rows, "k string, v long, w long")
    for parts in (5, None):   # 5: the distributed path; None: the size-checked window path
        got = {(r["k"], r["v"]): (r["cum_w"], r["tot_w"])
               for r in running_totals(df, ["k"], ["v"], ["w"], num_partitions=parts,
                                       with_key_totals=True).collect()}
        _check_cumsum(rows, got)


def _check_cumsum(rows, got):
    for k in {r[0] for r in rows}:
        part = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        acc, tot = 0, sum(r[2] for r in part)
        for _, v, w in part:
            acc += w
            assert got[(k, v)] == (acc, tot)


def test_row_index_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("key"))
    out = row_index(df, ["key"]).collect()
    assert sorted((r["key"], r["row_idx"]) for r in out) == [(i, i) for i in range(1000)]


@pytest.mark.parametrize("hint", [None, 150_000, 10 ** 9])
def test_exact_quantiles_match_numpy(spark, hint):
    rnd = np.random.default_rng(7)
    vals = {"x": rnd.normal(size=301).round(2), "y": rnd.integers(0, 5, size=40).astype(float),
            "z": np.array([5.0, 5.0, 5.0])}
    rows = [(k, float(v)) for k, arr in vals.items() for v in arr]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    # None: Spark's percentile after a HyperLogLog check; 150k: prefix sums by
    # one window per key, sized by the hint; 10**9: prefix sums after a size job
    q = exact_quantiles(df, ["k"], "v", probs, distinct_hint=hint)
    got = {(r["k"], r["q_idx"]): r["value"] for r in q.collect()}
    for k, arr in vals.items():
        want = np.quantile(arr, probs)
        for i, w in enumerate(want):
            assert abs(got[(k, i)] - w) < 1e-9


def test_ordinal_quantile_codes(spark):
    df = spark.createDataFrame([(c,) for c in "aabbbccdde"], "v string")
    q = exact_quantiles(df, [], "v", [0.0, 0.5, 1.0], with_codes=True).orderBy("q_idx").collect()
    codes = [0, 0, 1, 1, 1, 2, 2, 3, 3, 4]
    assert [r["code"] for r in q] == list(np.quantile(codes, [0.0, 0.5, 1.0]))
