"""Sample values against brute force, whatever part of the rows gives the bound."""

import random

import pytest

from equitas.operators import profile


@pytest.mark.parametrize("share", [0.0, 0.05, 1.0])
def test_sample_values_are_the_smallest(spark, monkeypatch, share):
    monkeypatch.setattr(profile, "SAMPLE_SHARE", share)
    rnd = random.Random(4)
    rows = [(rnd.randint(-300, 300), rnd.choice([None, rnd.random() - 0.5]), rnd.choice(["b", "a", "", "ä", "z"]),
             None, f"{rnd.randint(0, 10 ** 6):07d}", rnd.choice([True, False, None])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "i int, d double, few string, none string, many string, flag boolean")
    got = {r["column"]: r["sample_values"] for r in profile.sample_values(df.repartition(6), df.columns).collect()}
    assert got["i"] == [str(v) for v in sorted({r[0] for r in rows})[:5]]
    assert [float(v) for v in got["d"]] == sorted({r[1] for r in rows if r[1] is not None})[:5]
    assert got["few"] == ["", "a", "b", "z", "ä"]
    assert "none" not in got
    assert got["many"] == sorted({r[4] for r in rows})[:5]
    assert got["flag"] == ["false", "true"]


def test_sample_values_of_an_empty_table(spark):
    assert profile.sample_values(spark.createDataFrame([], "a int, b string"), ["a", "b"]).count() == 0
