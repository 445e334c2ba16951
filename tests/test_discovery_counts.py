"""Likely identifiers are told without moving the values of columns that are clearly unique."""

import pytest
from pyspark.sql import functions as F

from equitas.operators import discovery


@pytest.mark.parametrize("share", [0.5, 0.94, 0.9499, 0.95, 0.9501, 0.96, 1.0])
def test_flags_are_those_of_exact_counts(spark, share):
    n = 40_000
    df = spark.range(n).select(F.when(F.col("id") < int(share * n), F.col("id")).otherwise(0).alias("v"),
                               (F.col("id") % 15).alias("low"), (F.col("id") % 16).alias("high"),
                               F.lit(None).cast("string").alias("none"))
    got = discovery._distinct({"t": df}, [("t", c) for c in df.columns], False)
    exact = df.select("v").distinct().count()
    assert (got["t", "v"][1] / n > 0.95) == (exact / n > 0.95)
    assert got["t", "low"][1] == 15 and got["t", "high"][1] == 16 and got["t", "none"][1] == 0


def test_unique_columns_are_not_counted_exactly(spark, monkeypatch):
    asked = []
    plain = discovery.count_values

    def watch(tables, columns, distinct):
        if distinct is F.count_distinct:
            asked.extend(c for _, c in columns)
        return plain(tables, columns, distinct)

    monkeypatch.setattr(discovery, "count_values", watch)
    df = spark.range(40_000).select("id", F.col("id").cast("string").alias("txt"), F.array("id").alias("list"))
    got = discovery._distinct({"t": df}, [("t", c) for c in df.columns], False)
    assert asked == []
    assert all(abs(d / 40_000 - 1) < 0.04 for _, d in got.values())


def test_columns_share_a_fixed_number_of_counting_jobs(spark, monkeypatch):
    """Tables without an identifier: all their columns are sketched together, whatever their number."""
    calls = []
    plain = discovery.count_values
    monkeypatch.setattr(discovery, "count_values", lambda t, c, d: calls.append(len(c)) or plain(t, c, d))
    width = 24
    tables = {f"t{k}": spark.range(400).select(*[(F.col("id") % (i + 20)).alias(f"zq{i}") for i in range(width)],
                                               (F.col("id") * 3 + k).alias("zlast")) for k in range(3)}
    got = discovery.column_catalog(tables).collect()
    assert len([c for c in calls if c]) <= 6
    likely = {(r["table"], r["column"]) for r in got if r["is_likely_id"]}
    assert likely <= {(f"t{k}", "zlast") for k in range(3)}


def test_flags_stop_at_the_first_likely_column(spark):
    df = spark.range(300).selectExpr("id % 7 zza", "id + 1 zzb", "id % 9 zzc")
    got = {r["column"]: (r["is_likely_id"], r["is_low_cardinality"]) for r in discovery.column_catalog({"t": df}).collect()}
    if got["zzb"][0]:
        assert got["zza"] == (False, True) and got["zzc"] in ((None, None), (False, True))
