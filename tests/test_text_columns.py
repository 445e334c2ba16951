"""Quartiles and modes of text columns without moving their values, against plain counts."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from equitas.operators import audit, silver
from equitas.operators.audit import fairness_audit
from equitas.plans import text_ranks as tr

PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]


def plain(values, probs=PROBS):
    have = sorted((v for v in values if v is not None), key=str.encode)
    out = []
    for p in probs:
        at = p * (len(have) - 1)
        out.append((have[math.floor(at)], have[math.ceil(at)], pytest.approx(at - math.floor(at))))
    return out


@pytest.fixture(scope="module")
def texts(spark):
    hot = F.when(F.col("id") % 3 == 0, F.lit("m" * 70 + "hot"))
    return spark.range(6000).select(
        F.concat(F.lit("Customer#"), F.lpad((F.col("id") * 7919 % 6000).cast("string"), 9, "0")).alias("name"),
        F.when(F.col("id") % 11 > 0, hot.otherwise(F.concat(F.lit("m" * 70), F.col("id") % 997))).alias("long"),
        F.concat(F.chr(F.col("id") % 50 + 200), F.col("id") % 7).alias("accents"),
        F.lit(None).cast("string").alias("none"), (F.col("id") % 2).cast("int").alias("pred"),
        (F.col("id") % 5 == 0).cast("int").alias("y"))


@pytest.mark.parametrize("sample,inside", [(20_000, 200_000), (300, 200), (60, 20)])
def test_ranks_equal_a_plain_sort(texts, monkeypatch, sample, inside):
    monkeypatch.setattr(tr, "SAMPLE", sample)
    monkeypatch.setattr(tr, "INSIDE", inside)
    cols = ["name", "long", "accents", "none"]
    got = tr.text_ranks(texts, cols, PROBS)
    rows = texts.select(cols).collect()
    assert got.pop("none") is None
    for c, ranks in got.items():
        if ranks is not None:
            assert ranks == plain([r[c] for r in rows]), c
    assert sum(r is not None for r in got.values()) >= 2


def test_a_missed_bracket_is_reported(texts, monkeypatch):
    monkeypatch.setattr(tr, "INSIDE", 10)
    monkeypatch.setattr(tr, "SAMPLE", 200)
    monkeypatch.setattr(tr, "REACH", 0)
    got = tr.text_ranks(texts, ["name"], PROBS)["name"]
    assert got is None or got == plain([r["name"] for r in texts.select("name").collect()])


@pytest.mark.parametrize("miss", [False, True])
def test_audit_of_wide_text_equals_the_value_table(texts, monkeypatch, miss):
    want = sorted(map(str, fairness_audit(texts, [("name", "n"), ("long", "l"), ("accents", "a")], "pred", "y").report.collect()))
    monkeypatch.setattr(audit, "NARROW_VALUES", 100)
    if miss:
        monkeypatch.setattr(audit, "text_ranks", lambda df, cols, probs: {c: None for c in cols})
    got = fairness_audit(texts, [("name", "n"), ("long", "l"), ("accents", "a")], "pred", "y")
    assert {p.mode for p in got.plans} == {"ordinal_bins"}
    assert sorted(map(str, got.report.collect())) == want


def test_wide_text_is_not_grouped_by_value(texts, monkeypatch):
    """No value table is made of a wide text column; its rows are reduced to bins in the scan stage."""
    monkeypatch.setattr(audit, "NARROW_VALUES", 100)

    def refuse(*_):
        raise AssertionError("value table of a wide column")

    monkeypatch.setattr(audit, "value_table", refuse)
    assert fairness_audit(texts, [("name", "n")], "pred", "y").report.count() == 1


def plain_mode(values):
    count = Counter(v for v in values if v is not None)
    return min(count, key=lambda v: (-count[v], v.encode())) if count else None


def test_modes_equal_full_counts(spark, monkeypatch):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 9 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("nearly_unique"),
        F.col("id").cast("string").alias("unique"), (F.col("id") % 2).cast("string").alias("tie"),
        F.when(F.col("id") % 4 == 0, F.lit("x")).alias("gaps"), F.lit(None).cast("string").alias("none"),
        (F.col("id") % 3 == 0).alias("flag"), F.concat(F.lit("v"), F.col("id") % 300).alias("even"))
    rows = df.select([F.col(c).cast("string") for c in df.columns]).collect()
    asked = []
    full = silver._counted_modes
    monkeypatch.setattr(silver, "_counted_modes", lambda d, cols: asked.extend(cols) or full(d, cols))
    got = silver.column_modes(df, df.columns)
    assert got == {c: plain_mode([r[c] for r in rows]) for c in df.columns}
    assert set(asked) == {"unique", "even"}       # the others are proven from the summary
    assert silver.column_modes(df, []) == {}
    assert silver.column_modes(df.limit(0), ["tie"]) == {"tie": None}
