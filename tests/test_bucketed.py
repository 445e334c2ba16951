"""Bucketed tables: the bucketed side moves no rows, and given keys open only their buckets."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from equitas.sources.bucketed import bucketed_table


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture
def merge_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows(spark, n=1000):
    return spark.range(n).select(F.format_string("E-%05d", "id").alias("entity_id"), (F.col("id") * 2).alias("v"))


def test_lookup_moves_only_the_keys(spark, merge_join):
    gold = bucketed_table(rows(spark), "entity_id", "gold")
    ids = spark.createDataFrame([("E-00003",), ("E-00003",), ("E-00990",), ("none",), (None,)], "wanted string")
    got = gold.lookup(ids)
    assert sorted(tuple(r) for r in got.collect()) == [("E-00003", 6), ("E-00990", 1980)]
    text = plan(gold.lookup(ids))
    # the only exchange is that of the distinct keys, which the join uses again
    assert text.count("Exchange (") == 1 and "SortMergeJoin LeftSemi" in text
    assert rows(spark).join(ids.distinct(), F.col("entity_id") == F.col("wanted"), "left_semi").count() == 2
    gold.close()


def test_given_keys_open_only_their_buckets(spark):
    gold = bucketed_table(rows(spark), "entity_id", "gold", buckets=16)
    found = gold.find(["E-00007", None, "other"])
    assert [tuple(r) for r in found.collect()] == [("E-00007", 14)]
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")    # so that the plan names them
    try:
        text = plan(gold.find(["E-00007", None, "other"]))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    selected = [line for line in text.splitlines() if line.startswith("SelectedBucketsCount")]
    assert selected and int(selected[0].split(":")[1].split()[0]) <= 2
    assert gold.find([]).count() == 0
    files = [f for f in os.listdir(gold.path) if f.endswith(".parquet")]
    assert len(files) == 16
    gold.close()
    assert not os.path.exists(gold.path) and not spark.catalog.tableExists(gold.name)


def test_stages_join_without_an_exchange(spark, merge_join):
    left = bucketed_table(rows(spark), "entity_id", "left")
    right = bucketed_table(rows(spark, 700).withColumnRenamed("v", "w"), "entity_id", "right")
    both = left.join(right)
    assert "Exchange" not in plan(both)
    assert both.agg(F.count("*"), F.sum(F.col("v") - F.col("w"))).first() == (700, 0)
    assert left.join(right, "left").where("w is null").count() == 300
    with pytest.raises(ValueError):
        left.join(bucketed_table(rows(spark), "v", "other"))
    left.close(), right.close()


def test_odd_tables(spark):
    """Null and empty keys, repeated rows, an empty table."""
    odd = spark.createDataFrame([(None, 1), ("a", 2), ("a", 2), ("", 3)], "k string, v int")
    t = bucketed_table(odd, "k", "odd")
    assert t.frame.count() == 4 and t.lookup(odd.select("k")).count() == 3 and t.find(["", None]).count() == 1
    t.close()
    empty = bucketed_table(odd.limit(0), "k", "empty")
    assert empty.frame.count() == 0 and empty.lookup(odd).count() == 0
    empty.close()
