import os
import sys

import pytest

SF = "/root/testdata/sf0.001"


sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from conftest_llm import ODD, ODD_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F
    rows = spark.createDataFrame(ODD, ODD_SCHEMA)
    clash = ["size", "shard", "index", "run", "digest", "bits", "component", "position", "target", "score",
             "id", "ids", "key", "row", "_row", "_range", "_id", "_copy", "_text_key", "_language", "held_out"]
    return rows.select("*", *(F.lit("x").alias(c) for c in clash))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
