"""The corpus pipeline: five stages from ``documents`` to sampled piece ids.

Each stage is written as Parquet and read again as the next one's documents;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from equitas.llm.exact_dedup import drop_copies
from equitas.llm.handover import handover
from equitas.llm.langid import keep_identified
from equitas.llm.mixing import mixed_documents
from equitas.llm.pieces import encode
from equitas.llm.simhash import drop_near_copies

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which one learned language makes up at least half, by the mixture inferred from the text."""
    return keep_identified(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, up to white space, the document of the smallest id."""
    return drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group whose SimHash fingerprints link, the document of the smallest id."""
    return drop_near_copies(docs, shingle=4, distance=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    return mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled piece ids of every row."""
    return encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix),
    ("pieces", pieces)]

#: SQL cannot express the learned, hashed and sampled stages; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each handed over as Parquet in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = handover(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
