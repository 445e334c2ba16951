"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .conversations import damage, repair_conversations
from .embeddings import near_vectors
from .exact_dedup import exact_groups
from .langid import identify
from .mixing import mix_sources
from .periodic import periodic_runs
from .pieces import encode
from .pii import KINDS, find_personal
from .quality import rate_quality
from .sharding import shard_by_bytes
from .simhash import near_groups
from .tokens import token_output
from .toxicity import rate_toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), shards=16).drop("global_slot", "first_byte")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"), shingle=4, distance=4)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans; ``spans`` has those that the tagger adds too."""
    found = find_personal(table(spark, sf_dir, "documents"))
    counts = [F.regexp_count("base", F.lit(f"{k}:")).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, "base_sha256", "spans", "n_added")


def op6_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("text_crc32")


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damage(table(spark, sf_dir, "conversations")))


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rate_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), plant=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sharding, op2_language_id, op3_toxicity, op4_simhash, op5_pii, op6_embeddings,
                            op7_sentencepiece, op8_mixing, op9_token_output, op10_exact_dedup,
                            op11_conversations, op12_quality, op13_periodic_runs)}
