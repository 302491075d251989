"""A training corpus from raw documents, in five stages.

Language, near-duplicates, benchmark passages, the mix of sources, shards. Each stage works on
all that the one before it kept, and is written before the next one reads it.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from spanwatch.llm import contamination, language, mixing, sharding, simhash
from spanwatch.llm.common import fold, stored, table

# Below this no language stands out: with four languages, chance alone gives a quarter.
LEAST_SCORE = 0.3

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, and those in no language that the network knows, go."""
    net = language.fit(docs.filter(fold("doc_id", 5) != 0))
    named = language.predict(docs.select(F.struct("*").alias("doc")), net, "doc.text")
    clear = (F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return named.filter(clear).select("doc.*")


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays, that with the least id."""
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return contamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated so that every source has its share of words."""
    return mixing.mixed(docs)


def in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets a shard and a place in it; shards hold near equal bytes."""
    return sharding.sharded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("near_duplicates", one_of_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("sharding", in_shards),
]

# Fingerprints, the network and the cube method are beyond SQL; see tests/llm.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
