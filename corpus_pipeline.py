"""From documents to shards: quality rules, near duplicates, benchmark leaks, mixing, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veerline.llm import decontaminate, mixing, ngram_join, quality_rules, sharding
from veerline.llm.common import read, store


def drop_bad(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go; nulls and empty texts among them, repeated rows alike."""
    return quality_rules.keep_good(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the first stored; rows without words are copies of each other."""
    return ngram_join.keep_first(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none, repeated rows go alike."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come near their target weights; documents stay whole, null sources are one source."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with ``shard`` and ``slot``; null texts and repeated rows have places of their own."""
    return sharding.shard(docs).select("row.*", "shard", "slot")


STAGES = [
    ("quality rules", drop_bad),
    ("n-gram Jaccard join", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

#: Min-hashing, connected components and sampled splitters have no SQL twin.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
