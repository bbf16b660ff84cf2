"""The corpus pipeline: operators of ``titleweave.llm`` in sequence over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from titleweave.llm import decontamination, mixing, quality_rules, sharding, simhash
from titleweave.llm.common import stage
from titleweave.session import new_folder


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the learned decision list go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    table = stage(quality_rules.measured(docs).select("doc_id", "measures"), "measures")
    rules = quality_rules.learn_rules(quality_rules.labelled_rows(table, labels))
    return quality_rules.keep_good(docs, rules)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest id stays."""
    return simhash.keep_one(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight asks for."""
    return mixing.mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in sixteen shards of near-equal bytes, with size, shard and slot."""
    return sharding.shard_by_bytes(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("decontamination", drop_test_items),
    ("mixing", mix_sources),
    ("sharding", shard),
]

# Learned rules, XXH64 and pseudo-random rounding have no SQL form; tests hold run() against a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn, each written as Parquet and reread as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, build in STAGES:
        path = new_folder(spark, f"pipeline-{name}")
        build(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
