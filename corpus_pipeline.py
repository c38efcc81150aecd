"""Documents to training shards: rules, near-dedup, decontamination, mixing, sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import decontaminate, mixing, neardup, quality, sharding
from tallyforge.sources.storage import delete_tree, owned_scratch, scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: five-word shingles, similarity 0.8 or more."""
    return neardup.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words is benchmark text."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources uses them."""
    return mixing.mixed_documents(docs)


def sharding_by_size(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    return sharding.sharded_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("source mixing", source_mixing),
    ("sharding", sharding_by_size),
]
#: The schedules of mixing and sharding are not expressible in SQL; tests use brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every stage is written out before the next one reads it.

    A stage's scratch goes when its documents are written, and those when the next stage's are.
    """
    docs, former = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        path = scratch_dir(spark)
        with owned_scratch(spark):
            kept = stage(spark, docs, sf_dir)
            kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if former:
            delete_tree(spark, former)
        former = path
    return STAGES[-1][1](spark, docs, sf_dir)
