"""The operators' registered queries over the driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import (
    decontaminate,
    licenses,
    lm,
    mixing,
    nearest,
    neardup,
    quality,
    resample,
    runindex,
    sharding,
    urls,
    warc,
    whitening,
)
from tallyforge.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"))


def op2_longest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(_table(spark, sf_dir, "documents"))


def op3_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_report(_table(spark, sf_dir, "documents"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_report(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"))


def op5_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(_table(spark, sf_dir, "pages"))


def op7_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_report(_table(spark, sf_dir, "documents"))


def op8_winnowed_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(_table(spark, sf_dir, "documents"))


def op9_run_length_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runindex.repeat_report(_table(spark, sf_dir, "documents"))


def op10_low_discrepancy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampling_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_kmeans_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest_report(_table(spark, sf_dir, "embeddings"))


def op13_spectral_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_quality_cascade": op1_quality_cascade,
    "op2_longest_first": op2_longest_first,
    "op3_hyperminhash": op3_hyperminhash,
    "op4_url_rules": op4_url_rules,
    "op5_wu_manber": op5_wu_manber,
    "op6_capture_index": op6_capture_index,
    "op7_context_mixing": op7_context_mixing,
    "op8_winnowed_licenses": op8_winnowed_licenses,
    "op9_run_length_index": op9_run_length_index,
    "op10_low_discrepancy_mix": op10_low_discrepancy_mix,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_kmeans_tree_neighbours": op12_kmeans_tree_neighbours,
    "op13_spectral_whitening": op13_spectral_whitening,
}
