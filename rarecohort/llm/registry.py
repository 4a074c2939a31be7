"""One query per operator over the given tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from rarecohort.llm import align, fingerprints, infill, leaks, lm, mixing, neardup, packing, pii, quality, rules, shards, urls
from rarecohort.llm.sql import ORACLES  # noqa: F401


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return leaks.digest(leaks.find_leaks(docs, _read(spark, sf_dir, "benchmark"), keep=["doc_id"]))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.digest(_read(spark, sf_dir, "pages"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.digest(_read(spark, sf_dir, "documents"))


def op5_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.digest(_read(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(_read(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.digest(_read(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find_pii(_read(spark, sf_dir, "documents").select("doc_id", "text")))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"), size=4)


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.digest(_read(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.digest(_read(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest(_read(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_packing,
        op3_url_filter,
        op4_fingerprints,
        op5_pseudo_likelihood,
        op6_mixing,
        op7_quality,
        op8_sharding,
        op9_pii,
        op10_near_duplicates,
        op11_quality_rules,
        op12_alignment,
        op13_fill_in_middle,
    )
} | {"pipeline": corpus_pipeline.run}
if corpus_pipeline.ORACLE_SQL:
    ORACLES = ORACLES | {"pipeline": corpus_pipeline.ORACLE_SQL}
