"""A corpus from documents to balanced shards, in five stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rarecohort.llm import leaks, mixing, neardup, quality, shards
from rarecohort.llm.texts import fresh
from rarecohort.sources.staging import shared_folder

#: Weights of the mix: all tokens of its input are spread anew, a document at most twice.
MIX_WEIGHTS = {
    "domain": {"web": 0.3, "books": 0.25, "forums": 0.25, "reference": 0.2},
    "lang": {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
}
MIX_FRACTION, MIX_EPOCHS, SHARDS = 1.0, 2, 8


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier fitted on the given labels accepts.

    Null and empty texts are scored as texts without words; repeated rows and ids alike, one by one.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accept(docs, quality.fit(docs, labels))


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the smallest doc_id.

    Documents without words and rows without doc_id are in no group and stay; rows that repeat a kept id stay too.
    """
    return neardup.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item; null and empty texts have none and stay."""
    return leaks.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), drop=True)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target weights, each as often as there are epochs that hold it.

    Rows of a language or source off the tree are weighed as the operator does; repeated rows are rows of their own.
    """
    rows = docs.select(F.struct("*").alias("doc"), "doc_id", "text", "lang", "source", mixing.domain_of().alias("domain"))
    taken = mixing.mix(rows, mixing.TREE, MIX_WEIGHTS, MIX_FRACTION, MIX_EPOCHS)
    return taken.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("doc.*")


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with size, shard and slot.

    A null text has size 1; repeated rows stay; columns named as the results are replaced.
    """
    order = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    rows = docs.drop("shard", "slot", "size")
    crc = fresh(rows.columns, "crc")
    return shards.balanced_shards(rows.withColumn(crc, order), SHARDS, ["doc_id", crc], shards.text_bytes()).drop(crc)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", no_near_duplicates),
    ("decontamination", no_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: A classifier and hashed signatures are beyond SQL; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_folder(spark).rstrip('/')}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
