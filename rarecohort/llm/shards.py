"""Contiguous shards of near equal bytes, cut by global prefix sums."""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rarecohort.llm.texts import fresh
from rarecohort.sources.staging import stage


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of a text, and one for its end; null counts as empty."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def balanced_shards(docs: DataFrame, shards: int, order_by: list[str], size: Column) -> DataFrame:
    """Adds size, shard and slot: shard k holds the rows whose prefix of bytes lies in the k-th of ``shards`` equal parts.

    Rows are ranged by ``order_by`` (nulls first; ties in no fixed order), summed
    locally, and shifted by the totals of the partitions before.  Only one row a
    partition reaches the driver.  A shard differs from the target by less than
    one row at each cut, so a row of many bytes stays whole.  slot counts from
    0 inside a shard.  Repeated rows are rows of their own; an empty table gives
    an empty one; size, shard and slot replace columns of those names.
    """
    spark = docs.sparkSession
    slim = docs.withColumn("size", size).drop("shard", "slot")
    part_name, row_name, before_name, offset_name, shift_name = (fresh(slim.columns, f"__{n}") for n in ("part", "row", "before", "offset", "shift"))
    keys = [F.col(c).asc_nulls_first() for c in order_by]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = slim.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    schema = T.StructType([*slim.schema.fields, *[T.StructField(n, T.LongType()) for n in (part_name, row_name, before_name)]])
    arrow = to_arrow_schema(schema)

    def local_sums(batches):
        row = before = 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            sizes = np.asarray(batch.column(batch.schema.get_field_index("size")), np.int64)
            ends = before + np.cumsum(sizes)
            columns = [c.cast(arrow.field(i).type) for i, c in enumerate(batch.columns)]
            n = len(sizes)
            more = [np.full(n, part), row + np.arange(n), ends - sizes]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(m, pa.int64()) for m in more]], schema=arrow)
            row, before = row + n, int(ends[-1]) if n else before

    # Written once: the ranges come from a sample, and a second run could draw others.
    summed = stage(ranged.mapInArrow(local_sums, schema), "sharded")
    totals = summed.groupBy(part_name).agg(F.sum("size").alias("bytes")).orderBy(part_name).collect()
    whole = sum(t["bytes"] for t in totals)
    offsets = spark.createDataFrame(
        list(zip([t[part_name] for t in totals], accumulate([0, *[t["bytes"] for t in totals]]))),
        T.StructType([T.StructField(part_name, T.LongType()), T.StructField(offset_name, T.LongType())]),
    )
    prefix = F.col(offset_name) + F.col(before_name)
    # Exact: a product of bytes and shards may not fit in 64 bits.
    cut = F.floor(prefix.cast("decimal(38,0)") * shards / F.lit(max(whole, 1)).cast("decimal(20,0)")).cast("int")
    # One row a partition, as many as spark.sql.shuffle.partitions.
    placed = summed.join(F.broadcast(offsets), part_name).withColumn("shard", F.least(cut, F.lit(shards - 1)))
    # The first row of each shard and the rows of each partition are few too.
    pieces = placed.groupBy("shard", part_name).agg(F.count("*").alias("n"), F.min(row_name).alias("low"))
    counts = sorted((r["shard"], r[part_name], r["n"], r["low"]) for r in pieces.collect())
    base, out = 0, []
    for k, (shard, part, n, low) in enumerate(counts):
        base = 0 if not k or counts[k - 1][0] != shard else base
        out.append((shard, part, base - low))
        base += n
    shift = spark.createDataFrame(
        out,
        T.StructType([T.StructField("shard", T.IntegerType()), T.StructField(part_name, T.LongType()), T.StructField(shift_name, T.LongType())]),
    )
    slots = placed.join(F.broadcast(shift), ["shard", part_name]).withColumn("slot", F.col(row_name) + F.col(shift_name))
    return slots.select(*slim.columns, "shard", "slot")


def digest(docs: DataFrame, shards: int = 8) -> DataFrame:
    """The check columns: shards of documents by ascending doc_id."""
    rows = docs.select(
        "doc_id", text_bytes().alias("__size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    )
    placed = balanced_shards(rows, shards, ["doc_id", "text_crc32"], F.col("__size"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
