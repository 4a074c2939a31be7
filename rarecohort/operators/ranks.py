"""Ranks over a whole table without one task that sees it all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rarecohort.sources.staging import stage

_ID, _PART = "__id", "__part"
#: monotonically_increasing_id has the row of a partition in its lower bits.
_ROW_BITS = 33


def global_rank(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Adds 0, 1, .. in the given order, which should tell all rows apart.

    Rows are ranged and numbered inside their partitions, and the numbers
    shifted by the sizes of the partitions before.  Rows that tie in the whole order share a
    partition and are numbered in no fixed order.  The table is computed once and staged, since
    ranges are drawn from a sample.
    """
    numbered = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(_ID, F.monotonically_increasing_id())
    staged = stage(numbered, "ranked").withColumn(_PART, F.shiftright(_ID, _ROW_BITS))
    row = F.col(_ID) - F.shiftleft(_PART, _ROW_BITS)
    # One row a partition, in the window and in the broadcast.
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = staged.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"))
    shift = sizes.select(_PART, F.coalesce(F.sum("n").over(before), F.lit(0).cast("bigint")).alias("__before"))
    return staged.join(F.broadcast(shift), _PART).withColumn(name, F.col("__before") + row).drop(_ID, _PART, "__before")


def segment_rank(df: DataFrame, segment: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    """Adds 0, 1, .. inside each segment in the given order; a segment of any size is spread over the ranges.

    Segments lie side by side in the order of the whole table, so a row's number is its rank
    less the first of its segment; one row per segment is joined for that.  No segment may be null.
    """
    ranked = global_rank(df, [*map(F.col, segment), *order], name)
    first = ranked.groupBy(*segment).agg(F.min(name).alias("__first"))
    return ranked.join(first, segment).withColumn(name, F.col(name) - F.col("__first")).drop("__first")
