"""Result order, top lists, tallies and summaries of the result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarecohort.functions.annotation import consequence_terms
from rarecohort.functions.genomics import variant_label
from rarecohort.operators.ranks import global_rank

_IMPACTS = ["HIGH", "MODERATE", "LOW", "MODIFIER"]


def sorted_genes(genes: DataFrame) -> DataFrame:
    return genes.orderBy("CHROM", "POS", "SYMBOL")


def sorted_bins(bins: DataFrame) -> DataFrame:
    return bins.orderBy("CHROM", "bin_start", "SYMBOL")


def top_by(df: DataFrame, column: str, n: int, ties: list[str]) -> DataFrame:
    """The n rows with the largest value; ties go to the first in result order."""
    return df.orderBy(F.desc(column), *ties).limit(n)


def top_genes(genes: DataFrame, n: int = 10) -> DataFrame:
    return top_by(genes, "density", n, ["CHROM", "POS", "SYMBOL"])


def top_bins(bins: DataFrame, n: int = 10) -> DataFrame:
    return top_by(bins, "density", n, ["CHROM", "bin_start", "SYMBOL"])


def top_variants(variants: DataFrame, n: int = 15) -> DataFrame:
    top = top_by(variants, "frequency", n, ["CHROM", "POS", "REF", "ALT"])
    return top.withColumn("label", variant_label())


def impact_tally(df: DataFrame) -> DataFrame:
    """Rows per worst impact; all four labels appear, from one aggregate row."""
    counted = df.agg(*[F.count_if(F.col("worst_impact") == i).alias(i) for i in _IMPACTS])
    return counted.select(
        F.inline(F.array(*[F.struct(F.lit(i).alias("worst_impact"), F.col(i).alias("n")) for i in _IMPACTS]))
    )


def density_summary(df: DataFrame) -> DataFrame:
    """Rows, mean, exact median and maximum of the density of a result table.

    The median is read off ranks: many rows share a density, so rows of one are
    told apart by a hash of the row, which spreads them over the tasks.
    """
    ranked = global_rank(df.select("density", F.xxhash64(*df.columns).alias("tie")), [F.col("density").asc_nulls_last(), F.col("tie")])
    known = ranked.agg(F.count("density")).scalar()
    middle = F.col("rank").isin(F.floor((known - 1) / 2), F.floor(known / 2))
    return ranked.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("density").alias("mean_density"),
        F.avg(F.when(middle, F.col("density"))).alias("median_density"),
        F.max("density").alias("max_density"),
    )


def explode_consequence(df: DataFrame) -> DataFrame:
    """One row per consequence term; rows without a consequence go."""
    return df.withColumn("Consequence", F.explode(consequence_terms()))


def consequence_breakdown(variants: DataFrame, top: int = 18) -> DataFrame:
    """Loci per consequence term and impact, for the most frequent terms."""
    counts = [F.count_if(F.col("IMPACT") == i).alias(i) for i in _IMPACTS]
    return (
        explode_consequence(variants)
        .filter(F.col("IMPACT").isNotNull())
        .groupBy("Consequence")
        .agg(*counts, F.count(F.lit(1)).alias("total"))
        .orderBy(F.desc("total"), "Consequence")
        .limit(top)
        .select("Consequence", *_IMPACTS)
    )
