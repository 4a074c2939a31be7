"""Tables that genome-wide plots are drawn from.

Inputs are result tables (genes, bins, variants), never raw calls.  What gets
broadcast is per contig of the fixed chromosome list: at most 25 rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rarecohort.functions.genomics import contig_label, log_density
from rarecohort.model import CHROMOSOME_GAP, chromosome_order, is_standard_contig
from rarecohort.operators.ranks import global_rank
from rarecohort.sources.staging import stage

# --- fixed values: plot layout ---------------------------------------------------
GENE_GAP_DIVISOR, BIN_GAP_DIVISOR, SMALLEST_GAP = 40, 80, 4
GENE_BUBBLE, BIN_BUBBLE, VARIANT_BUBBLE = (40, 180), (30, 160), (15, 120)
VARIANT_BUBBLE_POWER = 1.2


def chrom_extent(df: DataFrame, column: str = "gene_end") -> DataFrame:
    """Smallest and largest value of a column per contig."""
    return df.groupBy("CHROM").agg(F.min(column).alias("low"), F.max(column).alias("high"))


def chrom_offsets(genes: DataFrame, gap: int = CHROMOSOME_GAP) -> DataFrame:
    """Start of each occupied chromosome on one axis, in cytogenetic order."""
    before = Window.orderBy(chromosome_order()).rowsBetween(Window.unboundedPreceding, -1)
    return (
        genes.filter(is_standard_contig())
        .groupBy("CHROM")
        .agg(F.max("gene_end").alias("high"))
        .select(
            "CHROM",
            F.coalesce(F.sum(F.col("high") + gap).over(before), F.lit(0).cast("bigint")).alias("offset"),
        )
    )


def with_cum_pos(df: DataFrame, offsets: DataFrame) -> DataFrame:
    """Adds cum_pos = chromosome offset + POS; contigs off the list start at 0."""
    return (
        df.join(F.broadcast(offsets), "CHROM", "left")
        .withColumn("cum_pos", F.coalesce(F.col("offset"), F.lit(0).cast("bigint")) + F.col("POS"))
        .drop("offset")
    )


def rank_layout(df: DataFrame, position: str, divisor: int, ties: list[str]) -> DataFrame:
    """Integer slot ``rank_x`` per row: chromosome order, then position.

    Chromosomes are ``max(4, n // divisor)`` slots apart, n being all rows of
    the table.  Rows on other contigs have no slot.  Rows are ranked over the
    whole table, so that no task holds a chromosome.
    """
    other_last = F.when(chromosome_order() > 0, chromosome_order())
    place = [other_last.asc_nulls_last(), F.col(position), *map(F.col, ties)]
    ranked = global_rank(df, place, "__rank")
    rows = F.count(F.lit(1))
    gap = ranked.agg(F.greatest(F.lit(SMALLEST_GAP).cast("bigint"), F.floor(rows / divisor))).scalar()
    standard = ranked.filter(is_standard_contig())
    in_order = Window.orderBy(chromosome_order())  # at most 25 rows
    gaps = standard.select("CHROM").distinct().select("CHROM", (F.row_number().over(in_order) - 1).alias("gaps"))
    return (
        standard.join(F.broadcast(gaps), "CHROM")
        .withColumn("rank_x", F.col("__rank") + F.col("gaps") * gap)
        .withColumn("log_density", log_density())
        .drop("gaps", "__rank")
    )


def gene_rank_layout(genes: DataFrame) -> DataFrame:
    return rank_layout(genes, "POS", GENE_GAP_DIVISOR, ["SYMBOL"])


def bin_rank_layout(bins: DataFrame) -> DataFrame:
    return rank_layout(bins, "bin_start", BIN_GAP_DIVISOR, ["SYMBOL", "bin_index"])


def chrom_bands(layout: DataFrame, column: str = "rank_x") -> DataFrame:
    """First and last value, midpoint and label per chromosome of a layout."""
    return (
        layout.filter(is_standard_contig())
        .groupBy("CHROM")
        .agg(F.min(column).alias("low"), F.max(column).alias("high"))
        .select(
            "CHROM",
            contig_label().alias("label"),
            "low",
            "high",
            ((F.col("low") + F.col("high")).cast("double") / F.lit(2.0)).alias("middle"),
        )
    )


def bubble_size(df: DataFrame, column: str, base: float, scale: float, power: float | None = None) -> DataFrame:
    """Adds bubble_size = base + (value / largest value)^power * scale; stages the table, which is read twice."""
    df = stage(df, "sized")
    top = F.greatest(df.agg(F.max(column)).scalar(), F.lit(1e-15))
    share = F.col(column) / top
    return df.withColumn(
        "bubble_size",
        F.lit(float(base)) + (share if power is None else F.pow(share, F.lit(power))) * F.lit(float(scale)),
    )


def bubble_genes(genes: DataFrame) -> DataFrame:
    return bubble_size(genes, "density", *GENE_BUBBLE)


def bubble_bins(bins: DataFrame) -> DataFrame:
    return bubble_size(bins, "density", *BIN_BUBBLE)


def bubble_variants(variants: DataFrame) -> DataFrame:
    return bubble_size(variants, "frequency", *VARIANT_BUBBLE, power=VARIANT_BUBBLE_POWER)


def _levels(extent: DataFrame, n: int) -> DataFrame:
    step = (F.col("high") - F.col("low")) / F.lit(float(n))
    return extent.select("low", "high", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("level_no")).select(
        "level_no", (F.col("low") + step * F.col("level_no").cast("double")).alias("level")
    )


def density_levels(df: DataFrame, n: int = 5) -> DataFrame:
    """n even levels above the minimum up to the maximum of log10 density."""
    return _levels(df.agg(F.min(log_density()).alias("low"), F.max(log_density()).alias("high")), n)


def frequency_levels(variants: DataFrame, n: int = 5) -> DataFrame:
    """n even levels from above 0 up to the highest frequency."""
    return _levels(variants.agg(F.lit(0.0).alias("low"), F.max("frequency").alias("high")), n)
