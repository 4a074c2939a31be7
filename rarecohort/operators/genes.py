"""Transcript dedup, patient and gene statistics, variant table, gene burden.

Row counts shrink in this order: transcript rows, observations (one per
patient, locus and gene), variants (one per patient and locus), genes.  All
groupings aggregate before they shuffle, so a patient, gene or locus that holds
a large share of the rows reaches a reducer only as partial results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarecohort.functions.annotation import (
    has_symbol,
    impact_label,
    impact_rank,
    ladder_impact,
    ladder_term,
    worst_term,
)
from rarecohort.functions.genomics import density, gene_length
from rarecohort.functions.genotype import is_carrier
from rarecohort.model import GENE, LOCUS, LOCUS_KEYS, PATIENT_LOCUS, PATIENT_LOCUS_KEYS, has_shadows
from rarecohort.operators.filters import is_rare


def cohort_size(cohort: DataFrame) -> DataFrame:
    """One row: number of patients before any filter; a null is none."""
    return cohort.select("Patient_ID").filter("Patient_ID IS NOT NULL").distinct().agg(F.count(F.lit(1)).alias("n_patients"))


def patients(n_patients: int | DataFrame) -> Column:
    """Cohort size as a column: a literal, or the scalar of a one-row table."""
    return F.lit(n_patients).cast("bigint") if isinstance(n_patients, int) else n_patients.scalar()


def _last(name: str) -> list[Column]:
    return [F.col(name).isNull().alias(f"no_{name}"), F.col(name)]


def _worst_annotation() -> Column:
    """Smallest annotation: with a gene first, then worst impact, then by name."""
    return F.min(
        F.struct(
            (~has_symbol()).alias("no_gene"),
            (-F.col("impact_rank")).alias("order_rank"),
            *_last("SYMBOL"),
            *_last("Consequence"),
            *_last("Gene"),
            *_last("IMPACT"),
        )
    ).alias("a")


def variant_dedup(carriers: DataFrame) -> DataFrame:
    """One row per patient and locus with its worst gene-carrying transcript."""
    return (
        carriers.withColumn("impact_rank", impact_rank())
        .groupBy(*PATIENT_LOCUS_KEYS)
        .agg(_worst_annotation())
        .select(
            *PATIENT_LOCUS,
            "a.SYMBOL",
            "a.Consequence",
            "a.IMPACT",
            "a.Gene",
            (-F.col("a.order_rank")).alias("impact_rank"),
        )
    )


def variant_level(variants: DataFrame, n_patients: int | DataFrame) -> DataFrame:
    """Per locus: carriers, their share of the cohort, and the worst annotation."""
    return (
        variants.groupBy(*LOCUS_KEYS)
        .agg(F.count(F.lit(1)).alias("patient_count"), _worst_annotation())
        .select(
            *LOCUS,
            "a.SYMBOL",
            "a.IMPACT",
            "a.Consequence",
            "patient_count",
            (F.col("patient_count").cast("double") / patients(n_patients).cast("double")).alias("frequency"),
        )
    )


def _rare_calls(cohort: DataFrame, max_af: float) -> DataFrame:
    """Rare carrier transcripts with a gene and a position."""
    placed = is_carrier() & has_symbol() & F.col("CHROM").isNotNull() & F.col("POS").isNotNull()
    return cohort.filter(placed).filter(is_rare(max_af, typed=has_shadows(cohort, "gnomADg_AF")))


def observations(cohort: DataFrame, max_af: float) -> DataFrame:
    """Rare carrier calls, one row per patient, locus and gene, with worst impact.

    The base of gene and bin statistics: hash aggregation with map-side
    combine folds the transcripts of a gene before anything is shuffled.
    """
    return _rare_calls(cohort, max_af).groupBy(*PATIENT_LOCUS, "SYMBOL").agg(F.max(impact_rank()).alias("impact_rank"))


def _worst_gene(rows: DataFrame, rank: Column) -> DataFrame:
    return (
        rows.filter(F.col("REF").isNotNull() & F.col("ALT").isNotNull())
        .groupBy(*PATIENT_LOCUS_KEYS)
        .agg(F.min(F.struct((-rank).alias("order_rank"), "SYMBOL")).alias("g"))
        .select(*PATIENT_LOCUS, "g.SYMBOL", (-F.col("g.order_rank")).alias("impact_rank"))
    )


def gene_variants(obs: DataFrame) -> DataFrame:
    """One gene per patient and locus: the one hit worst, ties by name.

    Loci with an unknown allele have no gene statistics.
    """
    return _worst_gene(obs, F.col("impact_rank"))


def gene_calls(cohort: DataFrame, max_af: float) -> DataFrame:
    """``gene_variants(observations(..))`` in one grouping.

    The worst transcript of a locus is that of its worst gene, so transcripts need not be
    folded by gene first, where nothing else asks for that.
    """
    return _worst_gene(_rare_calls(cohort, max_af), impact_rank())


def patient_gene_stats(variants: DataFrame) -> DataFrame:
    """Variants, extent and worst impact per patient and gene."""
    return (
        variants.filter(has_symbol())
        .groupBy("Patient_ID", *GENE)
        .agg(
            F.count(F.lit(1)).alias("variant_count"),
            F.min("POS").alias("gene_start"),
            F.max("POS").alias("gene_end"),
            F.max("impact_rank").alias("worst_impact_rank"),
        )
    )


def gene_level(patient_stats: DataFrame, n_patients: int | DataFrame) -> DataFrame:
    """Cohort statistics per gene; patients are distinct already, so they are counted."""
    return (
        patient_stats.groupBy(*GENE)
        .agg(
            F.count(F.lit(1)).alias("patient_count"),
            F.sum("variant_count").alias("variant_count"),
            F.min("gene_start").alias("gene_start"),
            F.max("gene_end").alias("gene_end"),
            F.max("worst_impact_rank").alias("worst_impact_rank"),
        )
        .withColumn("gene_length", gene_length())
        .select(
            *GENE,
            "patient_count",
            "variant_count",
            "gene_start",
            "gene_end",
            "gene_length",
            density("variant_count", "gene_length", patients(n_patients)).alias("density"),
            impact_label("worst_impact_rank").alias("worst_impact"),
            F.coalesce(F.col("gene_start"), F.lit(0).cast("bigint")).alias("POS"),
        )
    )


def gene_bounds(variants: DataFrame) -> DataFrame:
    """First and last observed position per gene."""
    return variants.groupBy(*GENE).agg(F.min("POS").alias("gene_start"), F.max("POS").alias("gene_end"))


def burden_long(df: DataFrame, gene_col: str = "Gene") -> DataFrame:
    """Distinct qualifying variants per gene and patient."""
    return (
        df.filter(F.col(gene_col).isNotNull())
        .select(gene_col, *PATIENT_LOCUS)
        .distinct()
        .groupBy(gene_col, "Patient_ID")
        .agg(F.count(F.lit(1)).alias("variant_count"))
    )


def burden_matrix(df: DataFrame, patient_ids: list[str], gene_col: str = "Gene") -> DataFrame:
    """Gene x patient counts for a given patient list, 0 where there is none."""
    return (
        burden_long(df.filter(F.col("Patient_ID").isin(patient_ids)), gene_col)
        .groupBy(gene_col)
        .pivot("Patient_ID", patient_ids)
        .agg(F.sum("variant_count"))
        .fillna(0, subset=patient_ids)
    )


def worst_consequence(df: DataFrame) -> DataFrame:
    """Most severe listed consequence per patient and locus, over all transcripts.

    The ladder is looked up within each row, so only its integer rank is
    aggregated (map-side, by hash); term and impact follow from the rank.
    """
    return (
        df.groupBy(*PATIENT_LOCUS)
        .agg(F.min(worst_term()["severity_rank"]).alias("severity_rank"))
        .select(
            *PATIENT_LOCUS,
            "severity_rank",
            ladder_term("severity_rank").alias("worst_term"),
            ladder_impact("severity_rank").alias("severity_impact"),
        )
    )
