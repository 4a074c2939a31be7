"""The cohort analysis: genes once, then any number of bin tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from rarecohort.operators import bins as B
from rarecohort.operators import genes as G
from rarecohort.operators import layout as L
from rarecohort.operators.filters import rare_carriers
from rarecohort.sources.staging import stage


@dataclass(frozen=True)
class Binning:
    length: int
    overlap: int = 0
    mode: str = "floor"


@dataclass
class CohortTables:
    """Result tables; ``bins`` is keyed by the binning that made it.

    Genes are computed when this is made, the others when they are used.
    """

    n_patients: int
    genes: DataFrame
    variants: DataFrame
    offsets: DataFrame
    bins: dict[Binning, DataFrame] = field(default_factory=dict)


def gene_table(cohort: DataFrame, max_af: float) -> DataFrame:
    """Gene statistics in one lazy plan: by patient and locus, by patient and gene, by gene."""
    stats = G.patient_gene_stats(G.gene_calls(cohort, max_af))
    return G.gene_level(stats, G.cohort_size(cohort))


def bin_table(cohort: DataFrame, max_af: float, binning: Binning) -> DataFrame:
    """Bin statistics; the observations and gene bounds below them are staged.

    Both bounds and bins come from the observations, so the cohort is scanned
    once, and the number of genes decides how the bounds are joined.
    """
    obs = stage(G.observations(cohort, max_af), "observations")
    bounds = stage(G.gene_bounds(G.gene_variants(obs)), "bounds")
    in_gene = B.observations_in_genes(obs, bounds)
    return B.bin_level(in_gene, G.cohort_size(cohort), binning.length, binning.overlap, binning.mode)


def variant_table(cohort: DataFrame, max_af: float) -> DataFrame:
    """Locus frequencies in one lazy plan."""
    return G.variant_level(G.variant_dedup(rare_carriers(cohort, max_af)), G.cohort_size(cohort))


def analyse(cohort: DataFrame, binnings: list[Binning], max_af: float = 0.01) -> CohortTables:
    """Genes, offsets and bins of a large cohort.

    Observations and genes are written to the shared folder: the raw table is
    scanned once whatever the number of binnings, a lost executor costs no
    recomputation from raw rows, and the genes are counted before the join.
    """
    n_patients = G.cohort_size(cohort).first()["n_patients"]
    obs = stage(G.observations(cohort, max_af), "observations")
    stats = G.patient_gene_stats(G.gene_variants(obs))
    genes = stage(G.gene_level(stats, n_patients), "genes")
    if genes.isEmpty():
        raise ValueError("no variant data left after filtering")
    offsets = L.chrom_offsets(genes)
    in_gene = B.observations_in_genes(obs, genes)
    tables = {
        b: L.with_cum_pos(B.bin_level(in_gene, n_patients, b.length, b.overlap, b.mode), offsets) for b in binnings
    }
    variants = G.variant_level(G.variant_dedup(rare_carriers(cohort, max_af)), n_patients)
    return CohortTables(n_patients, *[L.with_cum_pos(t, offsets) for t in (genes, variants)], offsets, tables)
