"""One query per operator, over the variant table derived from ``lineitem``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as X
from rarecohort.functions import annotation as AN
from rarecohort.functions import genotype as GT
from rarecohort.functions.genomics import bin_label
from rarecohort.model import COLUMNS, PATIENT_LOCUS
from rarecohort.operators import bins as B
from rarecohort.operators import burden as BU
from rarecohort.operators import filters as FL
from rarecohort.operators import genes as G
from rarecohort.operators import layout as L
from rarecohort.operators import report as R
from rarecohort.plans.analysis import Binning, analyse, bin_table, gene_table, variant_table
from rarecohort.sources import vcf as V
from rarecohort.sources.cohort import (
    BIN_RESULT,
    GENE_RESULT,
    VARIANT_RESULT,
    cohort_union,
    read_cohort,
    read_results,
    write_parsed,
    write_results,
)
from rarecohort.sources.increment import update_parsed
from rarecohort.sources.staging import stage

MAX_AF = 0.01
FIXED = Binning(500_000, 0)
OVERLAP = Binning(2_000_000, 500_000)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: The queries among them that read the variant table only.
ON_VARIANTS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _on(table: Callable[[DataFrame], DataFrame], name: str) -> None:
    """Registers an operator that reads the variant table."""
    ON_VARIANTS[name] = table
    QUERIES[name] = lambda spark, sf_dir: table(X.variants(spark, sf_dir))


def genes(v: DataFrame) -> DataFrame:
    return gene_table(v, MAX_AF)


def fixed_bins(v: DataFrame) -> DataFrame:
    return bin_table(v, MAX_AF, FIXED)


def overlap_bins(v: DataFrame) -> DataFrame:
    return bin_table(v, MAX_AF, OVERLAP)


def loci(v: DataFrame) -> DataFrame:
    return variant_table(v, MAX_AF)


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Rounds what two engines may compute with different last bits."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# --- sources -------------------------------------------------------------------
@query
def vcf_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.vcf_headers(X.vcf_text(spark, sf_dir)).select(
        "Patient_ID", F.size("fields").cast("bigint").alias("n_fields"), F.array_join("fields", "|").alias("fields")
    )


@query
def vcf_file_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From the heads of files on disk."""
    return V.vcf_headers(V.vcf_heads(spark, X.vcf_files(spark, sf_dir))).select(
        "Patient_ID", F.size("fields").cast("bigint").alias("n_fields"), F.array_join("fields", "|").alias("fields")
    )


def _flat(parsed: DataFrame) -> DataFrame:
    """The listed columns, and the whole map of others: its size and its two values."""
    extras = [F.col("extras")[n].alias(n) for n in ("MIN_DP", "CANONICAL")]
    return parsed.select(*[c for c in COLUMNS], *extras, F.size("extras").alias("n_extras"))


@query
def vcf_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(V.parse_lines(X.vcf_text(spark, sf_dir)))


@query
def vcf_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From files on disk, one per patient."""
    return _flat(V.read_vcf(spark, X.vcf_files(spark, sf_dir)))


@query
def parsed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed, written by patient, and read back."""
    folder = X.new_folder(spark, "parsed")
    write_parsed(V.parse_lines(X.vcf_text(spark, sf_dir)), folder)
    return _flat(read_cohort(spark, folder))


@query
def parsed_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of half the patients, brought up to date with files of the others."""
    parsed, manifest = X.new_folder(spark, "parsed"), X.new_folder(spark, "manifest")
    halves = [X.vcf_files(spark, sf_dir, f"right(Patient_ID, 1) {op} '5'") for op in ("<", ">=")]
    update_parsed(spark, halves[0], parsed, manifest)
    update_parsed(spark, halves, parsed, manifest)
    return _flat(read_cohort(spark, parsed))


@query
def cohort_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder whose files differ in columns and types."""
    return read_cohort(spark, X.mixed_folder(spark, sf_dir)).select(*X.COLUMNS_SQL)


@query
def cohort_manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, planned from a manifest: one patient in three is added after it was made."""
    folder, manifest = X.mixed_folder(spark, sf_dir, parts=2), X.new_folder(spark, "manifest")
    read_cohort(spark, folder, manifests=[manifest])
    X.mixed_folder(spark, sf_dir, parts=3, folder=folder, done=2)
    return read_cohort(spark, folder, manifests=[manifest]).select(*X.COLUMNS_SQL)


@query
def parsed_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.parsed_row_counts(V.parse_lines(X.vcf_text(spark, sf_dir)))


@query
def cohort_union_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two producers: one writes text, the other numbers and fewer columns."""
    v = X.variants(spark, sf_dir)
    even = F.expr(f"{X.PATIENT_NO} % 2 = 0")
    text = v.filter(even).withColumn("POS", F.col("POS").cast("string"))
    numbers = (
        v.filter(~even)
        .drop("FLAGS", "gnomADg_AF_nfe")
        .withColumns({"GQ": F.col("GQ").cast("bigint"), "QUAL": F.col("QUAL").cast("double")})
    )
    return cohort_union([text, numbers]).select(*X.COLUMNS_SQL)


QUERIES["cohort_union"] = QUERIES.pop("cohort_union_")
_on(G.cohort_size, "cohort_size")

# --- filters -------------------------------------------------------------------
_on(lambda v: FL.has_coordinates(FL.carriers(v)), "carriers")
_on(lambda v: FL.rare_carriers(v, MAX_AF), "rare_carriers")
_on(FL.with_symbol, "symbol_filter")
_on(FL.technical_filter, "technical_filter")
_on(lambda v: FL.technical_filter(v, 20, 30, 0.35), "technical_filter_stringent")
_on(FL.biotype_filter, "coding_filter")
_on(FL.impact_filter, "impact_filter")
_on(lambda v: FL.impact_filter(v, keep_splice=True), "impact_or_splice_filter")
_on(lambda v: FL.rarity(v, 0.001), "rarity_dominant")
_on(lambda v: FL.rarity(v, 0.01), "rarity_recessive")
_on(lambda v: FL.rarity(v, 0.0001), "rarity_dominant_stringent")
_on(lambda v: FL.rarity(v, 0.01, "gnomADg_AF_nfe"), "rarity_population")
_on(FL.exclude_flagged, "quality_region_filter")
_on(lambda v: FL.filter_cascade(v, FL.cascade_steps(0.01)), "filter_cascade")
_on(lambda v: FL.cascade_counts(v, FL.cascade_steps(0.01)), "filter_cascade_counts")


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant table as it is stored with number columns."""
    folder = X.new_folder(spark, "numbered")
    write_parsed(X.variants(spark, sf_dir), folder, numbers=True)
    return read_cohort(spark, folder)


@query
def rare_carriers_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FL.rare_carriers(_numbered(spark, sf_dir), MAX_AF).select(*X.COLUMNS_SQL)


@query
def filter_cascade_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return FL.filter_cascade(_numbered(spark, sf_dir), FL.cascade_steps(0.01, typed=True)).select(*X.COLUMNS_SQL)


_on(FL.standard_contigs, "standard_contigs")
_on(FL.exclude_symbolic, "non_symbolic")
_on(lambda v: FL.min_density(genes(v), 1e-6), "min_density_genes")
_on(lambda v: FL.min_density(fixed_bins(v), 1e-6), "min_density_bins")
_on(lambda v: FL.min_frequency(loci(v), 0.02), "min_frequency_variants")

# --- genes and variants ----------------------------------------------------------
_on(lambda v: G.variant_dedup(FL.rare_carriers(v, MAX_AF)), "variant_dedup")
_on(lambda v: G.patient_gene_stats(G.gene_variants(G.observations(v, MAX_AF))), "patient_gene_stats")
_on(genes, "gene_level")
_on(lambda v: R.sorted_genes(genes(v)), "gene_level_sorted")
_on(loci, "variant_level")
_on(lambda v: G.burden_long(FL.filter_cascade(FL.carriers(v), FL.cascade_steps(0.01))), "burden_long")



def _burden(v: DataFrame, block: int) -> tuple[DataFrame, DataFrame]:
    """The numbered patients of the cohort and the sparse matrix of qualifying variants."""
    index = stage(BU.patient_index(v), "patient_index")
    qualifying = FL.filter_cascade(FL.carriers(v), FL.cascade_steps(0.01))
    return index, stage(BU.burden_sparse(qualifying, index, block=block), "burden")


@query
def burden_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, sparse = _burden(X.variants(spark, sf_dir), 32)
    return sparse.select("Gene", "block", *[F.array_join(c, ",").alias(c) for c in ("patients", "counts")])


@query
def burden_from_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, sparse = _burden(X.variants(spark, sf_dir), BU.BLOCK)
    return BU.burden_rows(sparse, index)


@query
def burden_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes by all patients, as rows again: zeros are part of it."""
    index, sparse = _burden(X.variants(spark, sf_dir), BU.BLOCK)
    cells = BU.burden_blocks(sparse, index.count()).select("Gene", "block", F.posexplode("counts").alias("k", "variant_count"))
    at = F.col("block") * BU.BLOCK + F.col("k")
    return cells.withColumn("patient_index", at).join(index, "patient_index").select("Gene", "Patient_ID", "variant_count")


# --- bins --------------------------------------------------------------------------
@query
def gene_bounds_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = stage(G.observations(X.variants(spark, sf_dir), MAX_AF), "observations")
    return B.observations_in_genes(obs, stage(G.gene_bounds(G.gene_variants(obs)), "bounds"))


_on(fixed_bins, "bin_level_fixed")
_on(lambda v: R.sorted_bins(fixed_bins(v)), "bin_level_sorted")
_on(overlap_bins, "bin_level_overlap")
_on(lambda v: bin_table(v, MAX_AF, Binning(500_000, 0, "engine")), "bin_level_fixed_engine")
_on(lambda v: bin_table(v, MAX_AF, Binning(2_000_000, 500_000, "engine")), "bin_level_overlap_engine")

# --- reports -----------------------------------------------------------------------
_on(lambda v: R.top_genes(genes(v), 10), "top_genes")
_on(lambda v: R.top_bins(overlap_bins(v), 10).withColumn("label", bin_label()), "top_bins")
_on(lambda v: R.top_variants(loci(v), 15), "top_variants")
_on(lambda v: R.impact_tally(genes(v)), "impact_tally_genes")
_on(lambda v: R.impact_tally(fixed_bins(v)), "impact_tally_bins")
_on(lambda v: _rounded(R.density_summary(genes(v)), 15, "mean_density"), "density_summary_genes")
_on(lambda v: _rounded(R.density_summary(fixed_bins(v)), 15, "mean_density"), "density_summary_bins")
_on(lambda v: R.consequence_breakdown(loci(v)), "consequence_breakdown")

# --- layout ------------------------------------------------------------------------
_on(lambda v: L.chrom_offsets(genes(v)), "chrom_offsets")
_on(lambda v: L.chrom_extent(genes(v)), "chrom_extent")


def _placed_bins(v: DataFrame) -> DataFrame:
    return analyse(v, [OVERLAP], MAX_AF).bins[OVERLAP]


def _placed_variants(v: DataFrame) -> DataFrame:
    return analyse(v, [], MAX_AF).variants


@query
def manhattan_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = stage(genes(X.variants(spark, sf_dir)), "genes")
    return L.with_cum_pos(table, L.chrom_offsets(table))


_on(_placed_bins, "manhattan_bins")
_on(_placed_variants, "manhattan_variants")
_on(lambda v: _rounded(L.gene_rank_layout(genes(v)), 9, "log_density"), "gene_rank_layout")
_on(lambda v: _rounded(L.bin_rank_layout(overlap_bins(v)), 9, "log_density"), "bin_rank_layout")
_on(lambda v: L.chrom_bands(L.gene_rank_layout(genes(v))), "gene_bands")
_on(lambda v: L.chrom_bands(L.bin_rank_layout(overlap_bins(v))), "bin_bands")
_on(lambda v: L.chrom_bands(_placed_variants(v), "cum_pos"), "variant_bands")
_on(lambda v: L.bubble_genes(genes(v)), "bubble_genes")
_on(lambda v: L.bubble_bins(fixed_bins(v)), "bubble_bins")
_on(lambda v: _rounded(L.bubble_variants(loci(v)), 9, "bubble_size"), "bubble_variants")
_on(lambda v: _rounded(L.density_levels(genes(v)), 9, "level"), "reference_levels")
_on(lambda v: _rounded(L.density_levels(fixed_bins(v)), 9, "level"), "reference_levels_bins")
_on(lambda v: _rounded(L.frequency_levels(loci(v)), 9, "level"), "frequency_levels")

# --- whole analysis ------------------------------------------------------------------
@query
def analysis_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analyse(X.variants(spark, sf_dir), [], MAX_AF).genes


@query
def analysis_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both binnings of one run, from one pass over the variant table."""
    tables = analyse(X.variants(spark, sf_dir), [FIXED, OVERLAP], MAX_AF).bins
    fixed, overlap = [
        t.select(F.lit(b.length).alias("bin_length"), F.lit(b.overlap).alias("bin_overlap"), "*")
        for b, t in tables.items()
    ]
    return fixed.unionByName(overlap)


def _written(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of a whole run as it is read back from its CSV files."""
    result, folder = analyse(X.variants(spark, sf_dir), [OVERLAP], MAX_AF), X.new_folder(spark, "results")
    write_results(folder, result.genes, result.bins[OVERLAP], result.variants)
    return read_results(spark, folder)[table]


@query
def results_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, GENE_RESULT)


@query
def results_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, BIN_RESULT)


@query
def results_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir, VARIANT_RESULT)


# --- derived columns -----------------------------------------------------------------
_KEY = [*PATIENT_LOCUS, "Feature"]


def _derived(v: DataFrame, *columns) -> DataFrame:
    return v.select(*_KEY, *columns)


_on(lambda v: _derived(v, "GT", GT.zygosity().alias("zygosity")), "zygosity")
_on(lambda v: _derived(v, "AD", GT.vaf_from_ad().alias("vaf_from_ad")), "vaf_from_ad")
_on(
    lambda v: _derived(
        v,
        GT.vaf_band().alias("vaf_band"),
        GT.dp_band().alias("dp_band"),
        GT.gq_band().alias("gq_band"),
        F.round(GT.phred_error("GQ"), 12).alias("gq_error"),
        F.round(GT.phred_error("QUAL"), 12).alias("qual_error"),
    ),
    "quality_bands",
)
_on(
    lambda v: _derived(
        v,
        *[F.get(GT.likelihoods(), F.lit(i)).alias(n) for i, n in enumerate(("pl_rr", "pl_ra", "pl_aa"))],
        GT.pl_gap().alias("pl_gap"),
    ),
    "pl_gap",
)
_on(
    lambda v: _derived(
        v, AN.fraction_part("EXON", 0).alias("exon"), AN.fraction_part("EXON", 1).alias("exons")
    ),
    "exon_fraction",
)
_on(lambda v: _derived(v, AN.variant_type().alias("variant_type")), "variant_type")
_on(
    lambda v: _derived(v, F.explode_outer(AN.variation_ids()).alias("variation_id")).withColumn(
        "source", AN.variation_source("variation_id")
    ),
    "known_variation",
)


@query
def worst_consequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    worst = AN.worst_term()
    return _derived(X.variants(spark, sf_dir), "Consequence", worst.alias("w")).select(
        *_KEY,
        "Consequence",
        F.col("w.term").alias("worst_term"),
        F.col("w.severity_rank").alias("severity_rank"),
        AN.ladder_impact("w.severity_rank").alias("severity_impact"),
    )


@query
def worst_consequence_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.worst_consequence(X.variants(spark, sf_dir))


@query
def consequence_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.explode_consequence(X.variants(spark, sf_dir)).select(*_KEY, "Consequence")
