"""Column names, target types and fixed vocabularies of the variant table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: column names of the parsed table, in output order --------
BASE_COLUMNS = ["Patient_ID", "CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER"]
CSQ_COLUMNS = [
    "Allele", "Consequence", "IMPACT", "SYMBOL", "Gene", "Feature_type", "Feature", "BIOTYPE",
    "EXON", "INTRON", "HGVSc", "HGVSp", "cDNA_position", "CDS_position", "Protein_position",
    "Amino_acids", "Codons", "Existing_variation", "DISTANCE", "STRAND", "FLAGS",
    "SYMBOL_SOURCE", "HGNC_ID", "SOURCE", "gnomADg", "gnomADg_AF", "gnomADg_AF_afr",
    "gnomADg_AF_ami", "gnomADg_AF_amr", "gnomADg_AF_asj", "gnomADg_AF_eas", "gnomADg_AF_fin",
    "gnomADg_AF_nfe", "gnomADg_AF_sas",
]
FORMAT_COLUMNS = ["GT", "GQ", "DP", "AD", "VAF", "PL"]

# --- fixed values: vocabularies ---------------------------------------------
NON_CARRIER_GT = ["0/0", "./.", "0|0", ".|."]
IMPACT_RANKS = {"HIGH": 4, "MODERATE": 3, "LOW": 2, "MODIFIER": 1}
CHROMOSOMES = [f"chr{n}" for n in range(1, 23)] + ["chrX", "chrY", "chrM"]
CHROMOSOME_GAP = 10_000_000
PSEUDOGENE_BIOTYPES = ["processed_pseudogene", "unprocessed_pseudogene", "transcribed_pseudogene"]

# --- fixed values: sequence-ontology terms, most severe first, with impact ---
SEVERITY_LADDER = [
    ("transcript_ablation", "HIGH"),
    ("splice_acceptor_variant", "HIGH"),
    ("splice_donor_variant", "HIGH"),
    ("stop_gained", "HIGH"),
    ("frameshift_variant", "HIGH"),
    ("stop_lost", "HIGH"),
    ("start_lost", "HIGH"),
    ("transcript_amplification", "HIGH"),
    ("feature_elongation", "HIGH"),
    ("feature_truncation", "HIGH"),
    ("inframe_insertion", "MODERATE"),
    ("inframe_deletion", "MODERATE"),
    ("missense_variant", "MODERATE"),
    ("protein_altering_variant", "MODERATE"),
    ("splice_region_variant", "LOW"),
    ("incomplete_terminal_codon_variant", "LOW"),
    ("start_retained_variant", "LOW"),
    ("stop_retained_variant", "LOW"),
    ("synonymous_variant", "LOW"),
    ("coding_sequence_variant", "MODIFIER"),
    ("mature_miRNA_variant", "MODIFIER"),
    ("5_prime_UTR_variant", "MODIFIER"),
    ("3_prime_UTR_variant", "MODIFIER"),
    ("non_coding_transcript_exon_variant", "MODIFIER"),
    ("intron_variant", "MODIFIER"),
    ("NMD_transcript_variant", "MODIFIER"),
    ("non_coding_transcript_variant", "MODIFIER"),
    ("upstream_gene_variant", "MODIFIER"),
    ("downstream_gene_variant", "MODIFIER"),
    ("TFBS_ablation", "MODIFIER"),
    ("TFBS_amplification", "MODIFIER"),
    ("TF_binding_site_variant", "MODIFIER"),
    ("regulatory_region_ablation", "MODERATE"),
    ("regulatory_region_amplification", "MODIFIER"),
    ("regulatory_region_variant", "MODIFIER"),
    ("intergenic_variant", "MODIFIER"),
]

COLUMNS = BASE_COLUMNS + CSQ_COLUMNS + FORMAT_COLUMNS
LOCUS = ["CHROM", "POS", "REF", "ALT"]
PATIENT_LOCUS = ["Patient_ID", *LOCUS]
GENE = ["SYMBOL", "CHROM"]

# Grouping order of the same keys.  Aggregates of text sort by the keys, and a
# number that comes first settles nearly all comparisons; ids share prefixes.
LOCUS_KEYS = ["POS", "CHROM", "REF", "ALT"]
PATIENT_LOCUS_KEYS = ["POS", "Patient_ID", "CHROM", "REF", "ALT"]

_TYPES = {"POS": T.LongType(), "QUAL": T.DoubleType()}

#: Types every source is brought to.  Frequencies and call qualities stay
#: strings, as annotated files may hold values such as ``0.001&0.02`` there.
VARIANT_SCHEMA = T.StructType([T.StructField(c, _TYPES.get(c, T.StringType())) for c in COLUMNS])


def number(column: str | Column) -> Column:
    """The column as DOUBLE; text that is no number becomes NULL."""
    return (F.col(column) if isinstance(column, str) else column).try_cast("double")


#: Text columns that filters read as numbers.
NUMERIC_TEXT = [c for c in COLUMNS if c.startswith("gnomADg_AF")] + ["DP", "GQ", "VAF"]


def shadow(column: str) -> str:
    """Name of the DOUBLE column that may stand beside a text column (see ``with_numbers``)."""
    return f"{column}__number"


def has_shadows(df: DataFrame, *columns: str) -> bool:
    return all(shadow(c) in df.columns for c in columns)


def is_standard_contig(column: str | Column = "CHROM") -> Column:
    return (F.col(column) if isinstance(column, str) else column).isin(CHROMOSOMES)


def chromosome_order(column: str | Column = "CHROM") -> Column:
    """1 for the first chromosome of the cytogenetic order, 0 for other contigs."""
    col = F.col(column) if isinstance(column, str) else column
    return F.array_position(F.array(*[F.lit(c) for c in CHROMOSOMES]), col)
