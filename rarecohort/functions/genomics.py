"""Arithmetic on positions, lengths and densities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gene_length(start: str | Column = "gene_start", end: str | Column = "gene_end") -> Column:
    return F.greatest(_col(end) - _col(start) + 1, F.lit(1).cast("bigint"))


def density(count: str | Column, length: str | Column, n_patients: Column) -> Column:
    """Observations per base and patient, as DOUBLE."""
    return _col(count).cast("double") / (_col(length) * n_patients).cast("double")


def log_density(col: str | Column = "density") -> Column:
    return F.log10(F.greatest(_col(col), F.lit(1e-15)))


def contig_label(chrom: str | Column = "CHROM") -> Column:
    return F.replace(_col(chrom), F.lit("chr"), F.lit(""))


def bin_name(chrom: str | Column, symbol: str | Column, index: str | Column) -> Column:
    return F.concat(_col(chrom), F.lit("_"), _col(symbol), F.lit("_bin"), _col(index).cast("string"))


def bin_label(symbol: str | Column = "SYMBOL", index: str | Column = "bin_index") -> Column:
    return F.concat(_col(symbol), F.lit("[bin"), _col(index).cast("string"), F.lit("]"))


def variant_label(symbol: str | Column = "SYMBOL") -> Column:
    """``SYMBOL  CHROM:POS  (REF>ALT)``; a missing symbol reads Unknown."""
    name = F.coalesce(F.nullif(_col(symbol), F.lit("")), F.lit("Unknown"))
    return F.format_string("%s  %s:%s  (%s>%s)", name, "CHROM", "POS", "REF", "ALT")
