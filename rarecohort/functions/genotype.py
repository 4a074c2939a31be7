"""Expressions over the sample columns of one row (GT, GQ, DP, AD, VAF, PL)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rarecohort.model import NON_CARRIER_GT, number


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_carrier(gt: str | Column = "GT") -> Column:
    """Any call but NULL and the four reference / missing strings.

    Partial (``./1``) and haploid calls count as carriers.
    """
    col = _col(gt)
    return col.isNotNull() & ~col.isin(NON_CARRIER_GT)


def zygosity(gt: str | Column = "GT") -> Column:
    """Zygosity class; phased and unphased calls are alike.

    A haploid call has one allele and falls in the homozygous classes.
    """
    alleles = F.split(_col(gt), "[/|]")
    known = F.filter(alleles, lambda a: a != ".")
    distinct = F.array_distinct(known)
    return (
        F.when(_col(gt).isNull(), None)
        .when(F.size(known) == 0, "no_call")
        .when(F.size(known) < F.size(alleles), "partial_no_call")
        .when(F.size(distinct) == 1, F.when(F.get(distinct, F.lit(0)) == "0", "hom_ref").otherwise("hom_alt"))
        .when(F.array_contains(distinct, "0"), "het")
        .otherwise("compound_het")
    )


def vaf_from_ad(ad: str | Column = "AD") -> Column:
    """alt / (ref + alt) of the first two depths; NULL without reads."""
    depths = F.split(_col(ad), ",")
    ref, alt = number(F.get(depths, F.lit(0))), number(F.get(depths, F.lit(1)))
    return F.try_divide(alt, ref + alt)


def vaf_band(vaf: str | Column = "VAF") -> Column:
    """Germline reading of the allele fraction; the lower edge belongs to a band."""
    v = number(vaf)
    return (
        F.when(v.isNull() | F.isnan(v) | (v < 0) | (v > 1), None)
        .when(v < 0.10, "artefact")
        .when(v < 0.35, "mosaic")
        .when(v < 0.65, "heterozygous")
        .when(v < 0.90, "skewed")
        .otherwise("homozygous")
    )


def dp_band(dp: str | Column = "DP") -> Column:
    """Read depth: below 10, 10 to below 20, 20 to 100, above 100."""
    d = number(dp)
    return (
        F.when(d < 10, "too_low").when(d < 20, "borderline").when(d <= 100, "adequate").when(d > 100, "high")
    )


def gq_band(gq: str | Column = "GQ") -> Column:
    """Genotype quality: below 20, 20 to below 30, 30 and more."""
    q = number(gq)
    return F.when(q < 20, "uncertain").when(q < 30, "minimum").when(q >= 30, "high_confidence")


def phred_error(quality: str | Column) -> Column:
    """Probability that a call is wrong, 10^(-Q/10)."""
    return F.pow(F.lit(10.0), -number(quality) / F.lit(10.0))


def likelihoods(pl: str | Column = "PL") -> Column:
    """Phred-scaled genotype likelihoods as ARRAY<BIGINT>."""
    return F.transform(F.split(_col(pl), ","), lambda x: x.try_cast("bigint"))


def pl_gap(pl: str | Column = "PL") -> Column:
    """Second lowest minus lowest likelihood; NULL with fewer than two values."""
    ordered = F.array_sort(F.filter(likelihoods(pl), lambda x: x.isNotNull()))
    return F.get(ordered, F.lit(1)) - F.get(ordered, F.lit(0))
