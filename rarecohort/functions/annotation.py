"""Expressions over the annotation columns of one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rarecohort.model import IMPACT_RANKS, SEVERITY_LADDER


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def impact_rank(impact: str | Column = "IMPACT") -> Column:
    """HIGH 4, MODERATE 3, LOW 2; MODIFIER, NULL and unknown text are 1."""
    col = _col(impact)
    return (
        F.when(col == "HIGH", IMPACT_RANKS["HIGH"])
        .when(col == "MODERATE", IMPACT_RANKS["MODERATE"])
        .when(col == "LOW", IMPACT_RANKS["LOW"])
        .otherwise(IMPACT_RANKS["MODIFIER"])
    )


def impact_label(rank: str | Column) -> Column:
    """Inverse of :func:`impact_rank`; any other number is MODIFIER."""
    col = _col(rank)
    return (
        F.when(col == IMPACT_RANKS["HIGH"], "HIGH")
        .when(col == IMPACT_RANKS["MODERATE"], "MODERATE")
        .when(col == IMPACT_RANKS["LOW"], "LOW")
        .otherwise("MODIFIER")
    )


def has_symbol(symbol: str | Column = "SYMBOL") -> Column:
    col = _col(symbol)
    return col.isNotNull() & (col != "")


def consequence_terms(consequence: str | Column = "Consequence") -> Column:
    """The ``&``-joined terms as a trimmed array; NULL stays NULL."""
    return F.transform(F.split(_col(consequence), "&"), lambda t: F.trim(t))


def _ladder(values: list) -> Column:
    pairs = [F.lit(x) for (term, _), v in zip(SEVERITY_LADDER, values) for x in (term, v)]
    return F.create_map(*pairs)


def severity_rank(term: str | Column) -> Column:
    """Rank of one term on the severity ladder, 1 is worst; NULL if not listed."""
    return F.try_element_at(_ladder(list(range(1, len(SEVERITY_LADDER) + 1))), _col(term))


def worst_term(consequence: str | Column = "Consequence") -> Column:
    """STRUCT(severity_rank, term) of the most severe listed term of a row.

    The ladder has 36 rows, so it travels inside the expression: no explode,
    no join and no regrouping.  NULL when no term is on the ladder.
    """
    ranked = F.transform(
        consequence_terms(consequence),
        lambda t: F.struct(severity_rank(t).alias("severity_rank"), t.alias("term")),
    )
    return F.array_min(F.filter(ranked, lambda s: s["severity_rank"].isNotNull()))


def ladder_term(rank: str | Column) -> Column:
    """Term of a severity rank."""
    return F.get(F.array(*[F.lit(t) for t, _ in SEVERITY_LADDER]), _col(rank) - 1)


def ladder_impact(rank: str | Column) -> Column:
    """Impact of a severity rank."""
    impacts = F.array(*[F.lit(i) for _, i in SEVERITY_LADDER])
    return F.get(impacts, _col(rank) - 1)


def fraction_part(fraction: str | Column, part: int) -> Column:
    """``n/total`` of an exon or intron column: part 0 is n, part 1 is total."""
    return F.get(F.split(_col(fraction), "/"), F.lit(part)).try_cast("bigint")


def variation_ids(existing: str | Column = "Existing_variation") -> Column:
    """Identifiers as an array.

    Documented with commas; annotation inside a VCF record has to use ``&``,
    because the comma separates transcripts there.
    """
    return F.split(_col(existing), "[,&]")


def variation_source(identifier: str | Column) -> Column:
    """Database an identifier belongs to; NULL is a novel variant."""
    col = _col(identifier)
    return (
        F.when(col.isNull(), "novel")
        .when(col.startswith("rs"), "dbSNP")
        .when(col.startswith("COSM"), "COSMIC")
        .when(col.startswith("RCV") | col.startswith("VCV"), "ClinVar")
        .otherwise("other")
    )


def variant_type(ref: str | Column = "REF", alt: str | Column = "ALT") -> Column:
    """SNV, INS, DEL or MNV by allele length; NULL for anything but plain bases."""
    r, a = _col(ref), _col(alt)
    plain = r.rlike("^[A-Za-z]+$") & a.rlike("^[A-Za-z]+$")
    return F.when(
        plain,
        F.when(F.length(a) > F.length(r), "INS")
        .when(F.length(a) < F.length(r), "DEL")
        .when(F.length(r) == 1, "SNV")
        .otherwise("MNV"),
    )
