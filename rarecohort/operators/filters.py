"""Row filters: carriers, rarity, call quality, impact, and the filter cascade.

Each filter is a predicate (Column) plus a DataFrame function that applies it,
so that the cascade can count every step in one pass over the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarecohort.functions.annotation import has_symbol
from rarecohort.functions.genotype import is_carrier
from rarecohort.model import LOCUS, PSEUDOGENE_BIOTYPES, has_shadows, is_standard_contig, number, shadow


# --- predicates --------------------------------------------------------------
# Each parses a number once: a second mention would parse the text again.  With ``typed``
# the DOUBLE column beside the text is read instead, in comparisons that reach the Parquet scan,
# where NaN is what is greater than infinity.
_INFINITY = float("inf")


def _not_nan(column: str) -> Column:
    return F.nanvl(number(column), F.lit(None).cast("double"))


def is_rare(max_af: float, af_col: str = "gnomADg_AF", typed: bool = False) -> Column:
    """Frequency unknown, not a number, or at most ``max_af`` (NaN is dropped)."""
    if typed:
        value = F.col(shadow(af_col))
        return value.isNull() | (value <= F.lit(max_af))
    return F.coalesce(number(af_col) <= F.lit(max_af), F.lit(True))


def is_below(max_af: float, af_col: str = "gnomADg_AF", typed: bool = False) -> Column:
    """Frequency unknown, not a number (NaN included), or strictly below ``max_af``."""
    if typed:
        value = F.col(shadow(af_col))
        return value.isNull() | (value < F.lit(max_af)) | (value > F.lit(_INFINITY))
    return F.coalesce(_not_nan(af_col) < F.lit(max_af), F.lit(True))


def _at_least(column: str, minimum: float, typed: bool = False) -> Column:
    if typed:
        value = F.col(shadow(column))
        return value.isNotNull() & (value >= F.lit(minimum)) & (value <= F.lit(_INFINITY))
    return F.coalesce(_not_nan(column) >= F.lit(minimum), F.lit(False))


_CALL_QUALITY = ("DP", "GQ", "VAF")


def passes_technical(min_dp: float = 10, min_gq: float = 20, min_vaf: float = 0.2, typed: bool = False) -> Column:
    dp, gq, vaf = (_at_least(c, m, typed) for c, m in zip(_CALL_QUALITY, (min_dp, min_gq, min_vaf)))
    return F.col("FILTER").eqNullSafe("PASS") & dp & gq & vaf


def has_biotype(biotype: str = "protein_coding") -> Column:
    return F.col("BIOTYPE").eqNullSafe(biotype)


def has_impact(impacts: tuple[str, ...] = ("HIGH", "MODERATE"), keep_splice: bool = False) -> Column:
    listed = F.coalesce(F.col("IMPACT").isin(*impacts), F.lit(False))
    if not keep_splice:
        return listed
    return listed | F.coalesce(F.col("Consequence").contains("splice"), F.lit(False))


def is_unflagged(biotypes: list[str] = PSEUDOGENE_BIOTYPES) -> Column:
    """No transcript flag and not a pseudogene; an unknown BIOTYPE is kept."""
    return F.col("FLAGS").isNull() & ~F.coalesce(F.col("BIOTYPE").isin(*biotypes), F.lit(False))


def is_symbolic() -> Column:
    return F.coalesce(F.col("ALT").startswith("<"), F.lit(False))


# --- filters -----------------------------------------------------------------
def carriers(df: DataFrame) -> DataFrame:
    return df.filter(is_carrier())


def has_coordinates(df: DataFrame, columns: list[str] = LOCUS) -> DataFrame:
    return df.dropna(how="any", subset=columns)


def rare(df: DataFrame, max_af: float, af_col: str = "gnomADg_AF") -> DataFrame:
    """Rarity of the cohort analysis (``<=``); a table without the column passes whole."""
    return df.filter(is_rare(max_af, af_col, has_shadows(df, af_col))) if af_col in df.columns else df


def rare_carriers(df: DataFrame, max_af: float) -> DataFrame:
    """Carrier calls of rare variants with complete coordinates."""
    return rare(has_coordinates(carriers(df)), max_af)


def with_symbol(df: DataFrame) -> DataFrame:
    return df.filter(has_symbol())


def min_density(df: DataFrame, threshold: float) -> DataFrame:
    return df.filter(F.col("density") >= F.lit(threshold)) if threshold > 0 else df


def min_frequency(df: DataFrame, threshold: float) -> DataFrame:
    return df.filter(F.col("frequency") >= F.lit(threshold)) if threshold > 0 else df


def technical_filter(df: DataFrame, min_dp: float = 10, min_gq: float = 20, min_vaf: float = 0.2) -> DataFrame:
    return df.filter(passes_technical(min_dp, min_gq, min_vaf, has_shadows(df, *_CALL_QUALITY)))


def biotype_filter(df: DataFrame, biotype: str = "protein_coding") -> DataFrame:
    return df.filter(has_biotype(biotype))


def impact_filter(
    df: DataFrame, impacts: tuple[str, ...] = ("HIGH", "MODERATE"), keep_splice: bool = False
) -> DataFrame:
    return df.filter(has_impact(impacts, keep_splice))


def rarity(df: DataFrame, max_af: float, af_col: str = "gnomADg_AF") -> DataFrame:
    """Rarity of the disease models (``<``), on the global or a population column."""
    return df.filter(is_below(max_af, af_col, has_shadows(df, af_col)))


def exclude_flagged(df: DataFrame, biotypes: list[str] = PSEUDOGENE_BIOTYPES) -> DataFrame:
    return df.filter(is_unflagged(biotypes))


def standard_contigs(df: DataFrame) -> DataFrame:
    return df.filter(is_standard_contig())


def exclude_symbolic(df: DataFrame) -> DataFrame:
    return df.filter(~is_symbolic())


# --- cascade -----------------------------------------------------------------
Steps = list[tuple[str, Column]]


def cascade_steps(
    max_af: float,
    af_col: str = "gnomADg_AF",
    min_dp: float = 10,
    min_gq: float = 20,
    min_vaf: float = 0.2,
    keep_splice: bool = False,
    typed: bool = False,
) -> Steps:
    """The recommended order: quality, coding, impact, rarity, region quality.

    ``typed`` is for tables with number columns beside the text (``has_shadows``).
    """
    return [
        ("technical", passes_technical(min_dp, min_gq, min_vaf, typed)),
        ("protein_coding", has_biotype()),
        ("impact", has_impact(keep_splice=keep_splice)),
        ("rarity", is_below(max_af, af_col, typed)),
        ("region_quality", is_unflagged()),
    ]


def filter_cascade(df: DataFrame, steps: Steps) -> DataFrame:
    for _, predicate in steps:
        df = df.filter(predicate)
    return df


def cascade_counts(df: DataFrame, steps: Steps) -> DataFrame:
    """Rows left after each step, from one scan and one global aggregate."""
    kept = F.lit(True)
    counts = [F.count(F.lit(1)).alias("c0")]
    for i, (_, predicate) in enumerate(steps, start=1):
        kept = kept & predicate
        counts.append(F.count_if(kept).alias(f"c{i}"))
    names = ["input", *[name for name, _ in steps]]
    rows = F.array(
        *[
            F.struct(F.lit(i).alias("step_no"), F.lit(n).alias("step"), F.col(f"c{i}").alias("remaining"))
            for i, n in enumerate(names)
        ]
    )
    return df.agg(*counts).select(F.inline(rows))
