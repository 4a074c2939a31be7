import pytest
from pyspark.sql import functions as F

from rarecohort.operators import filters as FL
from rarecohort.sources.cohort import conform


def rows(spark, **columns):
    n = len(next(iter(columns.values())))
    data = [(i, *[v[i] for v in columns.values()]) for i in range(n)]
    return spark.createDataFrame(data, "i int, " + ", ".join(f"{c} string" for c in columns))


def kept(df):
    return sorted(r["i"] for r in df.select("i").collect())


def test_carriers(spark):
    df = rows(spark, GT=["0/0", "./.", "0|0", ".|.", None, "0/1", "./1", "0", "1|0"])
    assert kept(FL.carriers(df)) == [5, 6, 7, 8]


def test_rare_keeps_unknown_and_the_threshold(spark):
    df = rows(spark, gnomADg_AF=[None, "", "0.001&0.02", "0.01", "0.0100001", "NaN", "1e-5"])
    assert kept(FL.rare(df, 0.01)) == [0, 1, 2, 3, 6]
    assert kept(FL.rare(df.drop("gnomADg_AF"), 0.01)) == list(range(7))


def test_disease_rarity_is_strict(spark):
    df = rows(spark, gnomADg_AF=[None, "", "0.01", "0.00999", "NaN"], gnomADg_AF_sas=["0.5", "0.5", "0.1", "0.5", None])
    assert kept(FL.rarity(df, 0.01)) == [0, 1, 3, 4]
    assert kept(FL.rarity(df, 0.2, "gnomADg_AF_sas")) == [2, 4]


def test_technical(spark):
    df = rows(
        spark,
        FILTER=["PASS", "PASS", "PASS", "RefCall", "PASS", None, "PASS"],
        DP=["10", "9", "10", "10", "x", "10", "NaN"],
        GQ=["20", "20", None, "20", "20", "20", "20"],
        VAF=["0.2", "0.2", "0.2", "0.2", "0.2", "0.2", "0.2"],
    )
    assert kept(FL.technical_filter(df)) == [0]
    assert kept(FL.technical_filter(df, 20, 30, 0.35)) == []


def test_impact_with_splice(spark):
    df = rows(
        spark,
        IMPACT=["HIGH", "MODERATE", "LOW", "LOW", None, None],
        Consequence=["x", None, "splice_region_variant", None, "splice_donor_variant", None],
    )
    assert kept(FL.impact_filter(df)) == [0, 1]
    assert kept(FL.impact_filter(df, keep_splice=True)) == [0, 1, 2, 4]


def test_flags_and_pseudogenes(spark):
    df = rows(spark, FLAGS=[None, "x", None, None], BIOTYPE=["a", "a", "processed_pseudogene", None])
    assert kept(FL.exclude_flagged(df)) == [0, 3]


def test_contigs_and_symbolic(spark):
    df = rows(spark, CHROM=["chr1", "chrM", "chr23", "chrUn_1", None], ALT=["A", "<DEL>", None, "A<", "<INS>"])
    assert kept(FL.standard_contigs(df)) == [0, 1]
    assert kept(FL.exclude_symbolic(df)) == [0, 2, 3]


def test_coordinates_and_symbol(spark):
    df = rows(spark, CHROM=["a", None, "a"], POS=["1", "1", None], REF=["A"] * 3, ALT=["A"] * 3, SYMBOL=["", "G", None])
    assert kept(FL.has_coordinates(df)) == [0]
    assert kept(FL.has_coordinates(df, ["POS"])) == [0, 1]
    assert kept(FL.with_symbol(df)) == [1]


@pytest.mark.parametrize("column,fn", [("density", FL.min_density), ("frequency", FL.min_frequency)])
def test_display_thresholds(spark, column, fn):
    df = spark.createDataFrame([(0, 0.0), (1, 0.1), (2, 0.2)], f"i int, {column} double")
    assert kept(fn(df, 0)) == [0, 1, 2]
    assert kept(fn(df, 0.1)) == [1, 2]


def test_cascade_counts_equal_step_by_step(spark, sf_dir):
    from checks import fixtures as X

    df = conform(X.variants(spark, sf_dir))
    steps = FL.cascade_steps(0.01, keep_splice=True)
    counted = {r["step_no"]: (r["step"], r["remaining"]) for r in FL.cascade_counts(df, steps).collect()}
    assert counted[0] == ("input", df.count())
    for i in range(1, len(steps) + 1):
        assert counted[i] == (steps[i - 1][0], FL.filter_cascade(df, steps[:i]).count())
    assert FL.filter_cascade(df, steps).filter(F.col("FILTER") != "PASS").isEmpty()
