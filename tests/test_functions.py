import math

import pytest
from pyspark.sql import functions as F

from rarecohort.functions import annotation as AN
from rarecohort.functions import genomics as GN
from rarecohort.functions import genotype as GT


def values(spark, expr, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "fn,cases",
    [
        (AN.impact_rank, {"HIGH": 4, "MODERATE": 3, "LOW": 2, "MODIFIER": 1, "other": 1, None: 1}),
        (
            GT.zygosity,
            {
                "0/0": "hom_ref", "0|0": "hom_ref", "0/1": "het", "1|0": "het", "0/2": "het", "1/1": "hom_alt",
                "2|2": "hom_alt", "1/2": "compound_het", "./.": "no_call", ".|.": "no_call", ".": "no_call",
                "./1": "partial_no_call", "0|.": "partial_no_call", "1": "hom_alt", "0": "hom_ref",
                "10/10": "hom_alt", "1/10": "compound_het", None: None,
            },
        ),
        (GT.is_carrier, {"0/1": True, "./1": True, "0": True, "0/0": False, ".|.": False, None: False}),
        (GT.vaf_from_ad, {"60,60": 0.5, "90,10,5": 0.1, "0,0": None, "7": None, "x,1": None, None: None}),
        (
            GT.vaf_band,
            {
                "0": "artefact", "0.0999": "artefact", "0.1": "mosaic", "0.35": "heterozygous", "0.65": "skewed",
                "0.9": "homozygous", "1.0": "homozygous", "1.2": None, "NaN": None, "x": None, None: None,
            },
        ),
        (GT.dp_band, {"9": "too_low", "10": "borderline", "20": "adequate", "100": "adequate", "101": "high", "x": None}),
        (GT.gq_band, {"19": "uncertain", "20": "minimum", "29.9": "minimum", "30": "high_confidence", None: None}),
        (GT.pl_gap, {"0,60,900": 60, "100,0,95": 95, "0,0,0": 0, "5": None, "1,x,4": 3, None: None}),
        (lambda c: AN.fraction_part(c, 0), {"5/27": 5, "5-6/27": None, "x": None, None: None}),
        (lambda c: AN.fraction_part(c, 1), {"5/27": 27, "5": None, None: None}),
        (AN.variation_source, {"rs1": "dbSNP", "COSM1": "COSMIC", "RCV1": "ClinVar", "VCV1": "ClinVar", "x": "other", None: "novel"}),
        (lambda c: F.array_join(AN.variation_ids(c), " "), {"rs1,COSM2": "rs1 COSM2", "rs1&VCV2": "rs1 VCV2", None: None}),
        (lambda c: AN.worst_term(c)["term"], {"missense_variant&splice_donor_variant": "splice_donor_variant", "intron_variant & stop_lost": "stop_lost", "unknown": None, "unknown&intron_variant": "intron_variant", None: None}),
        (lambda c: AN.worst_term(c)["severity_rank"], {"transcript_ablation": 1, "intergenic_variant": 36}),
        (lambda c: AN.ladder_impact(AN.severity_rank(c)), {"regulatory_region_ablation": "MODERATE", "stop_gained": "HIGH", "unknown": None}),
        (GN.contig_label, {"chr1": "1", "chrX": "X", "7": "7"}),
    ],
)
def test_text_functions(spark, fn, cases):
    assert values(spark, fn, list(cases)) == list(cases.values())


def test_impact_label(spark):
    assert values(spark, AN.impact_label, [4, 3, 2, 1, 0, None], "int") == ["HIGH", "MODERATE", "LOW"] + ["MODIFIER"] * 3


def test_phred(spark):
    got = values(spark, GT.phred_error, ["10", "20", "30", "50", None])
    assert [g is None or round(g, 9) for g in got] == [0.1, 0.01, 0.001, 0.00001, True]


def test_variant_type(spark):
    cases = {("A", "G"): "SNV", ("A", "ATCG"): "INS", ("ATCG", "A"): "DEL", ("AT", "GC"): "MNV", ("A", "<DEL>"): None,
             ("A", "G,T"): None, ("A", "."): None, (None, "A"): None, ("A", "*"): None}
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(cases)], "i int, REF string, ALT string")
    assert [r[0] for r in df.orderBy("i").select(AN.variant_type()).collect()] == list(cases.values())


def test_density_and_log(spark):
    assert values(spark, lambda c: GN.density(c, F.lit(10), F.lit(4)), [2], "bigint") == [0.05]
    low, normal = values(spark, GN.log_density, [0.0, 1e-3], "double")
    assert math.isclose(low, -15) and math.isclose(normal, -3)


def test_labels(spark):
    df = spark.createDataFrame(
        [("chr1", 5, "A", "G", "S", 2), ("chr1", 5, "A", "G", "", 2), ("chr1", 5, "A", "G", None, 2)],
        "CHROM string, POS bigint, REF string, ALT string, SYMBOL string, bin_index int",
    )
    rows = df.select(GN.variant_label().alias("v"), GN.bin_label().alias("b"), GN.bin_name("CHROM", "SYMBOL", "bin_index").alias("n")).collect()
    assert [r["v"] for r in rows] == ["S  chr1:5  (A>G)", "Unknown  chr1:5  (A>G)", "Unknown  chr1:5  (A>G)"]
    assert (rows[0]["b"], rows[0]["n"]) == ("S[bin2]", "chr1_S_bin2")
