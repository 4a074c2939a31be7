import math

import pytest

from rarecohort.operators import layout as L
from rarecohort.operators import report as R


def genes(spark, rows):
    return spark.createDataFrame(
        [(s, c, p, p + 9, d, i) for s, c, p, d, i in rows],
        "SYMBOL string, CHROM string, POS bigint, gene_end bigint, density double, worst_impact string",
    )


ROWS = [
    ("B", "chr2", 50, 1e-3, "HIGH"),
    ("A", "chr1", 30, 1e-4, "LOW"),
    ("C", "chr1", 10, 1e-3, "HIGH"),
    ("D", "chrX", 5, 1e-5, "MODIFIER"),
    ("U", "chrUn_1", 99, 0.0, "LOW"),
    ("E", "chr10", 7, 1e-2, "HIGH"),
]


def test_offsets_in_cytogenetic_order(spark):
    got = {r["CHROM"]: r["offset"] for r in L.chrom_offsets(genes(spark, ROWS), gap=100).collect()}
    assert got == {"chr1": 0, "chr2": 139, "chr10": 298, "chrX": 414}


def test_cum_pos(spark):
    g = genes(spark, ROWS)
    got = {r["SYMBOL"]: r["cum_pos"] for r in L.with_cum_pos(g, L.chrom_offsets(g, gap=100)).collect()}
    assert got == {"C": 10, "A": 30, "B": 189, "E": 305, "D": 419, "U": 99}


def test_rank_layout(spark):
    layout = L.rank_layout(genes(spark, ROWS), "POS", 1, ["SYMBOL"]).collect()
    # six rows in all: gap is max(4, 6 // 1)
    assert {r["SYMBOL"]: r["rank_x"] for r in layout} == {"C": 0, "A": 1, "B": 8, "E": 15, "D": 22}
    assert math.isclose({r["SYMBOL"]: r["log_density"] for r in layout}["B"], -3)


def test_smallest_gap(spark):
    layout = L.gene_rank_layout(genes(spark, ROWS)).collect()
    assert {r["SYMBOL"]: r["rank_x"] for r in layout} == {"C": 0, "A": 1, "B": 6, "E": 11, "D": 16}


def test_bands(spark):
    bands = L.chrom_bands(L.gene_rank_layout(genes(spark, ROWS))).collect()
    assert {r["label"]: (r["low"], r["high"], r["middle"]) for r in bands} == {
        "1": (0, 1, 0.5), "2": (6, 6, 6.0), "10": (11, 11, 11.0), "X": (16, 16, 16.0)
    }


def test_bubbles_and_levels(spark):
    sizes = {r["SYMBOL"]: r["bubble_size"] for r in L.bubble_genes(genes(spark, ROWS)).collect()}
    assert math.isclose(sizes["E"], 220) and math.isclose(sizes["B"], 58) and sizes["U"] == 40
    levels = [r["level"] for r in L.density_levels(genes(spark, ROWS)).orderBy("level_no").collect()]
    assert [round(x, 9) for x in levels] == [-12.4, -9.8, -7.2, -4.6, -2.0]


def test_bubbles_of_zero_density(spark):
    sizes = L.bubble_bins(genes(spark, [("A", "chr1", 1, 0.0, "LOW")])).collect()
    assert sizes[0]["bubble_size"] == 30


def test_top_breaks_ties_in_result_order(spark):
    got = [r["SYMBOL"] for r in R.top_genes(genes(spark, ROWS), 3).collect()]
    assert got == ["E", "C", "B"]


def test_sorted_as_text(spark):
    assert [r["SYMBOL"] for r in R.sorted_genes(genes(spark, ROWS)).collect()] == ["C", "A", "E", "B", "U", "D"]


def test_tally_has_all_labels(spark):
    tally = {r["worst_impact"]: r["n"] for r in R.impact_tally(genes(spark, ROWS[:3])).collect()}
    assert tally == {"HIGH": 2, "MODERATE": 0, "LOW": 1, "MODIFIER": 0}


def test_summary(spark):
    (r,) = R.density_summary(genes(spark, ROWS)).collect()
    assert r["n"] == 6 and r["max_density"] == 1e-2 and math.isclose(r["median_density"], 0.00055)


def test_consequence_breakdown(spark):
    df = spark.createDataFrame(
        [("a&b", "HIGH"), (" a ", "LOW"), ("b", "other"), ("c", None), (None, "HIGH"), ("a", "LOW")],
        "Consequence string, IMPACT string",
    )
    rows = [tuple(r) for r in R.consequence_breakdown(df).collect()]
    assert rows == [("a", 1, 0, 2, 0), ("b", 1, 0, 0, 0)]
    many = spark.range(30).selectExpr("concat('t', lpad(id, 2, '0')) AS Consequence", "'LOW' AS IMPACT")
    assert [r[0] for r in R.consequence_breakdown(many).collect()] == [f"t{i:02d}" for i in range(18)]


@pytest.mark.parametrize("values", [[], [3], [1, 1, 1, 1, 2], list(range(999, -1, -1)), [None, 5, None, 4]])
def test_global_rank_and_median(spark, values):
    """Ranks over partitions, ties and nulls included; the median read off them."""
    import statistics

    from pyspark.sql import functions as F

    from rarecohort.operators.ranks import global_rank

    df = spark.createDataFrame([(i, None if v is None else float(v)) for i, v in enumerate(values)], "id int, density double").repartition(5)
    rows = global_rank(df, [F.col("density").asc_nulls_last(), F.col("id")]).orderBy("rank").collect()
    known = sorted((v, i) for i, v in enumerate(values) if v is not None)
    nulls = [i for i, v in enumerate(values) if v is None]
    assert [(r["rank"], r["id"]) for r in rows] == list(enumerate([i for _, i in known] + nulls))
    summary = R.density_summary(df).first()
    assert summary["n"] == len(values)
    assert summary["median_density"] == (statistics.median(v for v, _ in known) if known else None)
