"""Number columns beside text: equal rows, pushed filters, fewer rows scanned."""

import re

import pytest

from rarecohort.model import COLUMNS, shadow
from rarecohort.operators import filters as FL
from rarecohort.operators import genes as G
from rarecohort.sources.cohort import conform, read_cohort, with_numbers, write_parsed
from tests.test_plans import plan

TEXTS = [None, "", ".", "0.5", "1e-3", "NaN", "Infinity", "-1", "0.001&0.02", "10", "20.0", "0.2", "0.01", " 7 "]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = [
        dict.fromkeys(COLUMNS) | {"Patient_ID": f"P{i % 2}", "CHROM": "1", "POS": i, "REF": "A", "ALT": "G", "SYMBOL": "S", "GT": "0/1", "FILTER": "PASS",
        "gnomADg_AF": TEXTS[i % len(TEXTS)], "DP": TEXTS[i // 14 % 14], "GQ": TEXTS[i // 5 % 14], "VAF": TEXTS[i // 3 % 14]}
        for i in range(14 * 14 * 3)
    ]
    df = conform(spark.createDataFrame([tuple(r[c] if c == "POS" or r[c] is None else str(r[c]) for c in COLUMNS) for r in rows], ", ".join(f"{c} {'long' if c == 'POS' else 'string'}" for c in COLUMNS)))
    path = str(tmp_path_factory.mktemp("numbers") / "t")
    write_parsed(df, path, numbers=True)
    return path


CASES = [
    lambda df: FL.rare(df, 0.01), lambda df: FL.rarity(df, 0.01), lambda df: FL.rarity(df, 1e9), lambda df: FL.technical_filter(df, 10, 5, 0.2),
    lambda df: FL.technical_filter(df, 0, -5, 0), lambda df: G.observations(df, 0.01),
    lambda df: FL.filter_cascade(df, [s for s in FL.cascade_steps(0.01, typed=shadow("DP") in df.columns) if s[0] in ("technical", "rarity")]),
]


@pytest.mark.parametrize("case", CASES)
def test_same_rows_with_and_without(spark, folder, case):
    df = read_cohort(spark, folder)
    plain = df.drop(*[c for c in df.columns if c.endswith("__number")])
    assert shadow("gnomADg_AF") in df.columns and plain.columns == COLUMNS
    got = sorted(map(str, case(df).select(*case(plain).columns).collect()))
    assert got == sorted(map(str, case(plain).collect())) and got


def test_filters_reach_the_scan(spark, folder):
    df = read_cohort(spark, folder)
    pushed = re.findall(r"PushedFilters: \[(.*?)\]\n", plan(FL.rarity(FL.technical_filter(df), 0.01)))[0]
    for text in ("GreaterThanOrEqual(DP__number,10.0)", "GreaterThanOrEqual(VAF__number,0.2)", "LessThan(gnomADg_AF__number,0.01)"):
        assert text in pushed
    scan = re.findall(r"ReadSchema: struct<(.*?)>", plan(G.gene_calls(df, 0.01)))[0]
    assert "gnomADg_AF__number:double" in scan and "gnomADg_AF:string" not in scan


def test_row_groups_are_skipped(spark, tmp_path):
    """Frequencies that rise along a contig: the scan leaves out row groups above the limit."""
    df = conform(spark.range(20_000).selectExpr("'P' AS Patient_ID", "'1' AS CHROM", "id AS POS", "CAST(id / 20000 AS STRING) AS gnomADg_AF", "uuid() AS Gene"))
    write_parsed(df.repartition(7).coalesce(1), str(tmp_path / "t"), numbers=True, row_group_bytes=64 << 10)
    table = read_cohort(spark, str(tmp_path / "t"))

    def scanned(out):
        rows = out.collect()
        text = out._jdf.queryExecution().executedPlan()
        leaves = text.collectLeaves()
        return len(rows), sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))

    n, read = scanned(FL.rare(table, 0.1))
    assert n == 2001 and read < 10_000
    plain = table.drop(*[c for c in table.columns if c.endswith("__number")])
    assert scanned(FL.rare(plain, 0.1)) == (2001, 20_000)
    assert with_numbers(plain.select("POS")).columns == ["POS"]
