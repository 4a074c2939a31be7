"""What the physical plans must look like to hold at scale."""

import contextlib
import io
import re

import pytest

from rarecohort.operators import bins as B
from rarecohort.operators import genes as G
from rarecohort.plans.analysis import gene_table, variant_table
from rarecohort.sources.cohort import read_cohort, write_parsed
from rarecohort.sources.staging import stage


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture(scope="module")
def cohort(spark, sf_dir, tmp_path_factory):
    from checks import fixtures as X
    from rarecohort.sources.cohort import conform

    path = str(tmp_path_factory.mktemp("cohort") / "parsed")
    write_parsed(conform(X.variants(spark, sf_dir)), path)
    return read_cohort(spark, path)


@pytest.mark.parametrize("table", [gene_table, variant_table, G.observations])
def test_scans_read_few_columns(cohort, table):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", plan(table(cohort, 0.01)))
    assert schemas
    for s in schemas:
        columns = {c.split(":")[0] for c in s.split(",") if c}
        assert columns <= {"CHROM", "POS", "REF", "ALT", "GT", "SYMBOL", "IMPACT", "Consequence", "Gene", "gnomADg_AF"}


def test_filters_reach_the_scan(cohort):
    pushed = re.findall(r"PushedFilters: \[(.*?)\]\n", plan(gene_table(cohort, 0.01)))
    assert any("IsNotNull(GT)" in p and "Not(In(GT" in p and "IsNotNull(SYMBOL)" in p for p in pushed)


def test_patient_filter_prunes_partitions(cohort):
    text = plan(gene_table(cohort.filter("Patient_ID = 'PATIENT_00001'"), 0.01))
    assert re.search(r"PartitionFilters: \[.*PATIENT_00001", text)


def test_gene_bounds_join(spark, cohort):
    """Few genes are broadcast; many shuffle on a key that a hot gene does not own."""
    obs = stage(G.observations(cohort, 0.01), "observations")
    bounds = stage(G.gene_bounds(G.gene_variants(obs)), "bounds")
    few = B.join_gene_bounds(obs, bounds, broadcast=True)
    assert "BroadcastHashJoin" in plan(few)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = B.join_gene_bounds(obs, bounds, broadcast=False)
        assert sorted(map(str, many.collect())) == sorted(map(str, few.collect()))
        text = plan(B.bin_counts(many, 10))
        assert "SortMergeJoin" in text and "Broadcast" not in text
        # the join's partitioning is not carried into the groupings: each has its own exchange
        assert len(re.findall(r"Arguments: hashpartitioning\(Patient_ID", text)) == 1
        assert len(re.findall(r"Arguments: hashpartitioning\(SYMBOL[^,]*, CHROM[^,]*, salt", text)) == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
