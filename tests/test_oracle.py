"""Every registered query against its SQL, on a small scale factor."""

import pytest

import __spark_entry__ as entry
from checks import oracles, queries
from checks.compare import compare, connect

QUERIES, ORACLES = queries.QUERIES, oracles.ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_oracle(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert compare(df, con, ORACLES[name]) is None
    plan = df._jdf.queryExecution().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert word not in plan


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["SYMBOL", "CHROM", "patient_count", "variant_count"]
    assert df.count() > 0
