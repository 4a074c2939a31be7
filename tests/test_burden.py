"""The sparse burden matrix against the long table."""

import random

import pytest
from pyspark.sql import functions as F

from rarecohort.operators import burden as BU
from rarecohort.operators import genes as G
from rarecohort.sources.staging import stage
from tests.test_plans import plan

SCHEMA = "Patient_ID string, CHROM string, POS long, REF string, ALT string, Gene string"


def calls(spark, n=3000, patients=300):
    rng = random.Random(4)
    rows = [(f"P{rng.randrange(patients):04d}", "1", rng.randrange(40), "A", "G", f"E{rng.randrange(5)}") for _ in range(n)]
    rows += [(f"P{i:04d}", "1", 99, "A", "G", "HOT") for i in range(patients)]
    rows += [("P0001", "1", 5, "A", "G", None), (None, "1", 5, "A", "G", "E1"), ("Q", "1", 5, "A", "G", None)] + rows[:50]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("limit", [BU.MAX_BROADCAST_PATIENTS, 0])
@pytest.mark.parametrize("block", [1, 7, 4096])
def test_equals_the_long_table(spark, monkeypatch, block, limit):
    monkeypatch.setattr(BU, "MAX_BROADCAST_PATIENTS", limit)
    df = calls(spark)
    index = stage(BU.patient_index(df), "index")
    ids = [r["Patient_ID"] for r in index.orderBy("patient_index").collect()]
    assert ids == sorted({r["Patient_ID"] for r in df.collect()} - {None}) and ids[-1] == "Q"
    want = {tuple(r) for r in G.burden_long(df).filter("Patient_ID IS NOT NULL").collect()}
    sparse = stage(BU.burden_sparse(df, index, block=block), "sparse")
    assert sparse.agg(F.max(F.size("patients"))).first()[0] <= block
    assert {tuple(r) for r in BU.burden_rows(sparse, index).collect()} == want
    cells = {}
    for r in BU.burden_blocks(sparse, len(ids), block=block).collect():
        for k, c in enumerate(r["counts"]):
            cells[r["Gene"], ids[r["block"] * block + k]] = c
    dense = {(g, p): 0 for g in {w[0] for w in want} for p in ids} | {w[:2]: w[2] for w in want}
    assert cells == dense


def test_many_patients(spark):
    """A gene that 100,000 patients carry is many rows of one block each."""
    n = 100_000
    df = spark.range(n).select(
        F.concat(F.lit("P"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("Patient_ID"),
        F.lit("1").alias("CHROM"), (F.col("id") % 50).alias("POS"), F.lit("A").alias("REF"), F.lit("G").alias("ALT"),
        F.explode(F.array(F.lit("HOT"), F.concat(F.lit("E"), (F.col("id") % 1000).cast("string")))).alias("Gene"),
    )
    index = stage(BU.patient_index(df), "index")
    sparse = stage(BU.burden_sparse(df, index), "sparse")
    assert sparse.filter("Gene = 'HOT'").count() == -(-n // BU.BLOCK) and sparse.agg(F.max(F.size("patients"))).first()[0] == BU.BLOCK
    rows = BU.burden_rows(sparse, index)
    assert rows.exceptAll(G.burden_long(df)).count() == 0 and rows.count() == 2 * n
    dense = BU.burden_blocks(sparse.filter("Gene in ('HOT', 'E7')"), n)
    assert dense.select(F.sum(F.size("counts")), F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c))).first() == (2 * n, n + 100)


def test_empty(spark):
    df = calls(spark).limit(0)
    index = stage(BU.patient_index(df), "index")
    sparse = BU.burden_sparse(df, index)
    assert sparse.count() == 0 and BU.burden_blocks(sparse, 0).count() == 0
    assert "Python" not in plan(sparse)
