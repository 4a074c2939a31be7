"""Cohorts of many small patients: files, tasks and calls that grow with the patients only."""

import glob

import pytest

from checks import fixtures as X
from checks import queries as Q
from rarecohort.sources import increment as I
from rarecohort.sources import vcf
from rarecohort.sources.cohort import conform, read_cohort, write_parsed
from tests.test_vcf import FIELDS, header, record, write

PATIENTS = 40


def scattered(spark):
    """Each of 8 tasks holds rows of all patients; one has most rows."""
    small = spark.range(0, 4000, 1, 8).selectExpr(f"concat('P', id % {PATIENTS}) AS Patient_ID", "'1' AS CHROM", "id AS POS", "uuid() AS Gene")
    large = spark.range(0, 40_000, 1, 8).selectExpr("'LARGE' AS Patient_ID", "'1' AS CHROM", "id AS POS", "uuid() AS Gene")
    return conform(small.unionAll(large).repartition(8))


@pytest.mark.parametrize("numbers", [False, True])
def test_a_patient_is_one_file(spark, tmp_path, numbers):
    write_parsed(scattered(spark), str(tmp_path / "t"), numbers=numbers)
    folders = glob.glob(str(tmp_path / "t" / "Patient_ID=*"))
    assert len(folders) == PATIENTS + 1
    assert all(len(glob.glob(f"{f}/*.parquet")) == 1 for f in folders)
    assert read_cohort(spark, str(tmp_path / "t")).count() == 44_000


def test_a_large_patient_is_written_by_many_tasks(spark, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300kb")
    try:
        write_parsed(scattered(spark), str(tmp_path / "t"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {f: len(glob.glob(f"{f}/*.parquet")) for f in glob.glob(str(tmp_path / "t" / "Patient_ID=*"))}
    assert files.pop(str(tmp_path / "t" / "Patient_ID=LARGE")) > 2
    assert sum(files.values()) < 2 * PATIENTS
    assert read_cohort(spark, str(tmp_path / "t")).select("POS", "Patient_ID").distinct().count() == 44_000


def test_tasks_that_follow_patients_are_not_shuffled(spark, tmp_path):
    write_parsed(scattered(spark), str(tmp_path / "t"), by_patient=True)
    assert len(glob.glob(str(tmp_path / "t" / "Patient_ID=P1" / "*.parquet"))) == 8


def test_roundtrip_query_writes_a_file_per_patient(spark, sf_dir, monkeypatch):
    folders = []
    monkeypatch.setattr(Q, "read_cohort", lambda s, folder: folders.append(folder) or read_cohort(s, folder))
    Q.parsed_roundtrip(spark, sf_dir)
    found = glob.glob(f"{folders[0].removeprefix('file:')}/Patient_ID=*")
    assert found and all(len(glob.glob(f"{f}/*.parquet")) == 1 for f in found)


def test_vcf_files_lie_alone(spark, sf_dir):
    """Nothing else is below the folder, which each scan would list."""
    folder = X.vcf_files(spark, sf_dir).removeprefix("file:")
    patients = X.header_lines(spark, sf_dir).count()
    assert len(glob.glob(f"{folder}/*.vcf")) == patients == len(glob.glob(f"{folder}/*"))


@pytest.mark.parametrize("small", [vcf.SMALL_FILE, 400, 0])
def test_heads_of_small_files_share_tasks(spark, tmp_path, monkeypatch, small):
    monkeypatch.setattr(vcf, "SMALL_FILE", small)
    for i in range(60):
        rest = [record(POS=str(k)) for k in range(1 + 200 * (i % 10 == 0))]
        write(tmp_path, f"p{i}.vcf", [header(FIELDS), f"##n={i}", *rest, header(FIELDS[::-1])])
    heads = vcf.vcf_heads(spark, str(tmp_path))
    assert {(r["Patient_ID"], r["value"]) for r in heads.collect()} == {(f"p{i}", v) for i in range(60) for v in (header(FIELDS), f"##n={i}")}
    assert heads.count() == 120
    if small == vcf.SMALL_FILE > 1000:
        assert len(heads.inputFiles()) < 60


def test_update_asks_for_names_once(spark, tmp_path, monkeypatch):
    """One listing before and one after, not calls for each patient."""
    (tmp_path / "vcf").mkdir()
    for i in range(30):
        write(tmp_path / "vcf", f"p{i}.vcf", [header(FIELDS), record()])
    calls, real = [], I.file_system
    monkeypatch.setattr(I, "file_system", lambda *a: calls.append(a) or real(*a))
    assert I.update_parsed(spark, str(tmp_path / "vcf"), str(tmp_path / "parsed"), str(tmp_path / "manifest")) == I.Update(30, 30, 0)
    assert len(calls) < 10
