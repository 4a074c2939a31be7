"""Writing of large cohorts, which are shuffled a part at a time."""

import glob
import os

import pytest

from rarecohort.model import COLUMNS
from rarecohort.sources import cohort as C
from rarecohort.sources import staging as S
from tests.test_many_patients import PATIENTS, scattered


def shuffle_files(spark):
    return spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()


@pytest.mark.parametrize("numbers", [False, True])
def test_large_cohorts_are_shuffled_in_passes(spark, tmp_path, monkeypatch, numbers):
    monkeypatch.setattr(C, "DIRECT_BYTES", 0)
    monkeypatch.setattr(C, "PASS_BYTES", 1)
    monkeypatch.setattr(C, "WRITE_PARTS", 4)
    staged, passes, stage_parts, real = [], [], C.stage_parts, C._passes
    monkeypatch.setattr(C, "stage_parts", lambda *a: staged.append(stage_parts(*a)) or staged[-1])
    monkeypatch.setattr(C, "_passes", lambda parts: passes.extend(real(parts)) or passes)
    table = S.stage(scattered(spark).unionAll(C.conform(spark.sql("SELECT CAST(NULL AS STRING) AS Patient_ID, 1 AS POS"))), "rows")
    files = shuffle_files(spark)
    C.write_parsed(table, str(tmp_path / "t"), numbers=numbers)
    assert shuffle_files(spark) <= files
    folders = glob.glob(str(tmp_path / "t" / "Patient_ID=*"))
    assert len(folders) == PATIENTS + 2 and all(len(glob.glob(f"{f}/*.parquet")) == 1 for f in folders)
    assert os.path.exists(tmp_path / "t" / "_SUCCESS")
    back = C.read_cohort(spark, str(tmp_path / "t")).select(*COLUMNS)
    assert back.exceptAll(table).count() == table.exceptAll(back).count() == 0
    assert passes == [[0], [1], [2], [3]] and not glob.glob(f"{staged[0].path.removeprefix('file:')}/part=*")


def test_modes_hold_in_passes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(C, "DIRECT_BYTES", 0)
    monkeypatch.setattr(C, "PASS_BYTES", 1)
    monkeypatch.setattr(C, "WRITE_PARTS", 2)
    path = str(tmp_path / "t")
    table = C.conform(spark.range(100).selectExpr("concat('P', id % 20) AS Patient_ID", "id AS POS"))
    for mode, rows in [("errorifexists", 100), ("append", 200), ("ignore", 200), ("overwrite", 100)]:
        C.write_parsed(table, path, mode=mode)
        assert C.read_cohort(spark, path).count() == rows
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        C.write_parsed(table, path)
    C.write_parsed(table.limit(0), path, mode="append")
    assert C.read_cohort(spark, path).count() == 100


def test_small_cohorts_leave_no_shuffle_files(spark, tmp_path):
    files = shuffle_files(spark)
    C.write_parsed(scattered(spark), str(tmp_path / "t"))
    assert shuffle_files(spark) <= files
