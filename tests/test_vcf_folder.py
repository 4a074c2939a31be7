"""Files of a cohort, made from the given tables."""

from pyspark.sql import functions as F

from checks import fixtures as X
from rarecohort.sources import vcf as V
from tests.test_passes import shuffle_files
from tests.test_plans import plan


def test_files_of_a_cohort_are_made_from_narrow_shuffled_rows(spark, sf_dir, monkeypatch):
    plans, real = [], X._records
    monkeypatch.setattr(X, "_records", lambda rows, *keep: plans.append(plan(rows)) or real(rows, *keep))
    files = shuffle_files(spark)
    folder = X.vcf_files(spark, sf_dir)
    assert "hashpartitioning(Patient_ID" in plans[0] and shuffle_files(spark) <= files + 20
    found = spark.read.text(folder).select(F.left(F.col("_metadata.file_name"), F.lit(13)).alias("Patient_ID"), "value")
    made = X.header_lines(spark, sf_dir).unionByName(X.record_lines(spark, sf_dir).select("Patient_ID", "value"))
    name = F.left("Patient_ID", F.lit(13))
    assert found.withColumn("Patient_ID", name).exceptAll(made.withColumn("Patient_ID", name)).count() == 0
    assert found.count() == made.count()


def test_numbers_of_patients_that_are_cut(spark, tmp_path):
    """A supplier above 99,999 is a patient of the first five digits: its records have the layout of that one's header."""
    rows = spark.range(30).selectExpr("id AS l_orderkey", "id + 3 AS l_partkey", "100000 + id % 12 AS l_suppkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber", "'N' AS l_returnflag")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    columns = ["Patient_ID", "CHROM", "POS", "Gene", "Feature", "IMPACT"]
    parsed, made = (t.select(*columns) for t in (V.parse_lines(X.vcf_text(spark, str(tmp_path))), X.variants(spark, str(tmp_path))))
    assert parsed.exceptAll(made).count() == made.exceptAll(parsed).count() == 0
    assert parsed.count() > 30
