"""Variant rows and VCF lines derived from the ``lineitem`` table.

``COLUMNS_SQL`` is plain SQL that Spark and DuckDB read alike.  One lineitem
row gives ``l_linenumber % 3 + 1`` transcript rows, numbered by ``k``.
"""

from __future__ import annotations

import re
import uuid
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rarecohort.model import CSQ_COLUMNS, FORMAT_COLUMNS
from rarecohort.sources.staging import file_system, shared_folder, short_listing, shuffles_removed, stage

COLUMNS_SQL = {
    "Patient_ID": "concat('PATIENT_', lpad(CAST(l_suppkey AS STRING), 5, '0'))",
    "CHROM": """CASE (l_partkey % 200) % 25
        WHEN 22 THEN 'chrX' WHEN 23 THEN 'chrY' WHEN 24 THEN 'chrUn_KI270302v1'
        ELSE concat('chr', CAST((l_partkey % 200) % 25 + 1 AS STRING)) END""",
    "POS": "CAST((l_partkey % 200) * 1000000 + (l_partkey * 104729) % 5000000 + 1 AS BIGINT)",
    "ID": "CASE WHEN l_partkey % 3 = 0 THEN concat('rs', CAST(l_partkey + 100000 AS STRING)) END",
    "REF": """concat(substr('ACGT', CAST(l_partkey % 4 + 1 AS INT), 1),
        CASE l_partkey % 9 WHEN 1 THEN 'GT' WHEN 4 THEN 'T' ELSE '' END)""",
    "ALT": """CASE WHEN l_partkey % 97 = 0 THEN '<DEL>'
        ELSE concat(substr('ACGT', CAST((l_partkey + 1 + l_linenumber % 2) % 4 + 1 AS INT), 1),
          CASE l_partkey % 9 WHEN 2 THEN 'CA' WHEN 4 THEN 'G' ELSE '' END) END""",
    "QUAL": "CASE WHEN l_orderkey % 13 <> 0 THEN concat(CAST(l_orderkey % 60 AS STRING), '.5') END",
    "FILTER": "CASE l_returnflag WHEN 'N' THEN 'PASS' WHEN 'A' THEN 'RefCall' ELSE 'LowQual' END",
    "Consequence": """CASE (l_partkey + 3 * k) % 7
        WHEN 1 THEN 'intron_variant' WHEN 2 THEN 'synonymous_variant'
        WHEN 3 THEN 'missense_variant' WHEN 4 THEN 'stop_gained'
        WHEN 5 THEN 'missense_variant&splice_region_variant'
        WHEN 6 THEN 'splice_region_variant&intron_variant' END""",
    "IMPACT": """CASE (l_partkey + 3 * k) % 7
        WHEN 1 THEN 'MODIFIER' WHEN 2 THEN 'LOW' WHEN 3 THEN 'MODERATE'
        WHEN 4 THEN 'HIGH' WHEN 5 THEN 'MODERATE' WHEN 6 THEN 'LOW' END""",
    "SYMBOL": """CASE WHEN l_partkey % 17 = 0 AND k <> 1 THEN NULL WHEN l_partkey % 31 = 0 AND k = 0 THEN ''
        ELSE concat('GENE', CAST(l_partkey % 200 + CASE WHEN k = 2 THEN 25 ELSE 0 END AS STRING)) END""",
    "Gene": "concat('ENSG', lpad(CAST(l_partkey % 200 AS STRING), 11, '0'))",
    "Feature": "concat('ENST', lpad(CAST((l_partkey % 200) * 10 + k AS STRING), 11, '0'))",
    "BIOTYPE": """CASE WHEN k = 1 THEN 'retained_intron' WHEN l_partkey % 19 = 0 THEN 'processed_pseudogene'
        ELSE 'protein_coding' END""",
    "EXON": """CASE WHEN (l_partkey + 3 * k) % 7 IN (2, 3, 4, 5)
        THEN concat(CAST(l_partkey % 9 + 1 AS STRING), '/', CAST(l_partkey % 9 + 5 AS STRING)) END""",
    "Existing_variation": """CASE l_partkey % 5 WHEN 0 THEN 'rs11' WHEN 1 THEN 'rs12' WHEN 2 THEN 'COSM6,RCV7'
        WHEN 3 THEN 'rs13,COSM8,VCV9' END""",
    "FLAGS": "CASE WHEN l_partkey % 23 = 0 THEN 'cds_start_NF' END",
    "gnomADg_AF": """CASE WHEN l_partkey % 7 = 0 THEN NULL WHEN l_partkey % 11 = 0 THEN '0.001&0.02'
        ELSE concat('0.0', lpad(CAST(l_partkey * 13 % 200 AS STRING), 3, '0')) END""",
    "gnomADg_AF_nfe": """CASE WHEN l_partkey % 5 = 0 THEN NULL
        ELSE concat('0.0', lpad(CAST(l_partkey * 29 % 300 AS STRING), 3, '0')) END""",
    "GT": """CASE l_orderkey % 12
        WHEN 0 THEN '0/0' WHEN 1 THEN '0/0' WHEN 2 THEN '0|0' WHEN 3 THEN './.' WHEN 4 THEN '.|.'
        WHEN 5 THEN '0|1' WHEN 6 THEN '0/1' WHEN 7 THEN '0/1' WHEN 8 THEN '1/1' WHEN 9 THEN '1/2'
        WHEN 10 THEN './1' END""",
    "GQ": "CASE WHEN l_orderkey % 29 <> 0 THEN CAST(l_orderkey % 99 AS STRING) END",
    "DP": "CAST(l_orderkey % 60 + 1 AS STRING)",
    "AD": """concat(CAST(l_orderkey % 60 + 1 - (l_orderkey * 7 + l_linenumber) % (l_orderkey % 60 + 2) AS STRING),
        ',', CAST((l_orderkey * 7 + l_linenumber) % (l_orderkey % 60 + 2) AS STRING))""",
    "VAF": "concat('0.', lpad(CAST((l_orderkey * 7 + l_linenumber) % 100 AS STRING), 2, '0'))",
    "PL": "concat('0,', CAST(l_orderkey % 500 AS STRING), ',', CAST(l_orderkey % 900 AS STRING))",
}

#: The variant table as one DuckDB query.
VARIANTS_SQL = (
    "SELECT "
    + ", ".join(f"{sql} AS {name}" for name, sql in COLUMNS_SQL.items())
    + " FROM lineitem CROSS JOIN (VALUES (0), (1), (2)) AS t(k) WHERE k <= l_linenumber % 3"
)


def read_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five columns in use.

    A file with fewer row groups than there are cores would be read by few
    tasks; only then these narrow rows are spread before they are widened.
    """
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag"
    )
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores, "l_orderkey", "l_linenumber") if df.rdd.getNumPartitions() < cores else df


#: Columns that differ between the transcripts of a variant.
PER_TRANSCRIPT = ["Consequence", "IMPACT", "SYMBOL", "Feature", "BIOTYPE", "EXON"]


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant table as a DataFrame.

    What is the same for all transcripts is computed before they fan out.
    """
    shared = [c for c in COLUMNS_SQL if c not in PER_TRANSCRIPT]
    return (
        read_lineitem(spark, sf_dir)
        .select("l_partkey", "l_linenumber", *[F.expr(COLUMNS_SQL[c]).alias(c) for c in shared])
        .withColumn("k", F.explode(F.sequence(F.lit(0), (F.col("l_linenumber") % 3).cast("int"))))
        .select(*[F.expr(sql).alias(c) if c in PER_TRANSCRIPT else F.col(c) for c, sql in COLUMNS_SQL.items()])
    )


# --- VCF text ------------------------------------------------------------------
#: Two header layouts: patients with an even number list the fields backwards,
#: and have one field that is off the list.
FORWARD = list(CSQ_COLUMNS)
BACKWARD = [*reversed(CSQ_COLUMNS), "CANONICAL"]
PATIENT_NO = "CAST(substr(Patient_ID, 9) AS BIGINT)"


def _header() -> Column:
    """The header line of a row's patient."""
    text = F.when(F.expr(f"{PATIENT_NO} % 2 = 0"), "|".join(BACKWARD)).otherwise("|".join(FORWARD))
    start = F.lit('##INFO=<ID=CSQ,Number=.,Type=String,Description="Consequence annotations. Format: ')
    return F.concat(start, text, F.lit('">'))


def _with_patient(rows: DataFrame) -> DataFrame:
    return rows.withColumn("Patient_ID", F.expr(COLUMNS_SQL["Patient_ID"]))


def header_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header line of every patient, by Patient_ID and value."""
    patients = _with_patient(read_lineitem(spark, sf_dir)).select("Patient_ID").distinct()
    return patients.select("Patient_ID", _header().alias("value"))


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One VCF record per lineitem row, by Patient_ID and value."""
    return _records(_with_patient(read_lineitem(spark, sf_dir)))


def _records(rows: DataFrame, *keep: str) -> DataFrame:
    """One VCF record per row, with its transcripts in CSQ, behind the columns to keep.

    The transcripts of a row are an array in the row itself, so nothing is
    grouped.  Several known-variant ids are joined by ``&``, as a comma ends a
    transcript.
    """
    shared = [c for c in COLUMNS_SQL if c not in [*PER_TRANSCRIPT, "Patient_ID"]]

    def value(name: str) -> str:
        if name == "Existing_variation":
            return "replace(Existing_variation, ',', '&')"
        return COLUMNS_SQL[name] if name in PER_TRANSCRIPT else "'YES'" if name == "CANONICAL" else name

    def line(names: list[str]) -> str:
        filled = [n for n in names if n in COLUMNS_SQL or n == "CANONICAL"]
        text = "|".join(f"{{{n}}}" if n in filled else "" for n in names)
        parts = re.split(r"\{(\w+)\}", text)  # text and names in turn
        return "concat(" + ", ".join(f"coalesce({value(p)}, '')" if i % 2 else f"'{p}'" for i, p in enumerate(parts)) + ")"

    transcripts = F.expr(
        "transform(sequence(0, CAST(l_linenumber % 3 AS INT)), "
        f"k -> CASE WHEN {PATIENT_NO} % 2 = 0 THEN {line(BACKWARD)} ELSE {line(FORWARD)} END)"
    )
    fields = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "info", "format", "sample"]
    sample = [*FORMAT_COLUMNS, "MIN_DP"]
    return (
        rows.select(
            *keep,
            "Patient_ID",
            "l_partkey",
            "l_linenumber",
            (F.col("l_orderkey") % 50).alias("MIN_DP"),
            *[F.expr(COLUMNS_SQL[c]).alias(c) for c in shared],
        )
        .withColumns(
            {
                "info": F.concat(F.lit("AC=1;CSQ="), F.array_join(transcripts, ","), F.lit(";DB")),
                "format": F.lit(":".join(sample)),
                "sample": F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in sample]),
            }
        )
        .select(
            *keep,
            "Patient_ID",
            F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit(".")) for c in fields]).alias("value"),
        )
    )


def vcf_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and record lines of all patients, written once as text would be."""
    return stage(header_lines(spark, sf_dir).unionByName(record_lines(spark, sf_dir)), "vcf_text")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def vcf_files(spark: SparkSession, sf_dir: str, where: str = "true") -> str:
    """A folder with one ``.vcf`` file per patient of a condition, header first.

    Spark names its files itself, so they are renamed, out of a folder beside; a patient is one file and so one task.
    The five columns are shuffled, and made to text behind that.
    """
    folder, parts = new_folder(spark, "vcf_files"), new_folder(spark, "vcf_parts")
    rows = _with_patient(read_lineitem(spark, sf_dir)).withColumn("k", F.lit(1)).filter(where)
    heads = rows.select("Patient_ID").distinct().withColumn("k", F.lit(0))
    rows = heads.unionByName(rows, allowMissingColumns=True).repartition("Patient_ID").sortWithinPartitions("Patient_ID", "k")
    lines = _records(rows, "k").select("Patient_ID", F.when(F.col("k") == 0, _header()).otherwise(F.col("value")).alias("value"))
    with shuffles_removed(spark):
        lines.write.partitionBy("Patient_ID").text(parts)
    with short_listing(spark):
        written = spark.read.format("binaryFile").load(parts).select("path").collect()
    system, target = file_system(spark, folder)
    system.mkdirs(target)
    path = spark._jvm.org.apache.hadoop.fs.Path

    def rename(row) -> None:
        patient = row["path"].split("/")[-2].partition("=")[2]
        if not system.rename(path(row["path"]), path(f"{folder}/{patient}.vcf")):
            raise OSError(f"cannot rename {row['path']}")

    with ThreadPool(16) as pool:
        pool.map(rename, written)
    return folder


def mixed_folder(spark: SparkSession, sf_dir: str, parts: int = 3, folder: str | None = None, done: int = 0) -> str:
    """A cohort folder whose files differ: text and numbers, an absent column, one that is null and of another type.

    Of the three parts, those from ``done`` to ``parts`` are written.
    """
    folder = folder or new_folder(spark, "mixed")
    v = variants(spark, sf_dir)
    numbers = {"GQ": F.col("GQ").cast("bigint"), "QUAL": F.col("QUAL").cast("double")}
    shapes = [
        lambda df: df.withColumn("POS", F.col("POS").cast("string")),
        lambda df: df.drop("FLAGS", "gnomADg_AF_nfe").withColumns(numbers),
        lambda df: df.withColumns({"FLAGS": F.lit(None).cast("int")}),
    ]
    for i, shape in list(enumerate(shapes))[done:parts]:
        shape(v.filter(F.expr(f"{PATIENT_NO} % 3 = {i}"))).write.mode("append").parquet(folder)
    return folder
