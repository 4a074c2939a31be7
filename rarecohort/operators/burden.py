"""Gene burden as a sparse matrix: one row per gene and block of patients.

A matrix with a column per patient ends where the planner does.  Here patients
are numbered, and a row holds the numbers and counts of at most ``block``
patients, so that neither a gene that everyone carries nor a large cohort
makes a row or a task large, and no list of patients reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarecohort.operators.genes import burden_long
from rarecohort.operators.ranks import global_rank

#: Patients of a block.
BLOCK = 4096
#: Numbered patients (some 100 bytes each in a hash table) that are broadcast; more are joined by a shuffle.
MAX_BROADCAST_PATIENTS = 500_000


def patient_index(cohort: DataFrame) -> DataFrame:
    """Patient_ID and patient_index, 0, 1, .. in the order of the ids; a null is no patient."""
    ids = cohort.select("Patient_ID").filter("Patient_ID IS NOT NULL").distinct()
    return global_rank(ids, [F.col("Patient_ID")], "patient_index")


def _join_index(df: DataFrame, index: DataFrame, key: str) -> DataFrame:
    few = index.count() <= MAX_BROADCAST_PATIENTS
    return df.join(F.broadcast(index) if few else index, key)


def burden_sparse(df: DataFrame, index: DataFrame, gene_col: str = "Gene", block: int = BLOCK) -> DataFrame:
    """gene, block, patient indices (ascending) and their counts of distinct qualifying variants.

    ``index`` comes from :func:`patient_index`, over the whole cohort, and should be staged.
    Patient ``i`` is in block ``i / block``; blocks of a gene without carriers have no row.
    Rows without a patient or gene are left out.
    """
    rows = _join_index(burden_long(df, gene_col), index, "Patient_ID")
    at = F.sort_array(F.collect_list(F.struct("patient_index", "variant_count")))
    return (
        rows.groupBy(gene_col, F.floor(F.col("patient_index") / block).alias("block"))
        .agg(at.alias("x"))
        .select(gene_col, "block", F.col("x.patient_index").alias("patients"), F.col("x.variant_count").alias("counts"))
    )


def burden_rows(sparse: DataFrame, index: DataFrame, gene_col: str = "Gene") -> DataFrame:
    """The matrix as gene, Patient_ID and variant_count again, without zeros."""
    pairs = sparse.select(gene_col, F.inline(F.arrays_zip("patients", "counts")))
    named = _join_index(pairs.withColumnRenamed("patients", "patient_index"), index, "patient_index")
    return named.select(gene_col, "Patient_ID", F.col("counts").alias("variant_count"))


def burden_blocks(sparse: DataFrame, n_patients: int, gene_col: str = "Gene", block: int = BLOCK) -> DataFrame:
    """Dense rows: gene, block and ``counts`` of all patients of the block, zeros included.

    Every gene of ``sparse`` gets all blocks.  The gaps between the patients of a row are
    filled in one pass over it.
    """
    last = max(0, -(-n_patients // block) - 1)
    genes = sparse.select(gene_col).distinct().select(gene_col, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint"))).alias("block"))
    rows = genes.join(sparse, [gene_col, "block"], "left")
    start = F.col("block") * block
    width = F.least(F.lit(block).cast("bigint"), F.lit(n_patients).cast("bigint") - start)
    zero = F.lit(0).cast("bigint")
    patients = F.coalesce("patients", F.array().cast("array<bigint>"))

    def piece(i, k):
        """Zeros up to a patient, and its count."""
        before = F.when(k == 0, start - 1).otherwise(F.get("patients", k - 1))
        return F.concat(F.array_repeat(zero, (i - before - 1).cast("int")), F.array(F.get("counts", k)))

    done = F.coalesce(F.get("patients", F.size("patients") - 1), start - 1)
    tail = F.array_repeat(zero, (start + width - done - 1).cast("int"))
    return rows.select(gene_col, "block", F.concat(F.flatten(F.transform(patients, piece)), tail).alias("counts"))
