"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tasks a core among which folders are listed.
LISTING_TASKS = 4
#: Bytes of a row group in a part of a staged table.
PART_ROW_GROUP = 16 << 20
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, else a folder in the warehouse.

    The default warehouse is a folder of the driver's machine; executors elsewhere do
    not share it, so it is an error unless everything runs in this process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share; the warehouse is a local one")
    return warehouse + "/_staged"


def stage(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Writes a table once and reads it back, by another session if that is given.

    Later uses neither repeat its plan nor depend on the executors that
    computed it, and the planner knows its real size.  The files stay until
    their folder is cleared, since lazy results may still read them.
    """
    spark = spark or df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Parts:
    """A staged table in numbered parts, each of them a folder."""

    table: DataFrame
    column: str
    path: str
    count: int

    def _folder(self, part: int):
        return file_system(self.table.sparkSession, f"{self.path}/{self.column}={part}")

    def sizes(self) -> dict[int, int]:
        """Bytes of each part, empty ones as well."""
        found = {}
        for part in range(self.count):
            system, folder = self._folder(part)
            found[part] = system.getContentSummary(folder).getLength() if system.exists(folder) else 0
        return found

    def remove(self, parts: list[int]) -> None:
        for part in parts:
            system, folder = self._folder(part)
            system.delete(folder, True)


def stage_parts(df: DataFrame, key: str, count: int, name: str) -> Parts:
    """Writes a table once, all rows of a key to one of ``count`` parts, and neither shuffles nor sorts it.

    Each task writes to all parts at a time, in row groups of a size that leaves memory for that.
    """
    spark = df.sparkSession
    column = "part"
    while column in df.columns:
        column += "_"
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    rows = df.withColumn(column, F.pmod(F.xxhash64(key), F.lit(count)).cast("int"))
    with _held(spark, {_WRITERS: str(count)}):
        rows.write.partitionBy(column).option("compression", "zstd").option("parquet.block.size", PART_ROW_GROUP).parquet(path)
    return Parts(spark.read.schema(rows.schema).parquet(path), column, path, count)


def checkpoint(df: DataFrame) -> DataFrame:
    """The same for small tables; Spark deletes the files with the DataFrame."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


@contextmanager
def _held(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of a session for as long as this holds."""
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def short_listing(spark: SparkSession):
    """Folders and files named while this holds are listed by LISTING_TASKS tasks a core at most.

    Spark makes a task for each folder or named file, up to 10,000, and starting one takes longer than
    listing many; more tasks than this list nothing sooner.
    """
    most = LISTING_TASKS * spark.sparkContext.defaultParallelism
    return _held(spark, {_LISTING: str(min(int(spark.conf.get(_LISTING)), most))})


def shuffles_removed(spark: SparkSession):
    """Shuffle files of a table written while this holds go when it is written, not when the driver next collects garbage."""
    return _held(spark, {_CLEANUP: "true"})


def source_bytes(df: DataFrame) -> int:
    """Bytes of what a table is made from, as the planner knows them: its files."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path itself, as Spark's own objects."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = file_system(spark, path)
    return system.exists(where)
