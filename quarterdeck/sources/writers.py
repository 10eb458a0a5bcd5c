"""DataFrames to tables and files.  Every path must lie in storage all executors share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Rows per file, so that a hot partition value becomes many files and not one.
ROWS_PER_FILE = 5_000_000
CORPUS_BUCKETS = 256


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), compression: str | None = None) -> DataFrame:
    """Replaces the table and returns it read back, so later steps start from storage.

    Rows of one partition value are brought together first, so that not every task
    writes a file for every value; a large value is split over tasks again by its size.
    """
    rows = df.hint("rebalance", *(F.col(c) for c in partition_by)) if partition_by else df
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder, if there is one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


Keep = Callable[[DataFrame, str], DataFrame]


def keeper(out: str) -> Keep:
    """A function that stores a frame under ``out`` by a name and reads it back: what a job uses
    twice is computed once."""
    return lambda df, name: write_table(df, f"{out}/{name}")


def not_kept(df: DataFrame, name: str) -> DataFrame:
    """In place of a ``keeper`` where there is no folder to write to: computed anew at every use."""
    return df


def append_run(row: DataFrame, path: str, dry_run: bool = False) -> DataFrame:
    """Puts runs into the log, each as the partition of its ``run_id``; a dry run only returns the rows.

    Appending a run again replaces it, and an attempt that fails leaves nothing, so a retry is safe.
    """
    if not dry_run:
        writer = row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("run_id").parquet(path)
    return row


def read_runs(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The log; ``schema`` is that of its rows, so that ids which look like numbers stay text."""
    return spark.read.schema(schema).parquet(path)


def bucket_of(deal_id: str) -> Column:
    """The partition value of a deal in the stored corpus, so a read for some deals skips the other files."""
    return F.pmod(F.xxhash64(deal_id), F.lit(CORPUS_BUCKETS)).cast("int")


def write_report(lines: DataFrame, path: str) -> None:
    """Text files whose order by name is the order of the lines; no task holds them all."""
    lines.orderBy("part", "place").select("value").write.mode("overwrite").text(path)
