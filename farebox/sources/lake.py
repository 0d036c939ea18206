"""Writing and reading lake tables, and counting their files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.schema import CLEANED_PARTITIONS

# Nothing to read: what unfinished or finished writes leave beside the data.
STRAY_FILES = "*.tmp"


def write_table(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
) -> None:
    """Write a table of any of Spark's formats, by default over what is there."""
    df.write.save(path, format=file_format, mode=mode, partitionBy=list(partition_by) or None, **(options or {}))


def write_cleaned(
    trips: DataFrame, path: str, only_given_months: bool = False, gathered: bool = False
) -> None:
    """Write cleaned trips by pickup year and month.

    Rows are rebalanced by month first, so that a month is a few well-filled
    files and not one sliver per task; Spark splits a month that is too large
    for one task. Trips already ``gathered`` by month are written as they are.
    ``only_given_months`` replaces just the months present in ``trips`` and
    keeps the rest of the table.
    """
    partitions = [name for name in CLEANED_PARTITIONS if name in trips.columns]
    if len(partitions) < len(CLEANED_PARTITIONS):
        write_table(trips, path)
        return
    if not gathered:
        trips = trips.hint("rebalance", *[F.col(p) for p in partitions])
    overwrite = {"partitionOverwriteMode": "dynamic" if only_given_months else "static"}
    write_table(trips, path, partition_by=partitions, options=overwrite)


def scan_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned trips; the int partition columns come last."""
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(path)


def lake_files(spark: SparkSession, base: str, pattern: str = "*.parquet") -> DataFrame:
    """One row per data file: path, bytes, and the ``key=value`` folders above it.

    The content column is never asked for, so no file is opened.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(base)
    return files.drop("content", "modificationTime").withColumnRenamed("length", "bytes")


def lake_inventory(
    spark: SparkSession, base: str, by: Sequence[str] = ("year", "month")
) -> DataFrame:
    """Files and bytes per partition, in partition order."""
    keys = list(by)
    return (
        lake_files(spark, base)
        .groupBy(*keys)
        .agg(F.count("*").alias("file_count"), F.sum("bytes").alias("total_bytes"))
        .orderBy(*keys)
    )
