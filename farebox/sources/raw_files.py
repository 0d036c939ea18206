"""What is known of every raw file: its size and time, its columns, and which pickup months its
trips are in.

The record is a small Parquet table, a row per file and pickup month. A file whose size and time
are as recorded is not opened again: neither for its columns nor to find its months. Only the
pickup time of new files is read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from functools import reduce
from operator import or_

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.functions.trip_columns import event_time
from farebox.session import folder_exists, replace_folder
from farebox.sources.lake import write_table
from farebox.sources.raw import CANNOT_MERGE, Month, read_alike, trip_columns, whole_columns

RECORD = (
    "file STRING, bytes BIGINT, modified TIMESTAMP, columns STRING, "
    "pickup_year INT, pickup_month INT, trips BIGINT"
)
FOLDER = r"/year=(\d+)/month=(\d+)/[^/]+$"
PICKUP = "tpep_pickup_datetime"


def in_months(months: Iterable[Month], year: str | Column, month: str | Column) -> Column:
    """Whether two columns name one of the months."""
    year, month = (F.col(c) if isinstance(c, str) else c for c in (year, month))
    chosen = [(year == int(y)) & (month == int(m)) for y, m in months]
    return reduce(or_, chosen, F.lit(False))


def filed_in(months: Iterable[Month] | None) -> Column:
    """Whether a file is in the folder of one of the months."""
    if months is None:
        return F.lit(True)
    year, month = (F.regexp_extract("file", FOLDER, i).try_cast("int") for i in (1, 2))
    return in_months(months, year, month)


def _file() -> Column:
    """The path of the file a row is from, as a reader takes it: Spark tells it as an address."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias("file")


def list_files(spark: SparkSession, base: str) -> DataFrame:
    """(file, bytes, modified) of every raw file; none is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(base)
    return files.select(
        _file(),
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _columns_of(spark: SparkSession, base: str, files: list[str]) -> dict[str, str]:
    """The columns to read each file with, as JSON: those of all files where they agree, and
    otherwise those of the file's folder."""
    try:
        found = trip_columns(spark, base, files).json()
        return dict.fromkeys(files, found)
    except (PySparkException, Py4JJavaError) as error:
        folders: dict[str, list[str]] = {}
        for file in files:
            folders.setdefault(file.rsplit("/", 1)[0], []).append(file)
        if CANNOT_MERGE not in str(error) or len(folders) == 1:
            raise
    return {file: found for held in folders.values() for file, found in _columns_of(spark, base, held).items()}


def record(spark: SparkSession, base: str, known: Iterable[str] = (), months: Iterable[Month] | None = None) -> DataFrame:
    """The record of the files that are there now, of all months' folders or some.

    ``known`` are folders of earlier records; what they say of a file is taken over if its size
    and time have not changed. Files without trips have one row, without a month.
    """
    there = list_files(spark, base).where(filed_in(months))
    earlier = [read_record(spark, folder) for folder in known if folder_exists(spark, folder)]
    kept = reduce(DataFrame.unionByName, earlier).distinct() if earlier else spark.createDataFrame([], RECORD)
    same = ["file", "bytes", "modified"]
    kept = kept.join(there, same, "left_semi").select(*T.StructType.fromDDL(RECORD).names)
    new = there.join(kept.select(same).distinct(), same, "left_anti").collect()
    if not new:
        return kept
    columns = _columns_of(spark, base, [row.file for row in new])
    new_files = spark.createDataFrame([(*row, columns[row.file]) for row in new], RECORD.split(", pickup_year")[0])
    pickup = event_time(PICKUP)
    counted = [
        part.select(_file(), pickup.alias("pickup"))
        for part in read_alike(spark, base, columns)
    ]
    counted = reduce(DataFrame.unionByName, counted)
    counted = counted.groupBy("file", F.year("pickup").alias("pickup_year"), F.month("pickup").alias("pickup_month"))
    found = new_files.join(counted.agg(F.count("*").alias("trips")), "file", "left").fillna(0, ["trips"])
    return kept.unionByName(found.select(kept.columns))


def read_record(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(RECORD).parquet(folder)


def read_files(files: DataFrame, base: str, all_columns: Iterable[str] = ()) -> DataFrame | None:
    """The raw trips of recorded files, with the columns of all given ones (as JSON) and, where
    those disagree, the declared types; None without files. No footer is read for it."""
    columns = {row.file: row.columns for row in files.select("file", "columns").distinct().collect()}
    schemas = [T.StructType.fromJson(json.loads(found)) for found in all_columns]
    return whole_columns(read_alike(files.sparkSession, base, columns), schemas) if columns else None


def scan_recorded(
    spark: SparkSession, base: str, folder: str, months: Iterable[Month] | None = None
) -> DataFrame | None:
    """Raw trips as ``scan_raw`` reads them, by the record kept in ``folder``, which is brought
    up to date first. Only files that are new or have changed are opened to know their columns.
    None if there are no files.
    """
    now = f"{folder.rstrip('/')}-{uuid.uuid4().hex}"
    write_table(record(spark, base, [folder]), now)
    replace_folder(spark, now, folder)
    files = read_record(spark, folder).where(filed_in(months))
    return read_files(files, base)
