"""Reading raw trips: one folder per month under ``year=Y/month=MM``."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.schema import DECLARED_TYPES
from farebox.sources.lake import lake_files

DEFAULT_MONTHS = ("01-10",)
DEFAULT_YEAR = 2025

# What Spark says of files whose columns have different types.
CANNOT_MERGE = "CANNOT_MERGE_SCHEMAS"

Month = tuple[int, str]  # year, and the month as its folder is written


def months_from(selection: Iterable[str]) -> list[str]:
    """Two-digit months, sorted and unique, from ``MM`` and ``MM-MM`` selections.

    A single month must have two digits; the ends of a range may be any whole
    numbers, the first not above the last.
    """
    months: set[str] = set()
    for text in selection:
        ends = re.fullmatch(r"\s*(\d+)\s*-\s*(\d+)\s*", text)
        if ends:
            first, last = map(int, ends.groups())
            if first > last:
                raise ValueError(f"month range {text!r} runs backwards")
            months.update(f"{month:02d}" for month in range(first, last + 1))
        elif re.fullmatch(r"\d\d", text):
            months.add(text)
        else:
            raise ValueError(f"{text!r} is neither MM nor MM-MM")
    return sorted(months)


def _as_instants(spark: SparkSession, schema: T.StructType) -> T.StructType:
    """In UTC, read zoneless times as instants: the same values, no casts later."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        return schema
    zoneless = T.TimestampNTZType()
    return T.StructType(
        [
            T.StructField(f.name, T.TimestampType() if f.dataType == zoneless else f.dataType)
            for f in schema.fields
        ]
    )


def raw_months(spark: SparkSession, base: str) -> list[Month]:
    """Year and month, the latter as the folder is written, of every month that has files."""
    place = r"/year=(\d+)/month=(\d+)/[^/]+$"
    found = lake_files(spark, base).select(
        F.regexp_extract("path", place, 1).alias("year"), F.regexp_extract("path", place, 2).alias("month")
    )
    return sorted((int(row.year), row.month) for row in found.where("year <> ''").distinct().collect())


def _reader(spark: SparkSession, base: str) -> DataFrameReader:
    return spark.read.option("basePath", base).option("pathGlobFilter", "*.parquet")


def trip_columns(spark: SparkSession, base: str, paths: Iterable[str]) -> T.StructType:
    """The columns of all files there, but for those that folders give."""
    found = _reader(spark, base).option("mergeSchema", "true").parquet(*paths).schema.fields
    return _as_instants(spark, T.StructType([f for f in found if f.name not in ("year", "month")]))


def read_alike(spark: SparkSession, base: str, columns: dict[str, str]) -> list[DataFrame]:
    """One scan for all paths that are to be read with the same columns (path: columns as JSON)."""
    alike: dict[str, list[str]] = {}
    for path, found in columns.items():
        alike.setdefault(found, []).append(path)
    return [
        _reader(spark, base).schema(T.StructType.fromJson(json.loads(found))).parquet(*paths)
        for found, paths in alike.items()
    ]


def whole_columns(parts: list[DataFrame], schemas: Iterable[T.StructType] = ()) -> DataFrame:
    """All parts as one table: columns on which they, or ``schemas``, disagree are cast to the
    declared type, what a part lacks is NULL, and names that differ only in case are one column.
    The table has the columns of ``schemas`` too."""
    schemas = [*schemas, *(part.schema for part in parts)]
    types: dict[str, dict[str, T.StructField]] = {}
    for schema in schemas:
        for f in schema.fields:
            types.setdefault(f.name.lower(), {}).setdefault(f.dataType.simpleString(), f)
    disputed = {name for name, found in types.items() if len(found) > 1 and name in DECLARED_TYPES}

    def whole(part: DataFrame) -> DataFrame:
        casts = {
            name: F.col(name).try_cast(DECLARED_TYPES[name.lower()])
            for name in part.columns
            if name.lower() in disputed
        }
        have = {name.lower() for name in part.columns}
        for name in types.keys() - have:
            field = next(iter(types[name].values()))
            casts[field.name] = F.lit(None).cast(DECLARED_TYPES[name] if name in disputed else field.dataType)
        return part.withColumns(casts) if casts else part

    table = reduce(lambda a, b: a.unionByName(b), map(whole, parts))
    if len(types) == len(parts[0].columns):
        return table
    # The same order of columns whichever parts are read: what lies beside them comes last.
    order = [next(iter(found.values())).name for name, found in types.items() if name not in ("year", "month")]
    return table.select(*order, *[name for name in ("year", "month") if name in types])


def scan_raw(spark: SparkSession, base: str, months: Iterable[Month] | None = None) -> DataFrame:
    """Raw trips of all months, or of a list of (year, month) pairs, with int columns ``year``
    and ``month`` from the path.

    Where all files' columns can be merged, that is one scan. Otherwise each month's own
    schema is looked at: months that agree are read together, and where they differ the
    columns are cast to the declared types before the union. A column that a file or month
    lacks is NULL there; names that differ only in case are one column.
    """
    whole = months is None
    months = raw_months(spark, base) if whole else list(months)
    paths = [f"{base.rstrip('/')}/year={year}/month={month}" for year, month in months]
    if not paths and not whole:
        raise ValueError("no months to read")
    try:
        places = [base] if whole else paths
        return _reader(spark, base).schema(trip_columns(spark, base, places)).parquet(*places)
    except (PySparkException, Py4JJavaError) as error:
        if CANNOT_MERGE not in str(error) or not paths:
            raise
    return whole_columns(read_alike(spark, base, {path: trip_columns(spark, base, [path]).json() for path in paths}))


def scan_raw_months(
    spark: SparkSession,
    base: str,
    selection: Iterable[str] = DEFAULT_MONTHS,
    year: int = DEFAULT_YEAR,
) -> DataFrame:
    """The chosen months of one year; other months' files are not opened."""
    months = [int(month) for month in months_from(selection)]
    there = [(y, m) for y, m in raw_months(spark, base) if y == year and int(m) in months]
    trips = scan_raw(spark, base, there) if there else scan_raw(spark, base)
    return trips.where((F.col("year") == year) & F.col("month").isin(*months))
