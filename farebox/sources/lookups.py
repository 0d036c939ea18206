"""The three lookup tables that give codes their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.schema import LOOKUP_SCHEMAS, PAYMENT_SCHEMA, VENDOR_SCHEMA
from farebox.sources.lake import write_table

# Payment codes.
PAYMENT_TYPES = [
    (0, "Flex Fare"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]

# Vendor codes.
VENDORS = [
    (1, "Creative Mobile Technologies"),
    (2, "Curb Mobility"),
    (6, "Myle Technologies"),
    (7, "Helix"),
]


def payment_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PAYMENT_TYPES, PAYMENT_SCHEMA)


def vendors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VENDORS, VENDOR_SCHEMA)


def scan_lookup_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A lookup file with a header line, by the header's names, as its known types.

    The columns may stand in any order and beside others; one that is missing is an error.
    """
    written = spark.read.csv(path, header=True)
    fields = T.StructType.fromDDL(LOOKUP_SCHEMAS[table]).fields
    return written.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in fields])


def publish_lookups(lookups: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write each lookup as a Parquet table of well-filled files; returns their paths."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in lookups}
    for name, lookup in lookups.items():
        write_table(lookup.hint("rebalance"), paths[name])
    return paths


def publish_lookup_files(spark: SparkSession, csv_paths: dict[str, str], folder: str) -> dict[str, str]:
    """Publish lookups kept as CSV files, by table name."""
    lookups = {table: scan_lookup_csv(spark, path, table) for table, path in csv_paths.items()}
    return publish_lookups(lookups, folder)
