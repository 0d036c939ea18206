"""Names for codes: joins of trips or insight tables with a lookup.

By default a code the lookup does not know drops out, as in an inner join;
``how="left"`` keeps such rows with a NULL name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ZONE_COLUMNS = (
    "location_id",
    "pulocationid",
    "dolocationid",
    "pickup_location_id",
    "dropoff_location_id",
)


def _named(rows: DataFrame, lookup: DataFrame, code: str, lookup_code: str, how: str) -> DataFrame:
    keyed = lookup.withColumnRenamed(lookup_code, "_code")
    return rows.join(keyed, rows[code] == keyed["_code"], how).drop("_code")


def decode_payment(rows: DataFrame, payments: DataFrame, how: str = "inner") -> DataFrame:
    return _named(rows, payments, "payment_type", "payment_type_id", how)


def decode_vendor(rows: DataFrame, vendors: DataFrame, how: str = "inner") -> DataFrame:
    return _named(rows, vendors, "vendorid", "vendor_id", how)


def decode_zone(
    rows: DataFrame,
    zones: DataFrame,
    code: str | None = None,
    prefix: str = "",
    how: str = "inner",
) -> DataFrame:
    """Adds ``zone`` and ``borough`` for the zone column found (or named by ``code``)."""
    code = code or next((c for c in ZONE_COLUMNS if c in rows.columns), None)
    if code is None:
        raise ValueError("no zone column to decode")
    names = zones.select(
        "LocationID",
        F.col("Zone").alias(f"{prefix}zone"),
        F.col("Borough").alias(f"{prefix}borough"),
    )
    return _named(rows, names, code, "LocationID", how)


def decode_zone_pairs(pairs: DataFrame, zones: DataFrame, how: str = "inner") -> DataFrame:
    """Both ends of a zone pair by name."""
    start = decode_zone(pairs, zones, "pickup_location_id", "pickup_", how)
    return decode_zone(start, zones, "dropoff_location_id", "dropoff_", how)
