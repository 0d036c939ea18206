"""Column names and types of the trip lake."""

from __future__ import annotations

# The columns a raw trip must have, spelled as in the raw files.
CRITICAL_COLUMNS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
)

# The columns that say two rows describe the same trip.
TRIP_IDENTITY = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "pulocationid",
    "dolocationid",
    "trip_distance",
    "fare_amount",
)

# Types to settle on when month files disagree, by lower-case column name.
DECLARED_TYPES = {
    "vendorid": "bigint",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "ratecodeid": "bigint",
    "store_and_fwd_flag": "string",
    "pulocationid": "bigint",
    "dolocationid": "bigint",
    "payment_type": "bigint",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

CLEANED_PARTITIONS = ("pickup_year", "pickup_month")

# Schemas of the three lookup files.
PAYMENT_SCHEMA = "payment_type_id INT, payment_type_name STRING"
VENDOR_SCHEMA = "vendor_id INT, vendor_name STRING"
ZONE_SCHEMA = "LocationID INT, Borough STRING, Zone STRING, service_zone STRING"
LOOKUP_SCHEMAS = {
    "payment_type_lookup": PAYMENT_SCHEMA,
    "vendor_lookup": VENDOR_SCHEMA,
    "taxi_zone_lookup": ZONE_SCHEMA,
}
