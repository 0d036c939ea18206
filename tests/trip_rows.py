"""Hand-made raw trips: one good trip, changed column by column."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "VendorID INT, tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ, "
    "passenger_count DOUBLE, trip_distance DOUBLE, PULocationID INT, DOLocationID INT, "
    "payment_type INT, fare_amount DOUBLE, extra DOUBLE, tip_amount DOUBLE, "
    "congestion_surcharge DOUBLE, total_amount DOUBLE"
)

GOOD = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime(2025, 1, 5, 10, 0, 0),
    "tpep_dropoff_datetime": datetime(2025, 1, 5, 10, 30, 0),
    "passenger_count": 1.0,
    "trip_distance": 10.0,
    "PULocationID": 100,
    "DOLocationID": 200,
    "payment_type": 1,
    "fare_amount": 20.0,
    "extra": 0.5,
    "tip_amount": 5.0,
    "congestion_surcharge": 2.5,
    "total_amount": 25.0,
}


def trip(**changes) -> dict:
    assert set(changes) <= set(GOOD)
    return {**GOOD, **changes}


def frame(spark: SparkSession, *rows: dict) -> DataFrame:
    return spark.createDataFrame([tuple(row[c] for c in GOOD) for row in rows], SCHEMA)
