"""Headline figures over cleaned trips, and the pruned date filter."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trips_between(trips: DataFrame, start: str, end: str) -> DataFrame:
    """Trips picked up in ``[start, end)``.

    The same range in years and in months is added on the partition columns, so months
    outside it are not read; the plain test on years is one a metastore can take too.
    """
    first = datetime.fromisoformat(start)
    last = datetime.fromisoformat(end) - timedelta(microseconds=1)
    month = F.col("pickup_year") * 12 + F.col("pickup_month")
    pickup = F.col("tpep_pickup_datetime")
    return trips.where(
        F.col("pickup_year").between(first.year, last.year)
        & month.between(first.year * 12 + first.month, last.year * 12 + last.month)
        & (pickup >= F.lit(start).cast("timestamp"))
        & (pickup < F.lit(end).cast("timestamp"))
    )


def utilization(trips: DataFrame, period: str = "hour") -> DataFrame:
    """Trips in each hour, day, month, ... that has any."""
    started = F.date_trunc(period, F.col("pickup_ts")).alias("period")
    return trips.groupBy(started).agg(F.count("*").alias("trip_count")).orderBy("period")


def key_metrics(trips: DataFrame) -> DataFrame:
    """One row: trips, revenue, mean fare, and trips per hour and day in service.

    Trips shrink to one row per hour first; the second step sees hours only.
    """
    hours = trips.groupBy(F.date_trunc("hour", F.col("pickup_ts")).alias("hour")).agg(
        F.count("*").alias("trips"),
        F.sum("total_amount").alias("revenue"),
        F.sum("fare_amount").alias("fares"),
        F.count("fare_amount").alias("fare_count"),
    )
    days = hours.groupBy(F.to_date("hour").alias("day")).agg(
        F.sum("trips").alias("trips"),
        F.sum("revenue").alias("revenue"),
        F.sum("fares").alias("fares"),
        F.sum("fare_count").alias("fare_count"),
        F.count("*").alias("hours"),
    )
    total = F.sum("trips")
    return days.agg(
        F.coalesce(total, F.lit(0)).alias("total_trips"),
        F.sum("revenue").alias("total_revenue"),
        F.try_divide(F.sum("fares"), F.sum("fare_count")).alias("avg_fare"),
        F.try_divide(total, F.sum("hours")).alias("trips_per_hour"),
        F.try_divide(total, F.count("*")).alias("trips_per_day"),
    )
