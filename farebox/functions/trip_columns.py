"""Column expressions over one trip. Nothing here touches a DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The limits of a believable trip.
LAST_VALID_SECOND = "2025-12-31 23:59:59"
MINUTES_RANGE = (1.0, 1440.0)
MPH_RANGE = (1.0, 100.0)
PASSENGER_RANGE = (0, 6)
AIRPORT_ZONE_IDS = (1, 2, 3)
SHORT_BELOW_MILES = 2.0
MEDIUM_BELOW_MILES = 5.0


def event_time(column: str, pattern: str | None = None) -> Column:
    """The column as a timestamp; text that is no time becomes NULL, not an error."""
    source = F.col(column)
    return F.try_to_timestamp(source, F.lit(pattern)) if pattern else F.try_to_timestamp(source)


def pickup_time() -> Column:
    return event_time("tpep_pickup_datetime")


def dropoff_time() -> Column:
    return event_time("tpep_dropoff_datetime")


def all_present(columns: Iterable[str]) -> Column:
    """No column is NULL. NaN counts as a value."""
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def times_plausible(pickup: Column, dropoff: Column, last_second: str = LAST_VALID_SECOND) -> Column:
    """Dropoff after pickup, and both no later than the whole second ``last_second``."""
    too_late = F.date_trunc("second", F.to_timestamp(F.lit(last_second))) + F.expr("INTERVAL 1 SECOND")
    return (pickup < dropoff) & (pickup < too_late) & (dropoff < too_late)


def minutes_between(pickup: Column, dropoff: Column) -> Column:
    """Minutes from whole second to whole second, as a double."""
    return (F.unix_seconds(dropoff) - F.unix_seconds(pickup)) / F.lit(60.0)


def miles_per_hour(miles: Column, minutes: Column) -> Column:
    return F.when(minutes > 0, miles / (minutes / F.lit(60.0)))


def within(value: Column, bounds: Sequence[float]) -> Column:
    """Both bounds count. SQL's BETWEEN evaluates ``value`` once, ``Column.between`` twice."""
    low, high = bounds
    return F.call_function("between", value, F.lit(low), F.lit(high))


def speed_plausible(mph: Column, bounds: Sequence[float] = MPH_RANGE) -> Column:
    """An unknown speed is let through."""
    return F.coalesce(within(mph, bounds), F.lit(True))


def fare_and_distance_plausible(fare: Column, miles: Column) -> Column:
    return (fare >= 0) & (miles > 0)


def calendar_parts(pickup: Column) -> dict[str, Column]:
    return {
        "pickup_year": F.year(pickup),
        "pickup_month": F.month(pickup),
        "pickup_day": F.date_format(pickup, "d"),
        "pickup_hour": F.hour(pickup),
        "pickup_day_of_week": F.dayofweek(pickup),
        "pickup_date": F.date_format(pickup, "yyyy-MM-dd"),
    }


def tip_share(tip: Column, total: Column) -> Column:
    """Tip in percent of the whole bill; 0 where the bill is not positive or unknown."""
    return F.when(total > 0, tip / total * F.lit(100.0)).otherwise(F.lit(0.0))


def length_band(miles: Column) -> Column:
    return (
        F.when(miles < SHORT_BELOW_MILES, F.lit("short"))
        .when(miles < MEDIUM_BELOW_MILES, F.lit("medium"))
        .otherwise(F.lit("long"))
    )


def in_zones(zone: Column, zone_ids: Sequence[int] = AIRPORT_ZONE_IDS) -> Column:
    """NULL zone gives NULL, as SQL's IN does."""
    return zone.isin(*zone_ids)
