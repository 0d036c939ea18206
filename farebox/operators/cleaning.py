"""Trip cleaning as DataFrame -> DataFrame steps, for ``df.transform(step)``.

Each step works alone. ``clean_trips`` runs them all, but as one filter, one
de-duplication over the raw columns and one projection, so that computed
columns are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from farebox.functions import trip_columns as tc
from farebox.schema import CRITICAL_COLUMNS, TRIP_IDENTITY


@dataclass(frozen=True)
class TripRules:
    """Adjustable limits; the defaults are the usual ones."""

    last_second: str = tc.LAST_VALID_SECOND
    minutes: tuple[float, float] = tc.MINUTES_RANGE
    mph: tuple[float, float] = tc.MPH_RANGE
    passengers: tuple[int, int] = tc.PASSENGER_RANGE
    airport_zone_ids: tuple[int, ...] = tc.AIRPORT_ZONE_IDS

    def stages(self) -> list[tuple[str, Column]]:
        """The row tests in order, written on raw columns only."""
        pickup, dropoff = tc.pickup_time(), tc.dropoff_time()
        minutes = tc.minutes_between(pickup, dropoff)
        miles = F.col("trip_distance")
        return [
            ("nulls", tc.all_present(CRITICAL_COLUMNS)),
            ("times", tc.times_plausible(pickup, dropoff, self.last_second)),
            ("duration", tc.within(minutes, self.minutes)),
            ("speed", tc.speed_plausible(tc.miles_per_hour(miles, minutes), self.mph)),
            ("fare_distance", tc.fare_and_distance_plausible(F.col("fare_amount"), miles)),
            ("passengers", tc.within(F.col("passenger_count"), self.passengers)),
        ]


DEFAULT_RULES = TripRules()


def require_columns(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    """Fail on the schema alone, before any job, if a column is missing."""
    absent = sorted(set(columns) - set(df.columns))
    if absent:
        raise ValueError(f"input lacks the columns {', '.join(absent)}")
    return df


def standardize_columns(df: DataFrame) -> DataFrame:
    """Lower-case names with underscores for spaces; a collision is an error."""
    names = [name.lower().replace(" ", "_") for name in df.columns]
    clashing = sorted({name for name in names if names.count(name) > 1})
    if clashing:
        raise ValueError(f"several columns would be called {', '.join(clashing)}")
    return df.toDF(*names)


def drop_null_critical(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    return df.where(tc.all_present(columns))


def parse_ts(df: DataFrame, column: str, pattern: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    return df.withColumn(column, tc.event_time(column, pattern))


def valid_times(df: DataFrame, last_second: str = tc.LAST_VALID_SECOND) -> DataFrame:
    timed = df.withColumns({"pickup_ts": tc.pickup_time(), "dropoff_ts": tc.dropoff_time()})
    return timed.where(tc.times_plausible(F.col("pickup_ts"), F.col("dropoff_ts"), last_second))


def trip_duration(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "trip_duration_minutes", tc.minutes_between(F.col("pickup_ts"), F.col("dropoff_ts"))
    )


def valid_duration(df: DataFrame, bounds: Sequence[float] = tc.MINUTES_RANGE) -> DataFrame:
    return df.where(tc.within(F.col("trip_duration_minutes"), bounds))


def trip_speed(df: DataFrame) -> DataFrame:
    mph = tc.miles_per_hour(F.col("trip_distance"), F.col("trip_duration_minutes"))
    return df.withColumn("trip_speed_mph", mph)


def valid_speed(df: DataFrame, bounds: Sequence[float] = tc.MPH_RANGE) -> DataFrame:
    return df.where(tc.speed_plausible(F.col("trip_speed_mph"), bounds))


def valid_fare_distance(
    df: DataFrame, fare: str = "fare_amount", distance: str = "trip_distance"
) -> DataFrame:
    return df.where(tc.fare_and_distance_plausible(F.col(fare), F.col(distance)))


def valid_passengers(df: DataFrame, bounds: Sequence[int] = tc.PASSENGER_RANGE) -> DataFrame:
    return df.where(tc.within(F.col("passenger_count"), bounds))


def dedup_trips(df: DataFrame, identity: Sequence[str] = TRIP_IDENTITY) -> DataFrame:
    """One row per trip identity, with NULLs equal, and always the same row.

    The first row by the remaining columns survives. Spark applies the
    "first row" limit before the shuffle too (WindowGroupLimit), so a group of
    copies sends one row per task however large it is.
    """
    keys = [name for name in identity if name in df.columns]
    rest = [name for name in df.columns if name not in keys]
    if not keys:
        return df
    if not rest:
        return df.distinct()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*rest))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")


def temporal_features(df: DataFrame) -> DataFrame:
    return df.withColumns(tc.calendar_parts(F.col("pickup_ts")))


def tip_percentage(df: DataFrame) -> DataFrame:
    if not {"tip_amount", "total_amount"} <= set(df.columns):
        return df
    return df.withColumn("tip_percentage", tc.tip_share(F.col("tip_amount"), F.col("total_amount")))


def trip_length_category(df: DataFrame) -> DataFrame:
    if "trip_distance" not in df.columns:
        return df
    return df.withColumn("trip_length_category", tc.length_band(F.col("trip_distance")))


def airport_flags(df: DataFrame, zone_ids: Sequence[int] = tc.AIRPORT_ZONE_IDS) -> DataFrame:
    """A flag per known end of the trip; the trip flag needs both ends."""
    ends = {"is_airport_pickup": "pulocationid", "is_airport_dropoff": "dolocationid"}
    flags = {
        flag: tc.in_zones(F.col(zone), zone_ids) for flag, zone in ends.items() if zone in df.columns
    }
    if len(flags) == len(ends):
        flags["is_airport_trip"] = flags["is_airport_pickup"] | flags["is_airport_dropoff"]
    return df.withColumns(flags) if flags else df


def quality_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "has_valid_locations": tc.all_present(["pulocationid", "dolocationid"]),
            "has_valid_payment": tc.all_present(["payment_type"]),
        }
    )


def believable_trips(df: DataFrame, rules: TripRules = DEFAULT_RULES) -> DataFrame:
    """Rows that pass every test, as one filter; plain column tests reach the scan."""
    for _, test in rules.stages():
        df = df.where(test)
    return df


def _gathered_by_month(trips: DataFrame) -> DataFrame:
    """Rebalance rows by pickup month; a month too large for a task is split."""
    pickup = tc.pickup_time()
    dated = trips.withColumns({"_year": F.year(pickup), "_month": F.month(pickup)})
    return dated.hint("rebalance", F.col("_year"), F.col("_month")).drop("_year", "_month")


def believable_trips_counted(df: DataFrame, rules: TripRules, counts: Observation) -> DataFrame:
    """As ``believable_trips``, and ``counts`` gets, while the rows are read for whatever they
    are read for, how many trips pass so many tests (``passed_0`` and so on)."""
    names = range(len(rules.stages()) + 1)
    graded = df.withColumn("_passed", _tests_passed(rules))
    observed = graded.observe(counts, *[F.count_if(F.col("_passed") == n).alias(f"passed_{n}") for n in names])
    return observed.where(F.col("_passed") == len(names) - 1).drop("_passed")


def clean_trips(
    raw: DataFrame,
    rules: TripRules = DEFAULT_RULES,
    by_month: bool = False,
    counts: Observation | None = None,
) -> DataFrame:
    """Raw trips to cleaned, enriched trips in one lazy plan with one shuffle.

    ``by_month`` also gathers the rows of a month, for writing. This is done
    before columns are added, so that half as many bytes travel. With ``counts`` the funnel is
    counted on the way; the tests then cannot be pushed into the scan.
    """
    trips = raw.transform(require_columns).transform(standardize_columns)
    if counts is None:
        kept = trips.transform(believable_trips, rules)
    else:
        kept = trips.transform(believable_trips_counted, rules, counts)
    kept = kept.transform(dedup_trips)
    if by_month:
        kept = kept.transform(_gathered_by_month)
    return (
        kept.withColumns({"pickup_ts": tc.pickup_time(), "dropoff_ts": tc.dropoff_time()})
        .transform(trip_duration)
        .transform(trip_speed)
        .transform(temporal_features)
        .transform(tip_percentage)
        .transform(trip_length_category)
        .transform(airport_flags, rules.airport_zone_ids)
        .transform(quality_flags)
    )


def _tests_passed(rules: TripRules) -> Column:
    """How many of the row tests a trip passes before it fails one."""
    stages = rules.stages()
    passed = F.lit(len(stages))
    for depth, (_, test) in reversed(list(enumerate(stages))):
        passed = F.when(F.coalesce(test, F.lit(False)), passed).otherwise(F.lit(depth))
    return passed


def stage_counts(raw: DataFrame, rules: TripRules = DEFAULT_RULES) -> DataFrame:
    """(passed, copies): how many trips pass so many tests; a row per number of tests."""
    trips = raw.transform(require_columns).transform(standardize_columns)
    return trips.groupBy(_tests_passed(rules).alias("passed")).agg(F.count("*").alias("copies"))


def funnel_rows(
    counts: dict[int, int], kept: int, rules: TripRules = DEFAULT_RULES
) -> list[tuple[int, str, int, int]]:
    """The funnel's rows from ``stage_counts`` and the number of trips after de-duplication."""
    names = ["raw", *[name for name, _ in rules.stages()], "dedup"]
    left = [sum(n for passed, n in counts.items() if passed >= depth) for depth in range(len(names) - 1)]
    left.append(kept)
    before = [left[0], *left[:-1]]
    return [(place, name, n, b - n) for place, (name, n, b) in enumerate(zip(names, left, before))]


def cleaning_funnel(raw: DataFrame, rules: TripRules = DEFAULT_RULES) -> DataFrame:
    """Rows left after each stage, from one pass over the raw trips.

    A trip is reduced to the number of tests it passes, plus its identity if it
    passes all. Rows that fail collapse to one group per stage before the
    shuffle; only identities of good trips travel.
    """
    trips = raw.transform(require_columns).transform(standardize_columns)
    stages = rules.stages()
    keys = [name for name in TRIP_IDENTITY if name in trips.columns]
    graded = trips.select(_tests_passed(rules).alias("passed"), *keys).select(
        "passed", *[F.when(F.col("passed") == len(stages), F.col(k)).alias(k) for k in keys]
    )
    groups = graded.groupBy("passed", *keys).agg(F.count("*").alias("copies"))
    names = ["raw", *[name for name, _ in stages]]
    counts = [
        F.coalesce(F.sum(F.when(F.col("passed") >= depth, F.col("copies"))), F.lit(0)).alias(name)
        for depth, name in enumerate(names)
    ]
    totals = groups.agg(*counts, F.count_if(F.col("passed") == len(stages)).alias("dedup"))
    names = [*names, "dedup"]
    rows = F.array(
        *[
            F.struct(
                F.lit(place).alias("stage_no"),
                F.lit(name).alias("stage"),
                F.col(name).alias("rows_left"),
                (F.col(names[max(place - 1, 0)]) - F.col(name)).alias("rows_removed"),
            )
            for place, name in enumerate(names)
        ]
    )
    return totals.select(F.inline(rows)).orderBy("stage_no")
