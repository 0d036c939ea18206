"""The twenty insight tables over cleaned trips.

``insight`` computes one table with its own scan of a few columns.
``insight_tables`` computes all of them from three small tables of sums and counts: trips are
grouped by the keys that tables share, and every table is a coarser grouping of one of the three.
Kept by pickup month (``month_partials``), they also say what a table would be after some months
have changed, without the trips of all others.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.functions import trip_columns as tc
from farebox.session import side_by_side, work_folder
from farebox.sources.lake import scan_cleaned, write_table


@dataclass(frozen=True)
class Measure:
    """A sum or mean of one column, kept as a (sum, count) pair in the groupings."""

    kind: str
    column: str
    when_known: str | None = None

    @property
    def pair(self) -> str:
        return f"{self.column}__{self.when_known}" if self.when_known else self.column

    def value(self) -> Column:
        column = F.col(self.column)
        return F.when(F.col(self.when_known).isNotNull(), column) if self.when_known else column

    def direct(self) -> Column:
        return F.sum(self.value()) if self.kind == "sum" else F.avg(self.value())

    def partials(self) -> list[Column]:
        return [
            F.sum(self.value()).alias(f"sum_{self.pair}"),
            F.count(self.value()).alias(f"count_{self.pair}"),
        ]

    def merged(self) -> Column:
        total = F.sum(f"sum_{self.pair}")
        if self.kind == "sum":
            return total
        return F.try_divide(total, F.sum(f"count_{self.pair}"))


def _sum(column: str) -> Measure:
    return Measure("sum", column)


def _mean(column: str, when_known: str | None = None) -> Measure:
    return Measure("mean", column, when_known)


DISTANCE = {"avg_distance": _mean("trip_distance")}
FARES = {"avg_fare": _mean("fare_amount"), "avg_total": _mean("total_amount")}
STANDARD = {**DISTANCE, **FARES}
REVENUE = {"total_revenue": _sum("total_amount")}
DURATION = {"avg_duration_minutes": _mean("trip_duration_minutes")}
TAKINGS = {
    "total_fare": _sum("fare_amount"),
    "avg_fare": _mean("fare_amount"),
    **REVENUE,
    "avg_total": _mean("total_amount"),
}
TAKINGS_WITH_TIPS = {**TAKINGS, "total_tip": _sum("tip_amount"), "avg_tip": _mean("tip_amount")}
TIPS = {
    "total_tips": _sum("tip_amount"),
    "avg_tip": _mean("tip_amount"),
    "avg_tip_percentage": _mean("tip_share"),
}


@dataclass(frozen=True)
class Insight:
    """One table: groups, what is measured in them, and how rows are ordered."""

    keys: tuple[str, ...]
    measures: dict[str, Measure] = field(hash=False)
    counted: str = "trip_count"
    shown_as: tuple[str, ...] = ()
    only: tuple[str, ...] = ()
    known: str | None = None
    largest_first: str | None = None
    spare_column: str | None = None

    @property
    def key_names(self) -> tuple[str, ...]:
        return self.shown_as or self.keys

    def needs(self) -> set[str]:
        columns = {m.column for name, m in self.measures.items() if name != self.spare_column}
        columns |= {m.when_known for m in self.measures.values() if m.when_known}
        if self.known:
            columns.add(self.known)
        return columns | set(self.keys) | set(self.only)


FEE = "congestion_fee"
ZONE_KEYS = (
    "pulocationid",
    "dolocationid",
    "is_airport_pickup",
    "is_airport_dropoff",
    "is_airport_trip",
)

INSIGHTS: dict[str, Insight] = {
    # volume, duration and speed
    "trip_volume_by_hour": Insight(("pickup_hour",), STANDARD),
    "trip_volume_by_day": Insight(("pickup_day_of_week",), STANDARD),
    "trip_volume_by_zone": Insight(("pulocationid",), STANDARD, largest_first="trip_count"),
    "trip_duration_by_hour": Insight(("pickup_hour",), {**DURATION, **DISTANCE}),
    "trip_duration_by_zone": Insight(
        ("pulocationid",), {**DURATION, **DISTANCE}, largest_first="trip_count"
    ),
    "trip_speed_by_hour": Insight(
        ("pickup_hour",),
        {
            "avg_speed_mph": _mean("trip_speed_mph"),
            "avg_distance": _mean("trip_distance", when_known="trip_speed_mph"),
        },
        known="trip_speed_mph",
    ),
    "monthly_trends": Insight(("pickup_month",), {**STANDARD, **REVENUE}),
    "trips_by_length_category": Insight(
        ("trip_length_category",), {**STANDARD, **DURATION}, spare_column="avg_duration_minutes"
    ),
    # zones and airports
    "popular_pickup_zones": Insight(
        ("pulocationid",), STANDARD, "pickup_count", ("location_id",), largest_first="pickup_count"
    ),
    "popular_dropoff_zones": Insight(
        ("dolocationid",), STANDARD, "dropoff_count", ("location_id",), largest_first="dropoff_count"
    ),
    "zone_pair_analysis": Insight(
        ("pulocationid", "dolocationid"),
        STANDARD,
        shown_as=("pickup_location_id", "dropoff_location_id"),
        largest_first="trip_count",
    ),
    "airport_trip_analysis": Insight(
        ("is_airport_pickup", "is_airport_dropoff"),
        {**STANDARD, **REVENUE},
        only=("is_airport_trip",),
    ),
    "airport_pickup_zones": Insight(
        ("pulocationid",),
        STANDARD,
        "pickup_count",
        only=("is_airport_trip", "is_airport_pickup"),
        largest_first="pickup_count",
    ),
    "airport_dropoff_zones": Insight(
        ("dolocationid",),
        STANDARD,
        "dropoff_count",
        only=("is_airport_trip", "is_airport_dropoff"),
        largest_first="dropoff_count",
    ),
    # revenue, fees and tips
    "revenue_by_payment_type": Insight(
        ("payment_type",), TAKINGS_WITH_TIPS, largest_first="total_revenue"
    ),
    "revenue_by_time": Insight(("pickup_hour",), TAKINGS_WITH_TIPS),
    "congestion_fee_analysis": Insight(
        (FEE,), {**TAKINGS, "total_congestion_fee": _sum(FEE)}, largest_first="total_congestion_fee"
    ),
    "revenue_by_vendor": Insight(("vendorid",), TAKINGS, largest_first="total_revenue"),
    "tip_analysis": Insight(
        ("payment_type",), {**TIPS, "avg_total": _mean("total_amount")}, largest_first="total_tips"
    ),
    "tip_by_time": Insight(("pickup_hour",), TIPS),
}

# Every table is a coarser grouping of one of these. Keys of few values are crossed; those of
# many (zones) stand alone, and so does no key that would multiply them.
LATTICE: dict[str, tuple[str, ...]] = {
    "by_hour": ("pickup_hour", "pickup_day_of_week"),
    "by_bill": ("trip_length_category", "payment_type", "vendorid", FEE),
    "by_zone": ZONE_KEYS,
}
# Tables by month need it in one of them only.
MONTH_KEYS = ("pickup_year", "pickup_month")
WITH_MONTHS = "by_hour"


def grouping_of(name: str) -> str:
    """The grouping that a table is made from."""
    wanted = set(INSIGHTS[name].keys) | set(INSIGHTS[name].only)
    return next(
        g for g, keys in LATTICE.items() if wanted <= set(keys) | (set(MONTH_KEYS) if g == WITH_MONTHS else set())
    )


def fee_column(columns: list[str]) -> str | None:
    """The congestion charge, or ``extra`` where trips do not carry one."""
    return next((c for c in ("congestion_surcharge", "extra") if c in columns), None)


def with_time_columns(trips: DataFrame) -> DataFrame:
    """Add pickup hour, weekday and date to trips that come without them."""
    if "pickup_hour" in trips.columns or "tpep_pickup_datetime" not in trips.columns:
        return trips
    parts = tc.calendar_parts(F.col("pickup_ts"))
    wanted = ("pickup_hour", "pickup_day_of_week", "pickup_date")
    return trips.withColumn("pickup_ts", tc.pickup_time()).withColumns({k: parts[k] for k in wanted})


def _prepared(trips: DataFrame) -> DataFrame:
    trips = with_time_columns(trips)
    extra = {}
    if fee_column(trips.columns):
        extra[FEE] = F.col(fee_column(trips.columns))
    if {"tip_amount", "total_amount"} <= set(trips.columns):
        extra["tip_share"] = tc.tip_share(F.col("tip_amount"), F.col("total_amount"))
    return trips.withColumns(extra) if extra else trips


def available_insights(trips: DataFrame) -> list[str]:
    """Tables the columns at hand allow; the others are left out, not failed."""
    columns = set(_prepared(trips).columns)
    return [name for name, spec in INSIGHTS.items() if spec.needs() <= columns]


def _shaped(
    spec: Insight,
    rows: DataFrame,
    keys: tuple[str, ...],
    count: Column,
    measured: Callable[[Measure], Column],
    have: set[str],
    fee_name: str | None,
) -> DataFrame:
    """Group, measure, name and order: the part both ways of computing share."""
    names = {key: shown for key, shown in zip(spec.keys, spec.key_names)}
    if fee_name:
        names[FEE] = fee_name
    measures = [
        (measured(m) if m.column in have else F.lit(None).cast("double")).alias(name)
        for name, m in spec.measures.items()
    ]
    table = rows.groupBy(*keys).agg(count.alias(spec.counted), *measures)
    shown = [names.get(key, key) for key in keys]
    table = table.toDF(*shown, spec.counted, *spec.measures)
    if spec.largest_first:
        return table.orderBy(F.desc(spec.largest_first), *shown)
    return table.orderBy(*shown)


def insight(trips: DataFrame, name: str, by_year: bool = False) -> DataFrame:
    """One insight table straight from cleaned trips.

    ``by_year`` splits ``monthly_trends`` by year; by default a month is the
    sum over all years.
    """
    spec = INSIGHTS[name]
    rows = _prepared(trips)
    have = set(rows.columns)
    missing = spec.needs() - have
    if missing:
        raise ValueError(f"{name} needs the columns {', '.join(sorted(missing))}")
    for flag in spec.only:
        rows = rows.where(F.col(flag))
    if spec.known:
        rows = rows.where(F.col(spec.known).isNotNull())
    keys = ("pickup_year", *spec.keys) if by_year and name == "monthly_trends" else spec.keys
    fee = fee_column(trips.columns)
    return _shaped(spec, rows, keys, F.count("*"), Measure.direct, have, fee)


def grouped_trips(trips: DataFrame, grouping: str, by_month: bool = False) -> DataFrame:
    """Sums and counts by the keys of one grouping, and by pickup month too where asked or needed.

    One scan of the keys and measures that its tables use, combined before the one shuffle.
    """
    rows = _prepared(trips)
    have = set(rows.columns)
    months = MONTH_KEYS if by_month or grouping == WITH_MONTHS else ()
    keys = [key for key in (*LATTICE[grouping], *months) if key in have]
    pairs = {
        m.pair: m
        for name, spec in INSIGHTS.items()
        if grouping_of(name) == grouping
        for m in spec.measures.values()
        if m.column in have and (m.when_known is None or m.when_known in have)
    }
    partials = [part for m in pairs.values() for part in m.partials()]
    return rows.groupBy(*keys).agg(F.count("*").alias("trips"), *partials)


def insight_partials(trips: DataFrame) -> dict[str, DataFrame]:
    """The three groupings of all trips."""
    return {grouping: grouped_trips(trips, grouping) for grouping in LATTICE}


def write_month_partials(trips: DataFrame, folder: str) -> None:
    """Write the groupings of some months of trips, each by pickup month, in place of what was
    there of these months."""

    def write(grouping: str) -> None:
        rows = grouped_trips(trips, grouping, by_month=True).hint("rebalance", *[F.col(k) for k in MONTH_KEYS])
        options = {"partitionOverwriteMode": "dynamic"}
        write_table(rows, f"{folder}/{grouping}", partition_by=MONTH_KEYS, options=options)

    side_by_side(write, LATTICE)


def month_partials(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The groupings as written, all months."""
    return {grouping: scan_cleaned(spark, f"{folder}/{grouping}") for grouping in LATTICE}


def from_partials(
    partials: dict[str, DataFrame], name: str, fee_name: str | None = None, by_year: bool = False
) -> DataFrame:
    """One insight table out of the groupings."""
    spec = INSIGHTS[name]
    rows = partials[grouping_of(name)]
    fields = rows.columns
    for flag in spec.only:
        rows = rows.where(F.col(flag))
    count = F.sum("trips")
    if spec.known:
        rows = rows.where(F.col(f"count_{spec.known}") > 0)
        count = F.sum(f"count_{spec.known}")
    have = {m.column for m in spec.measures.values() if f"sum_{m.pair}" in fields}
    keys = ("pickup_year", *spec.keys) if by_year and name == "monthly_trends" else spec.keys
    return _shaped(spec, rows, keys, count, Measure.merged, have, fee_name)


def tables_from_partials(
    partials: dict[str, DataFrame], names: list[str], fee_name: str | None
) -> dict[str, DataFrame]:
    return {name: from_partials(partials, name, fee_name) for name in names}


def insight_tables(
    trips: DataFrame, names: list[str] | None = None, folder: str | None = None
) -> dict[str, DataFrame]:
    """All tables from three narrow scans of the trips, none of which multiplies a row.

    The groupings are written to ``folder``, by default in the shared work folder, so the
    tables neither rescan the trips nor depend on an executor's memory. The tables read them
    until they are written.
    """
    names = names or available_insights(trips)
    spark = trips.sparkSession
    folder = folder or work_folder(spark, "insight-partials")
    needed = {grouping_of(name) for name in names}
    side_by_side(lambda g: grouped_trips(trips, g).write.parquet(f"{folder}/{g}"), needed)
    partials = {g: spark.read.parquet(f"{folder}/{g}") for g in needed}
    return tables_from_partials(partials, names, fee_column(trips.columns))
