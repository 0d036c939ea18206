from datetime import datetime
from math import nan

import pytest
from pyspark.sql import functions as F

from farebox.operators import cleaning as cl
from farebox.schema import CRITICAL_COLUMNS
from trip_rows import frame, trip


def at(hour, minute=0, second=0, micro=0, day=5, month=1, year=2025):
    return datetime(year, month, day, hour, minute, second, micro)


def test_missing_columns_are_named_before_any_job(spark):
    lacking = frame(spark, trip()).drop("fare_amount", "total_amount")
    with pytest.raises(ValueError, match="fare_amount, total_amount"):
        cl.require_columns(lacking)


def test_required_names_are_case_sensitive(spark):
    renamed = frame(spark, trip()).withColumnRenamed("fare_amount", "Fare_Amount")
    with pytest.raises(ValueError, match="fare_amount"):
        cl.require_columns(renamed)


def test_names_become_lower_case_with_underscores(spark):
    df = spark.createDataFrame([(1, 2)], "`Trip Distance` INT, VendorID INT")
    assert cl.standardize_columns(df).columns == ["trip_distance", "vendorid"]


def test_colliding_names_are_an_error(spark):
    df = spark.range(1).select(F.lit(1).alias("Trip Id"), F.lit(2).alias("trip_id"))
    with pytest.raises(ValueError, match="trip_id"):
        cl.standardize_columns(df)


@pytest.mark.parametrize("column", CRITICAL_COLUMNS)
def test_a_null_in_any_critical_column_drops_the_row(spark, column):
    kept = cl.drop_null_critical(frame(spark, trip(), trip(**{column: None})))
    assert kept.count() == 1


def test_nan_is_a_value(spark):
    rows = frame(spark, trip(fare_amount=nan))
    assert cl.drop_null_critical(rows).count() == 1
    assert cl.valid_fare_distance(rows).count() == 1
    assert cl.clean_trips(rows).count() == 1


def test_text_that_is_no_time_is_null_not_an_error(spark):
    df = spark.createDataFrame([("2025-01-05 10:00:00",), ("tomorrow",), (None,)], "t STRING")
    parsed = [row.t for row in cl.parse_ts(df, "t").collect()]
    assert parsed == [at(10), None, None]
    other = spark.createDataFrame([("05/01/2025 10h00",)], "t STRING")
    assert cl.parse_ts(other, "t", "dd/MM/yyyy HH'h'mm").head().t == at(10)


def test_a_malformed_pickup_text_drops_the_row(spark):
    rows = frame(spark, trip(), trip(fare_amount=9.0))
    text = F.when(F.col("fare_amount") == 9.0, "soon").otherwise(
        F.col("tpep_pickup_datetime").cast("string")
    )
    assert cl.valid_times(rows.withColumn("tpep_pickup_datetime", text)).count() == 1


@pytest.mark.parametrize(
    ("pickup", "dropoff", "kept"),
    [
        (at(10), at(10), False),
        (at(10), at(9), False),
        (at(10), at(10, 0, 1), True),
        (at(10, day=31, month=12), at(23, 59, 59, day=31, month=12), True),
        (at(10, day=31, month=12), at(23, 59, 59, 500000, day=31, month=12), True),
        (at(10, day=31, month=12), at(0, day=1, month=1, year=2026), False),
        (at(1, year=1970), at(2, year=1970), True),
    ],
)
def test_times(spark, pickup, dropoff, kept):
    rows = frame(spark, trip(tpep_pickup_datetime=pickup, tpep_dropoff_datetime=dropoff))
    assert cl.valid_times(rows).count() == int(kept)


def test_the_last_valid_second_can_be_moved(spark):
    rows = frame(spark, trip())
    assert cl.valid_times(rows, "2025-01-05 10:15:00").count() == 0
    assert cl.clean_trips(rows, cl.TripRules(last_second="2024-12-31 23:59:59")).count() == 0


def timed(spark, pickup, dropoff, **changes):
    rows = frame(spark, trip(tpep_pickup_datetime=pickup, tpep_dropoff_datetime=dropoff, **changes))
    return cl.trip_duration(cl.valid_times(rows))


def test_duration_counts_whole_seconds(spark):
    minutes = timed(spark, at(10, 0, 0, 900000), at(10, 1, 0, 100000)).head()
    assert minutes.trip_duration_minutes == 1.0


def test_a_daylight_saving_night_is_as_long_as_the_clock_says(spark):
    night = timed(spark, at(1, 30, day=9, month=3), at(3, 30, day=9, month=3))
    assert night.head().trip_duration_minutes == 120.0


@pytest.mark.parametrize(
    ("dropoff", "kept"),
    [
        (at(10, 0, 59), False),
        (at(10, 1, 0), True),
        (at(10, 0, 0, day=6), True),
        (at(10, 0, 1, day=6), False),
    ],
)
def test_duration_bounds_are_inclusive(spark, dropoff, kept):
    assert cl.valid_duration(timed(spark, at(10), dropoff)).count() == int(kept)


@pytest.mark.parametrize(
    ("miles", "kept"), [(1.0, True), (0.99, False), (100.0, True), (100.01, False), (nan, False)]
)
def test_speed_bounds_are_inclusive(spark, miles, kept):
    hour = cl.trip_speed(timed(spark, at(10), at(11), trip_distance=miles))
    assert cl.valid_speed(hour).count() == int(kept)


def test_no_duration_means_no_speed_and_no_speed_passes(spark):
    still = spark.createDataFrame([(1.0, 0.0), (1.0, None)], "trip_distance DOUBLE, trip_duration_minutes DOUBLE")
    fast = cl.trip_speed(still)
    assert [row.trip_speed_mph for row in fast.collect()] == [None, None]
    assert cl.valid_speed(fast).count() == 2


def test_fare_and_distance(spark):
    rows = frame(
        spark, trip(fare_amount=0.0), trip(fare_amount=-0.01), trip(trip_distance=0.0), trip()
    )
    assert cl.valid_fare_distance(rows).count() == 2


def test_passengers(spark):
    rows = frame(spark, *[trip(passenger_count=float(n)) for n in (-1, 0, 6, 7)])
    kept = [r.passenger_count for r in cl.valid_passengers(rows).collect()]
    assert sorted(kept) == [0.0, 6.0]


def test_the_same_copy_survives_whatever_the_order(spark):
    copies = [trip(tip_amount=t, total_amount=20.0 + t) for t in (5.0, 3.0, 9.0)]
    for order in (copies, copies[::-1]):
        df = cl.standardize_columns(frame(spark, *order)).repartition(3, "tip_amount")
        kept = cl.dedup_trips(df).collect()
        assert [(r.tip_amount, r.total_amount) for r in kept] == [(3.0, 23.0)]


def test_null_zones_are_equal_when_looking_for_copies(spark):
    rows = frame(spark, trip(PULocationID=None), trip(PULocationID=None), trip())
    assert cl.dedup_trips(cl.standardize_columns(rows)).count() == 2


def test_copies_are_found_on_the_columns_there_are(spark):
    rows = cl.standardize_columns(frame(spark, trip(), trip(fare_amount=30.0)))
    assert cl.dedup_trips(rows.drop("fare_amount")).count() == 1
    assert cl.dedup_trips(rows.select("vendorid", "extra")).count() == 2


def test_calendar(spark):
    row = cl.temporal_features(cl.valid_times(frame(spark, trip()))).head()
    assert (row.pickup_year, row.pickup_month, row.pickup_day) == (2025, 1, "5")
    assert (row.pickup_hour, row.pickup_day_of_week, row.pickup_date) == (10, 1, "2025-01-05")


def test_tip_percentage(spark):
    rows = frame(
        spark,
        trip(total_amount=0.0),
        trip(total_amount=-5.0),
        trip(total_amount=None),
        trip(tip_amount=None),
        trip(),
    )
    assert [r.tip_percentage for r in cl.tip_percentage(rows).collect()] == [0.0, 0.0, 0.0, None, 20.0]


def test_length_bands(spark):
    rows = frame(spark, *[trip(trip_distance=m) for m in (1.99, 2.0, 4.99, 5.0, None)])
    bands = [r.trip_length_category for r in cl.trip_length_category(rows).collect()]
    assert bands == ["short", "medium", "medium", "long", "long"]


def test_airport_flags_follow_sql_nulls(spark):
    rows = cl.standardize_columns(
        frame(
            spark,
            trip(PULocationID=None, DOLocationID=2),
            trip(PULocationID=None, DOLocationID=200),
            trip(PULocationID=1, DOLocationID=200),
        )
    )
    flags = [
        (r.is_airport_pickup, r.is_airport_dropoff, r.is_airport_trip)
        for r in cl.airport_flags(rows).collect()
    ]
    assert flags == [(None, True, True), (None, False, None), (True, False, True)]
    jfk = cl.airport_flags(rows, (132, 200)).where("is_airport_dropoff").count()
    assert jfk == 2


def test_airport_flags_need_their_columns(spark):
    rows = cl.standardize_columns(frame(spark, trip()))
    one_end = cl.airport_flags(rows.drop("dolocationid"))
    assert "is_airport_pickup" in one_end.columns
    assert "is_airport_trip" not in one_end.columns


def test_quality_flags_keep_rows(spark):
    rows = cl.standardize_columns(frame(spark, trip(DOLocationID=None), trip(payment_type=None)))
    flags = [(r.has_valid_locations, r.has_valid_payment) for r in cl.quality_flags(rows).collect()]
    assert flags == [(False, True), (True, False)]


def test_single_steps_and_the_whole_agree(spark, sf_dir):
    from lakecheck.trips import raw_trips

    raw = raw_trips(spark, sf_dir)
    steps = cl.standardize_columns(cl.require_columns(raw))
    for step in (
        cl.drop_null_critical,
        cl.valid_times,
        cl.trip_duration,
        cl.valid_duration,
        cl.trip_speed,
        cl.valid_speed,
        cl.valid_fare_distance,
        cl.valid_passengers,
        cl.dedup_trips,
        cl.temporal_features,
        cl.tip_percentage,
        cl.trip_length_category,
        cl.airport_flags,
        cl.quality_flags,
    ):
        steps = steps.transform(step)
    whole = cl.clean_trips(raw)
    assert whole.columns == steps.columns
    assert whole.exceptAll(steps).count() == 0
    assert steps.exceptAll(whole).count() == 0


def test_cleaning_cleaned_trips_removes_nothing(spark, sf_dir):
    from lakecheck.trips import raw_trips

    once = cl.clean_trips(raw_trips(spark, sf_dir))
    assert cl.clean_trips(once).count() == once.count()


# Expected numbers were worked out by two engines before this code was written.
@pytest.mark.parametrize(
    ("scale", "left"),
    [
        ("0.001", [6116, 6022, 5740, 5619, 5122, 5057, 3956, 3886]),
        ("0.01", [61176, 60357, 57361, 56415, 51298, 50716, 39505, 38778]),
    ],
)
def test_funnel(spark, scale, left):
    from lakecheck.trips import raw_trips

    rows = cl.cleaning_funnel(raw_trips(spark, f"/root/testdata/sf{scale}")).collect()
    assert [r.rows_left for r in rows] == left
    assert [r.rows_removed for r in rows] == [0, *[a - b for a, b in zip(left, left[1:])]]


def test_funnel_of_nothing(spark):
    rows = cl.cleaning_funnel(frame(spark, trip()).where("false")).collect()
    assert [r.rows_left for r in rows] == [0] * 8


def test_funnel_counts_what_the_steps_keep_on_odd_rows(spark):
    rows = frame(
        spark,
        trip(),
        trip(tip_amount=1.0),
        trip(PULocationID=None),
        trip(PULocationID=None),
        trip(fare_amount=None),
        trip(fare_amount=nan),
        trip(passenger_count=7.0),
        trip(trip_distance=500.0),
    )
    left = [r.rows_left for r in cl.cleaning_funnel(rows).collect()]
    assert left == [8, 7, 7, 7, 6, 6, 5, 3]
    assert cl.clean_trips(rows).count() == 3
