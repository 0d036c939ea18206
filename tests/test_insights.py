import pytest
from pyspark.sql import functions as F

from farebox.operators.cleaning import clean_trips
from farebox.plans import insights as ins
from lakecheck.trips import raw_trips
from trip_rows import frame, trip


@pytest.fixture(scope="module")
def trips(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cleaned") / "trips")
    clean_trips(raw_trips(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def shared(trips):
    return ins.insight_tables(trips)


def near(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == pytest.approx(b, rel=1e-9, nan_ok=True)
    return a == b


def assert_same(one, other):
    assert one.columns == other.columns
    assert [d for _, d in one.dtypes] == [d for _, d in other.dtypes]
    left, right = one.collect(), other.collect()
    assert len(left) == len(right)
    for a, b in zip(left, right):
        assert all(near(x, y) for x, y in zip(a, b)), (a, b)


@pytest.mark.parametrize("name", ins.INSIGHTS)
def test_shared_scan_equals_own_scan(trips, shared, name):
    assert_same(shared[name], ins.insight(trips, name))


def test_counts_add_up_to_the_trips(trips, shared):
    rows = trips.count()
    for name in (
        "trip_volume_by_hour",
        "trip_volume_by_day",
        "monthly_trends",
        "trips_by_length_category",
        "revenue_by_time",
        "revenue_by_vendor",
        "zone_pair_analysis",
    ):
        assert shared[name].agg(F.sum("trip_count")).head()[0] == rows


def test_revenue_is_the_same_however_it_is_split(shared):
    sums = [
        shared[name].agg(F.sum("total_revenue")).head()[0]
        for name in (
            "monthly_trends",
            "revenue_by_payment_type",
            "revenue_by_time",
            "revenue_by_vendor",
        )
    ]
    assert sums == pytest.approx([sums[0]] * 4)


@pytest.mark.parametrize(
    ("missing", "absent"),
    [
        (["payment_type"], {"revenue_by_payment_type", "tip_analysis"}),
        (["vendorid"], {"revenue_by_vendor"}),
        (
            ["tip_amount"],
            {"revenue_by_payment_type", "revenue_by_time", "tip_analysis", "tip_by_time"},
        ),
        (["congestion_surcharge"], set()),
        (["congestion_surcharge", "extra"], {"congestion_fee_analysis"}),
        (["trip_speed_mph"], {"trip_speed_by_hour"}),
        (["trip_duration_minutes"], {"trip_duration_by_hour", "trip_duration_by_zone"}),
        (["pickup_month"], {"monthly_trends"}),
        (["trip_length_category"], {"trips_by_length_category"}),
        (
            ["dolocationid"],
            {"popular_dropoff_zones", "zone_pair_analysis", "airport_dropoff_zones"},
        ),
        (
            ["is_airport_trip"],
            {"airport_trip_analysis", "airport_pickup_zones", "airport_dropoff_zones"},
        ),
    ],
)
def test_a_missing_column_leaves_its_tables_out(trips, missing, absent):
    lacking = trips.drop(*missing)
    names = ins.available_insights(lacking)
    assert set(ins.INSIGHTS) - set(names) == absent
    tables = ins.insight_tables(lacking)
    assert list(tables) == names
    for name in names:
        assert_same(tables[name], ins.insight(lacking, name))
    for name in absent:
        with pytest.raises(ValueError, match=name):
            ins.insight(lacking, name)


def test_length_bands_without_durations_have_null_there(trips):
    table = ins.insight(trips.drop("trip_duration_minutes"), "trips_by_length_category")
    assert {r.avg_duration_minutes for r in table.collect()} == {None}


def test_the_fee_falls_back_to_extra(trips):
    table = ins.insight(trips.drop("congestion_surcharge"), "congestion_fee_analysis")
    assert table.columns[0] == "extra"
    assert table.count() == 4


def test_hours_are_made_when_trips_have_none(trips):
    bare = trips.drop("pickup_hour", "pickup_day_of_week", "pickup_date", "pickup_ts")
    assert_same(ins.insight(bare, "trip_volume_by_day"), ins.insight(trips, "trip_volume_by_day"))


def test_no_airport_trip_gives_empty_tables(spark):
    cleaned = clean_trips(frame(spark, trip()))
    tables = ins.insight_tables(cleaned)
    for name in ("airport_trip_analysis", "airport_pickup_zones", "airport_dropoff_zones"):
        assert tables[name].count() == 0
        assert ins.insight(cleaned, name).count() == 0


def test_null_zones_form_a_group_and_come_last_among_equals(spark):
    cleaned = clean_trips(
        frame(spark, trip(PULocationID=None), trip(PULocationID=7), trip(PULocationID=7, fare_amount=1.0))
    )
    for table in (
        ins.insight(cleaned, "trip_volume_by_zone"),
        ins.insight_tables(cleaned)["trip_volume_by_zone"],
    ):
        assert [(r.pulocationid, r.trip_count) for r in table.collect()] == [(7, 2), (None, 1)]


def test_months_merge_years_unless_asked(spark):
    later = trip()
    earlier = {
        **trip(),
        "tpep_pickup_datetime": later["tpep_pickup_datetime"].replace(year=2024),
        "tpep_dropoff_datetime": later["tpep_dropoff_datetime"].replace(year=2024),
    }
    cleaned = clean_trips(frame(spark, earlier, later))
    assert [r.trip_count for r in ins.insight(cleaned, "monthly_trends").collect()] == [2]
    partials = ins.insight_partials(cleaned)
    for table in (
        ins.insight(cleaned, "monthly_trends", by_year=True),
        ins.from_partials(partials, "monthly_trends", by_year=True),
    ):
        assert [(r.pickup_year, r.pickup_month) for r in table.collect()] == [(2024, 1), (2025, 1)]


def test_tip_percentage_is_the_mean_of_ratios(spark):
    cleaned = clean_trips(
        frame(
            spark,
            trip(tip_amount=10.0, total_amount=20.0),
            trip(tip_amount=0.0, total_amount=100.0, fare_amount=90.0),
        )
    )
    assert ins.insight(cleaned, "tip_analysis").head().avg_tip_percentage == 25.0


def test_unknown_speeds_do_not_count(spark):
    cleaned = clean_trips(frame(spark, trip(), trip(fare_amount=1.0, trip_distance=20.0)))
    half = cleaned.withColumn("trip_speed_mph", F.when(F.col("fare_amount") > 1, F.col("trip_speed_mph")))
    for table in (ins.insight(half, "trip_speed_by_hour"), ins.insight_tables(half)["trip_speed_by_hour"]):
        assert [(r.trip_count, r.avg_distance) for r in table.collect()] == [(1, 10.0)]


@pytest.mark.parametrize("name", ins.INSIGHTS)
def test_tables_from_months_written_one_by_one(spark, trips, shared, tmp_path_factory, name, written={}):
    if not written:
        folder = str(tmp_path_factory.mktemp("partials"))
        first = (F.col("pickup_year") == 2024) & (F.col("pickup_month") < 7)
        # Twice over: a month that is written again takes the place of what was there.
        for months in (first, ~first, first):
            ins.write_month_partials(trips.where(months), folder)
        written["partials"] = ins.month_partials(spark, folder)
    assert_same(ins.from_partials(written["partials"], name, "congestion_surcharge"), shared[name])


def test_every_table_is_in_one_grouping():
    for name, spec in ins.INSIGHTS.items():
        keys = set(ins.LATTICE[ins.grouping_of(name)]) | set(ins.MONTH_KEYS)
        assert set(spec.keys) | set(spec.only) <= keys
