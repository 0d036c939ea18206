import threading
import time

import pytest
from pyspark.sql import functions as F

from farebox.operators import decode, metrics
from farebox.operators.cleaning import clean_trips
from farebox.plans.insights import insight
from farebox.plans.questions import QUESTIONS, ask, create_catalog_views, create_views
from farebox.plans.sqlrun import OutOfTime, run_sql, table_columns
from farebox.sources import lake, lookups
from lakecheck.trips import raw_trips, zone_lookup
from trip_rows import frame, trip


@pytest.fixture(scope="module")
def trips(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cleaned") / "trips")
    lake.write_cleaned(clean_trips(raw_trips(spark, sf_dir)), path)
    return lake.scan_cleaned(spark, path)


def test_short_answers_come_whole(spark):
    answer = run_sql(spark, "SELECT id FROM range(100) ORDER BY id")
    assert [r.id for r in answer.rows] == list(range(100))
    assert answer.note == ""


def test_long_answers_are_cut_and_say_so(spark):
    answer = run_sql(spark, "SELECT id FROM range(250) ORDER BY id")
    assert [r.id for r in answer.rows] == list(range(100))
    assert str(answer).endswith("showing 100 of 250 rows")
    assert (answer.total, len(answer.rows)) == (250, 100)


def test_case_insensitive_match_and_listing(spark):
    spark.createDataFrame([("Newark Airport",), ("Astoria",)], "Zone STRING").createOrReplaceTempView("some_zones")
    assert len(run_sql(spark, "SELECT * FROM some_zones WHERE zone ILIKE '%AIRPORT%'").rows) == 1
    assert len(run_sql(spark, "SELECT * FROM some_zones WHERE zone NOT ILIKE '%AIRPORT%'").rows) == 1
    listed = table_columns(spark).where("table_name = 'some_zones'").collect()
    assert [(r.column_name, r.data_type) for r in listed] == [("Zone", "string")]
    assert run_sql(spark, "SHOW TABLES").columns


def test_unknown_codes_drop_out_unless_kept(spark):
    rows = spark.createDataFrame([(1, 10), (99, 20), (None, 30)], "payment_type INT, trip_count INT")
    payments = lookups.payment_types(spark)
    assert [r.payment_type_name for r in decode.decode_payment(rows, payments).collect()] == ["Credit card"]
    kept = decode.decode_payment(rows, payments, how="left").orderBy("trip_count").collect()
    assert [r.payment_type_name for r in kept] == ["Credit card", None, None]


def test_vendor_names(spark):
    rows = spark.createDataFrame([(6, 1.0)], "vendorid INT, total_revenue DOUBLE")
    assert decode.decode_vendor(rows, lookups.vendors(spark)).head().vendor_name == "Myle Technologies"


def test_zone_pairs_name_both_ends(spark, sf_dir):
    pairs = spark.createDataFrame(
        [(1, 2, 5), (1, None, 7)], "pickup_location_id INT, dropoff_location_id INT, trip_count INT"
    )
    zones = zone_lookup(spark, sf_dir)
    row = decode.decode_zone_pairs(pairs, zones).collect()
    assert [(r.pickup_zone, r.dropoff_zone, r.trip_count) for r in row] == [("NATION_1 0", "NATION_2 0", 5)]
    assert decode.decode_zone_pairs(pairs, zones, how="left").count() == 2


def test_zone_column_is_needed(spark, sf_dir):
    with pytest.raises(ValueError):
        decode.decode_zone(spark.range(1), zone_lookup(spark, sf_dir))


def test_lookups_are_broadcast_only_as_spark_sees_fit(spark):
    rows = spark.createDataFrame([(1, 1.0)], "vendorid INT, total_revenue DOUBLE")
    plan = decode.decode_vendor(rows, lookups.vendors(spark))._jdf.queryExecution().analyzed().toString()
    assert "hint" not in plan.lower()


def test_zones_of_one_name_are_one_row(spark):
    january = frame(
        spark,
        trip(PULocationID=1),
        trip(PULocationID=2),
        trip(PULocationID=3),
        trip(PULocationID=None),
    )
    zones = spark.createDataFrame(
        [(1, "Queens", "Corona", ""), (2, "Queens", "Corona", ""), (3, "Bronx", "Corona", "")],
        "LocationID INT, Borough STRING, Zone STRING, service_zone STRING",
    )
    tables = {"trips_cleaned": clean_trips(january), "taxi_zone_lookup": zones}
    rows = ask(spark, "sql_month_top_zones", tables).collect()
    assert [tuple(r) for r in rows] == [("Corona", "Queens", 2), ("Corona", "Bronx", 1)]


def test_sql_and_dataframe_forms_agree(spark, trips):
    payments = lookups.payment_types(spark)
    january = trips.where("pickup_year = 2025 AND pickup_month = 1")
    plain = (
        decode.decode_payment(january, payments)
        .groupBy("payment_type_name")
        .agg(F.avg("fare_amount").alias("avg_fare"))
    )
    tables = {"trips_cleaned": trips, "payment_type_lookup": payments}
    text = ask(spark, "sql_month_fare_by_payment_name", tables)
    ours = {r.payment_type_name: r.avg_fare for r in text.collect()}
    assert ours == pytest.approx({r.payment_type_name: r.avg_fare for r in plain.collect()})

    in_month = ask(spark, "sql_trips_in_month", {"trips_cleaned": trips}).head()[0]
    assert in_month == january.count() == metrics.trips_between(trips, "2025-01-01", "2025-02-01").count()


def test_every_question_names_known_tables():
    known = {"trips_cleaned", "payment_type_lookup", "taxi_zone_lookup", "vendor_lookup"}
    known |= {"revenue_by_payment_type"}
    for text in QUESTIONS.values():
        for name in text.split("{")[1:]:
            name = name.split("}")[0]
            assert name in known or name.startswith("view_")


def test_date_range_is_half_open_and_prunes(spark, trips):
    found = metrics.trips_between(trips, "2024-11-15", "2025-01-01")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "pickup_month" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    plain = trips.where("pickup_ts >= timestamp'2024-11-15' AND pickup_ts < timestamp'2025-01-01'")
    assert found.count() == plain.count() > 0


def test_metrics(spark, trips):
    row = metrics.key_metrics(trips).head()
    assert row.total_trips == trips.count()
    assert row.trips_per_day == pytest.approx(row.total_trips / trips.select("pickup_date").distinct().count())
    assert metrics.utilization(trips, "month").agg(F.sum("trip_count")).head()[0] == row.total_trips
    empty = metrics.key_metrics(trips.where("false")).head()
    assert (empty.total_trips, empty.avg_fare, empty.trips_per_hour) == (0, None, None)


def test_views(spark, trips):
    tables = {n: insight(trips, n) for n in ("trip_volume_by_zone", "trip_volume_by_hour")}
    assert set(create_views(tables)) == {"view_trip_volume_by_zone", "view_trip_volume_by_hour"}
    assert "location_id" in spark.table("view_trip_volume_by_zone").columns


def tags_of_active_jobs(spark):
    tracker = spark.sparkContext.statusTracker()
    return [job for job in tracker.getActiveJobsIds()]


def test_a_query_without_end_is_cancelled_and_others_go_on(spark, trips):
    others = []
    helper = threading.Thread(target=lambda: others.append(spark.range(3 * 10**9).where("id % 7 = 8").count()))
    helper.start()
    started = time.perf_counter()
    with pytest.raises(OutOfTime, match="1 seconds"):
        run_sql(spark, "SELECT count(*) FROM range(100000000000000) WHERE id % 1000003 % 7 = 8", seconds=1)
    assert time.perf_counter() - started < 20
    helper.join()
    assert others == [0]
    for _ in range(50):
        if not tags_of_active_jobs(spark):
            break
        time.sleep(0.1)
    assert tags_of_active_jobs(spark) == [] and not list(spark.sparkContext.getJobTags())
    assert run_sql(spark, "SELECT count(*) FROM {trips}", seconds=60, trips=trips).rows[0][0] == trips.count()


def test_an_error_in_time_is_itself(spark):
    with pytest.raises(Exception, match="nowhere"):
        run_sql(spark, "SELECT * FROM nowhere", seconds=60)


def test_a_long_sorted_answer_runs_once(spark, trips, monkeypatch):
    monkeypatch.setattr(type(trips), "count", lambda self: pytest.fail("counted by another run"))
    text = "SELECT pulocationid, dolocationid AS _place, fare_amount FROM {trips} ORDER BY 3 DESC, 1, 2"
    answer = run_sql(spark, text, max_rows=7, trips=trips)
    expected = spark.sql(text, trips=trips).collect()
    assert answer.rows == expected[:7] and answer.total == len(expected)
    assert answer.note == f"showing 7 of {len(expected)} rows" and answer.columns[1] == "_place"
    all_ = run_sql(spark, text, max_rows=len(expected), trips=trips)
    assert (all_.rows, all_.note) == (expected, "")


def test_two_columns_of_one_name(spark):
    answer = run_sql(spark, "SELECT id, id FROM range(500) ORDER BY id", max_rows=3)
    assert [tuple(r) for r in answer.rows] == [(0, 0), (1, 1), (2, 2)] and answer.total == 500


def test_views_of_the_catalog(spark, trips, tmp_path):
    for name in ("tables", "shown"):
        spark.sql(f"CREATE DATABASE view_{name} LOCATION '{tmp_path}/{name}'")
    insight(trips, "trip_volume_by_zone").write.saveAsTable("view_tables.trip_volume_by_zone")
    for _ in range(2):
        assert create_catalog_views(spark, "view_tables", "view_shown") == ["view_trip_volume_by_zone"]
    other = spark.newSession()
    shown = other.table("view_shown.view_trip_volume_by_zone")
    assert shown.columns[:2] == ["location_id", "trip_count"]
    assert shown.agg(F.sum("trip_count")).head()[0] == trips.count()
    assert create_catalog_views(spark, "view_tables") and spark.catalog.tableExists("view_tables.view_trip_volume_by_zone")
