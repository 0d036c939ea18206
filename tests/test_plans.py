"""The physical plans are the ones wanted at scale."""

import pytest

from farebox.operators.cleaning import clean_trips, cleaning_funnel, stage_counts
from farebox.plans.insights import LATTICE, grouped_trips, insight
from farebox.sources import lake
from farebox.sources.raw import scan_raw
from lakecheck import registry
from trip_rows import frame, trip

WRITES = {
    "scan_recorded",
    "reloaded_insights",
    "build_in_runs",
    "scan_raw",
    "scan_raw_months",
    "scan_cleaned",
    "scan_lookup_csv",
    "write_table",
    "write_cleaned",
    "lookup_tables",
    "register_lake",
    "table_audit",
    "build_lake",
    "lake_inventory",
    "reload_month",
    "scan_uneven_months",
    "table_columns",
}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, sf_dir):
    return scan_raw(spark, f"{registry.raw_lake(spark, sf_dir)}/raw")


def test_plain_tests_reach_the_raw_scan(raw):
    pushed = plan_of(clean_trips(raw)).split("PushedFilters: [")[1]
    for part in ("IsNotNull(tpep_pickup_datetime)", "IsNotNull(fare_amount)", "IsNotNull(total_amount)"):
        assert part in pushed or "..." in pushed
    scan = clean_trips(raw)._jdf.queryExecution().explainString(
        raw.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    line = next(text for text in scan.splitlines() if text.startswith("PushedFilters"))
    for part in (
        "GreaterThanOrEqual(fare_amount,0.0)",
        "GreaterThan(trip_distance,0.0)",
        "LessThanOrEqual(passenger_count,6.0)",
        "LessThan(tpep_pickup_datetime",
    ):
        assert part in line


def test_cleaning_shuffles_once_and_limits_copies_before(raw):
    plan = plan_of(clean_trips(raw))
    assert plan.count("Exchange") == 1
    assert plan.count("WindowGroupLimit") == 2
    before = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before
    assert "trip_speed_mph" not in before


def test_a_hot_group_of_copies_shrinks_before_the_shuffle(spark):
    copies = frame(spark, *[trip()] * 50).crossJoin(spark.range(2000)).drop("id").repartition(8)
    kept = clean_trips(copies)
    assert kept.count() == 1


def test_the_funnel_is_one_scan(raw):
    assert plan_of(cleaning_funnel(raw)).count("FileScan") == 1


def test_a_grouping_is_one_narrow_scan_and_one_shuffle(spark, raw, tmp_path):
    path = str(tmp_path / "cleaned")
    lake.write_cleaned(clean_trips(raw), path)
    trips = lake.scan_cleaned(spark, path)
    for grouping, columns in (("by_hour", 8), ("by_bill", 9), ("by_zone", 9)):
        plan = plan_of(grouped_trips(trips, grouping))
        assert plan.count("FileScan") == plan.count("Exchange") == 1
        assert "partial_count" in plan and "Expand" not in plan
        read = plan.split("ReadSchema: struct<")[1].split(">")[0]
        assert read.count(":") <= columns < len(trips.columns) / 2
    assert set(LATTICE) == {"by_hour", "by_bill", "by_zone"}
    one = plan_of(insight(trips, "trip_volume_by_hour"))
    read = one.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in read.split(",")} == {
        "trip_distance",
        "fare_amount",
        "total_amount",
        "pickup_hour",
    }


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - WRITES))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    for unwanted in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert unwanted not in plan


def test_months_are_gathered_before_columns_are_added(raw):
    plan = plan_of(clean_trips(raw, by_month=True))
    assert plan.count("Exchange") == 2
    assert "REBALANCE" in plan
    assert "trip_length_category" not in plan.split("Exchange")[1]


@pytest.mark.parametrize(
    "name", ["sql_trips_in_month", "sql_month_fare_by_payment_name", "sql_month_top_zones", "sql_date_range"]
)
def test_month_questions_read_their_month_only(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    partitions = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "pickup_year" in partitions and "pickup_month" in partitions


@pytest.mark.parametrize(
    "name", [q for q in registry.queries() if q.startswith(("sql_", "decode_", "view")) or q in ("key_metrics", "utilization")]
)
def test_questions_do_not_clean_again(spark, sf_dir, name):
    assert "Window" not in plan_of(registry.queries()[name](spark, sf_dir))


def test_the_funnel_of_the_batch_shuffles_counts_alone(raw):
    plan = plan_of(stage_counts(raw))
    assert plan.count("Exchange") == 1
    keys = plan.split("hashpartitioning(")[1].split("), ENSURE")[0]
    assert keys.count(",") == 1 and "tpep" not in keys and "locationid" not in keys.lower()


@pytest.mark.parametrize("name", ["sql_row_count", "sql_trips_in_month"])
def test_counts_come_from_footers(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    assert "PushedAggregation: [COUNT(*)]" in plan and "FileScan" not in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
