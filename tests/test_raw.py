import pytest
from pyspark.sql import functions as F

from farebox.sources import raw
from trip_rows import frame, trip


@pytest.mark.parametrize(
    ("selection", "months"),
    [
        (["01"], ["01"]),
        (["01-03"], ["01", "02", "03"]),
        (["03", "01", "01-02"], ["01", "02", "03"]),
        (["1-2"], ["01", "02"]),
        (["07-07"], ["07"]),
        (raw.DEFAULT_MONTHS, [f"{m:02d}" for m in range(1, 11)]),
    ],
)
def test_month_selection(selection, months):
    assert raw.months_from(selection) == months


@pytest.mark.parametrize("wrong", ["1", "03-01", "jan", "01-02-03", "1-", ""])
def test_wrong_month_selection(wrong):
    with pytest.raises(ValueError):
        raw.months_from([wrong])


@pytest.fixture(scope="module")
def uneven(spark, tmp_path_factory):
    """Three months that disagree: ids int or double, a column only one of them has."""
    base = tmp_path_factory.mktemp("raw")
    rows = frame(spark, trip(), trip(PULocationID=None))
    rows.write.parquet(f"{base}/year=2025/month=01")
    rows.withColumns(
        {
            "PULocationID": F.col("PULocationID").cast("double"),
            "passenger_count": F.col("passenger_count").cast("bigint"),
        }
    ).write.parquet(f"{base}/year=2025/month=02")
    rows.withColumn("airport_fee", F.lit(1.25)).write.parquet(f"{base}/year=2025/month=03")
    return str(base)


EVERY_MONTH = [(2025, "01"), (2025, "02"), (2025, "03")]


@pytest.mark.parametrize("months", [EVERY_MONTH, None])
def test_months_that_disagree_are_read_together(spark, uneven, months):
    trips = raw.scan_raw(spark, uneven, months)
    kinds = dict(trips.dtypes)
    assert kinds["PULocationID"] == "bigint"
    assert kinds["passenger_count"] == "double"
    assert kinds["month"] == "int"
    counts = {
        r.month: (r.n, r.zones, r.fees)
        for r in trips.groupBy("month")
        .agg(
            F.count("*").alias("n"),
            F.count("PULocationID").alias("zones"),
            F.count("airport_fee").alias("fees"),
        )
        .collect()
    }
    assert counts == {1: (2, 1, 0), 2: (2, 1, 0), 3: (2, 1, 2)}


def test_months_that_agree_keep_their_types(spark, uneven):
    trips = raw.scan_raw(spark, uneven, [(2025, "01")])
    assert dict(trips.dtypes)["PULocationID"] == "int"
    assert trips.columns[-2:] == ["year", "month"]


def test_zoneless_times_are_read_as_instants(spark, uneven):
    trips = raw.scan_raw(spark, uneven, [(2025, "01")])
    assert dict(trips.dtypes)["tpep_pickup_datetime"] == "timestamp"
    assert str(trips.head().tpep_pickup_datetime) == "2025-01-05 10:00:00"


def test_no_months(spark, uneven):
    with pytest.raises(ValueError):
        raw.scan_raw(spark, uneven, [])


def test_other_months_are_not_read(spark, uneven):
    trips = raw.scan_raw_months(spark, uneven, ["01"], 2025)
    plan = trips._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "month" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r.month for r in trips.select("month").collect()} == {1}
    assert raw.scan_raw_months(spark, uneven, ["01"], 2024).count() == 0


def test_files_with_other_columns_need_no_list(spark, tmp_path):
    """One scan, with a column that only some files have and one under two spellings."""
    frame(spark, trip()).withColumn("Airport_fee", F.lit(1.0)).write.parquet(f"{tmp_path}/year=2025/month=01")
    more = frame(spark, trip()).withColumns({"airport_fee": F.lit(2.0), "tolls_amount": F.lit(3.0)})
    more.write.parquet(f"{tmp_path}/year=2025/month=02")
    frame(spark, trip()).write.mode("append").parquet(f"{tmp_path}/year=2025/month=02")
    trips = raw.scan_raw(spark, str(tmp_path))
    totals = trips.agg(F.count("*"), F.sum("airport_fee"), F.sum("tolls_amount")).head()
    assert tuple(totals) == (3, 3.0, 3.0)


def test_months_found(spark, uneven):
    assert raw.raw_months(spark, uneven) == EVERY_MONTH
