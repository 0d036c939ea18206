"""The batch in runs of months: resumed, counted on the way, reading what it must, replacing safely."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from farebox.operators.cleaning import cleaning_funnel
from farebox.plans import batch
from farebox.plans.batch import build_lake, picked_up_in, runs_of
from farebox.plans.insights import INSIGHTS
from farebox.sources import catalog, lake, raw_files
from farebox.sources.raw import scan_raw
from lakecheck.registry import lookup_frames, raw_lake
from test_lake import in_database, month_file, on_day
from trip_rows import frame, trip

STRAYS = {
    1: [on_day(1, d) for d in range(1, 9)] + [on_day(12, 31, fare_amount=7.0)],
    2: [on_day(2, 3), on_day(1, 8), on_day(1, 31), on_day(2, 3)],
    3: [on_day(3, 1), on_day(3, 2, trip_distance=0.0), trip(tpep_pickup_datetime=None), on_day(2, 28)],
    4: [on_day(4, 4, passenger_count=None), on_day(4, 5)],
}


def files_at(spark, root, months=STRAYS):
    for month, rows in months.items():
        month_file(spark, root, month, *rows)
    return root


def trips_of(spark, root, table=None):
    trips = spark.table(table) if table else lake.scan_cleaned(spark, f"{root}/{catalog.CLEANED}")
    return sorted(map(str, trips.select(sorted(trips.columns)).collect()))


def insights_of(spark, root):
    return {
        name: [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in spark.read.parquet(f"{root}/insights/{name}").collect()]
        for name in INSIGHTS
    }


def sorted_insights(spark, root):
    return {name: sorted(rows, key=repr) for name, rows in insights_of(spark, root).items()}


@pytest.fixture(scope="module")
def lookups(spark, sf_dir):
    return lookup_frames(spark, sf_dir)


@pytest.fixture(scope="module")
def at_once(spark, lookups, tmp_path_factory):
    root = files_at(spark, str(tmp_path_factory.mktemp("at-once")))
    return root, build_lake(spark, root, lookups)


def test_runs_hold_whole_months_in_order():
    sizes = {(2024, 12): 5, (2025, 2): 4, (2025, 1): 3, (2025, 3): 50, (2025, 4): 1, (2001, 1): 0}
    assert runs_of(sizes, 8) == [[(2001, 1), (2024, 12), (2025, 1)], [(2025, 2)], [(2025, 3)], [(2025, 4)]]
    assert runs_of({}, 8) == []
    assert runs_of(sizes, 0) == [[(2001, 1)], [(2024, 12)], [(2025, 1)], [(2025, 2)], [(2025, 3)], [(2025, 4)]]


def test_months_of_any_year_are_ranges(spark):
    rows = spark.sql(
        "SELECT explode(array('2024-12-31 23:59:59.999999', '2025-01-01 00:00:00', '0001-05-02 00:00:00', "
        "'+12024-03-31 12:00:00', '2025-02-28 23:59:59')) AS t"
    ).select(F.col("t").cast("timestamp").alias("tpep_pickup_datetime"))
    for months, n in (([(2024, 12)], 1), ([(2025, 1), (2025, 2)], 2), ([(1, 5)], 1), ([(12024, 3)], 1), ([], 0)):
        assert rows.where(picked_up_in(months)).count() == n


def test_a_build_in_runs_equals_one_at_once(spark, lookups, at_once, tmp_path):
    root = files_at(spark, str(tmp_path))
    built = build_lake(spark, root, lookups, run_bytes=1)
    assert trips_of(spark, root) == trips_of(spark, at_once[0])
    assert sorted_insights(spark, root) == sorted_insights(spark, at_once[0])
    assert built.funnel.collect() == at_once[1].funnel.collect()
    whole = cleaning_funnel(scan_raw(spark, f"{root}/raw"))
    assert [tuple(r) for r in built.funnel.orderBy("stage_no").collect()] == [tuple(r) for r in whole.collect()]


def test_the_width_follows_the_run(spark, sf_dir, lookups, tmp_path, monkeypatch):
    widths = []
    write = batch.write_cleaned

    def written(trips, *args, **kwargs):
        plan = trips._jdf.queryExecution().executedPlan().toString()
        widths.append(int(re.findall(r"hashpartitioning\(tpep_pickup_datetime.*?, (\d+)\), ENSURE", plan)[0]))
        write(trips, *args, **kwargs)

    monkeypatch.setattr(batch, "write_cleaned", written)
    from farebox import session

    monkeypatch.setattr(session, "TARGET_PARTITION_BYTES", 2000)
    raw = scan_raw(spark, f"{raw_lake(spark, sf_dir)}/raw").where("year = 2024")
    lake.write_table(raw.hint("rebalance", "year", "month"), f"{tmp_path}/raw", partition_by=("year", "month"))
    size = sum(f.stat().st_size for f in (tmp_path / "raw").rglob("*.parquet"))
    build_lake(spark, str(tmp_path), lookups, run_bytes=size // 4)
    assert 3 < len(widths) < 8 and max(widths) < 3 * size / 2000 / 2


class Stopped(Exception):
    pass


@pytest.mark.parametrize("stop_in", ["clean", "put_in_place", "write_insights"])
def test_a_stopped_batch_goes_on_where_it_was(spark, lookups, at_once, tmp_path, monkeypatch, stop_in):
    root = files_at(spark, str(tmp_path))
    cleaned = []
    clean, put = batch._Batch.clean, batch._Batch.put_in_place

    def clean_three(self, run, *rest):
        if stop_in == "clean" and run == 2 and cleaned.count(2) == 0:
            cleaned.append(2)
            raise Stopped
        clean(self, run, *rest)
        cleaned.append(run)

    def put_some(self, staged, months, there):
        put(self, staged, months, there)
        if stop_in == "put_in_place" and len(cleaned) == 2 and not stopped:
            stopped.append(1)
            raise Stopped

    stopped = []
    monkeypatch.setattr(batch._Batch, "clean", clean_three)
    monkeypatch.setattr(batch._Batch, "put_in_place", put_some)
    with monkeypatch.context() as insights_fail:
        if stop_in == "write_insights":
            insights_fail.setattr(batch, "write_insights", lambda *_: (_ for _ in ()).throw(Stopped()))
        with pytest.raises(Stopped):
            build_lake(spark, root, lookups, run_bytes=1)
    before = list(cleaned)
    built = build_lake(spark, root, lookups, run_bytes=1)
    again = cleaned[len(before):]
    assert sorted({*before, *again}) == list(range(5))
    assert again == {"clean": [2, 3, 4], "put_in_place": [2, 3, 4], "write_insights": []}[stop_in]
    assert trips_of(spark, root) == trips_of(spark, at_once[0])
    assert sorted_insights(spark, root) == sorted_insights(spark, at_once[0])
    assert built.funnel.collect() == at_once[1].funnel.collect()
    assert not (tmp_path / "processed/batch").exists()


def test_a_stopped_batch_starts_anew_when_files_have_changed(spark, lookups, tmp_path, monkeypatch):
    """What the stopped one has put in place is replaced, though its files are other ones now."""
    root, other = (files_at(spark, str(tmp_path / name)) for name in ("one", "other"))
    build_lake(spark, root, lookups)
    month_file(spark, root, 2, on_day(1, 15, fare_amount=9.0), on_day(2, 3))
    put = batch._Batch.put_in_place
    with monkeypatch.context() as patch:
        patch.setattr(batch._Batch, "put_in_place", lambda *a: (put(*a), (_ for _ in ()).throw(Stopped()))[0])
        with pytest.raises(Stopped):
            build_lake(spark, root, lookups, months=[(2025, "02")], only_given_months=True, run_bytes=1)
    for place in (root, other):
        month_file(spark, place, 2, on_day(2, 3), on_day(2, 4))
        month_file(spark, place, 4, on_day(4, 9))
    build_lake(spark, root, lookups, months=[(2025, "04")], only_given_months=True)
    build_lake(spark, root, lookups, months=[(2025, "02")], only_given_months=True)
    build_lake(spark, other, lookups)
    assert trips_of(spark, root) == trips_of(spark, other)
    assert sorted_insights(spark, root) == sorted_insights(spark, other)


def test_raw_rows_are_read_once_and_counted_on_the_way(spark, lookups, tmp_path, monkeypatch):
    root = files_at(spark, str(tmp_path), {1: STRAYS[1], 2: STRAYS[2]})
    plans, asked = [], []
    write, read = batch.write_cleaned, batch.read_files

    def written(trips, *args, **kwargs):
        plans.append(trips._jdf.queryExecution().executedPlan().toString())
        write(trips, *args, **kwargs)

    monkeypatch.setattr(batch, "write_cleaned", written)
    monkeypatch.setattr(batch, "read_files", lambda *a: asked.append(1) or read(*a))
    monkeypatch.setattr(batch, "stage_counts", lambda *_: pytest.fail("raw trips are scanned again"))
    build_lake(spark, root, lookups)
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and "CollectMetrics" in plans[0]
    assert len(asked) == 2  # of the run, and of the trips without a time, of which there are none


def test_finding_the_months_reads_pickup_times_alone(spark, tmp_path):
    root = files_at(spark, str(tmp_path))
    plan = raw_files.record(spark, f"{root}/raw")._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet.*?ReadSchema: struct<([^>]*)>", plan, re.S)
    assert scans == ["tpep_pickup_datetime:timestamp"]


def test_counts_are_checked_and_taken_again(spark, lookups, at_once, tmp_path, monkeypatch):
    """Rows counted twice, as when a task ran again, do not reach the funnel."""
    root = files_at(spark, str(tmp_path))
    real = batch.Observation

    class Doubled:
        def __init__(self):
            self.real = real()

        @property
        def get(self):
            return {name: 2 * n for name, n in self.real.get.items()}

    clean = batch.clean_trips
    monkeypatch.setattr(batch, "Observation", Doubled)
    monkeypatch.setattr(
        batch, "clean_trips", lambda raw, rules, by_month, counts: clean(raw, rules, by_month=by_month, counts=counts.real)
    )
    assert build_lake(spark, root, lookups).funnel.collect() == at_once[1].funnel.collect()


def test_a_reload_opens_only_files_with_touched_months(spark, lookups, tmp_path, monkeypatch):
    root = files_at(spark, str(tmp_path))
    build_lake(spark, root, lookups)
    month_file(spark, root, 4, on_day(4, 5), on_day(4, 6), on_day(3, 2))
    read, opened, looked_at = batch.read_files, set(), []
    alike = raw_files.read_alike

    def noted(files, *rest):
        opened.update(row.file.split("/month=")[1][:2] for row in files.select("file").distinct().collect())
        return read(files, *rest)

    monkeypatch.setattr(batch, "read_files", noted)
    monkeypatch.setattr(raw_files, "read_alike", lambda s, b, columns: looked_at.append(set(columns)) or alike(s, b, columns))
    build_lake(spark, root, lookups, months=[(2025, "04")], only_given_months=True)
    assert opened == {"03", "04"}
    assert len(looked_at[0]) == len(list((tmp_path / "raw/year=2025/month=04").glob("*.parquet")))


def test_known_files_are_not_opened_again(spark, tmp_path, monkeypatch):
    root = files_at(spark, str(tmp_path / "a lake+1"))
    kept = str(tmp_path / "record")
    lake.write_table(raw_files.record(spark, f"{root}/raw"), kept)
    before = raw_files.read_record(spark, kept)
    monkeypatch.setattr(raw_files, "trip_columns", lambda *_: pytest.fail("a footer is read"))
    monkeypatch.setattr(raw_files, "read_alike", lambda *_: pytest.fail("a file is read"))
    again = raw_files.record(spark, f"{root}/raw", [kept])
    assert sorted(map(str, again.collect())) == sorted(map(str, before.collect()))
    monkeypatch.undo()
    assert raw_files.read_files(before, f"{root}/raw").count() == 19


def test_empty_files_and_months_without_believable_trips(spark, lookups, tmp_path):
    root = files_at(spark, str(tmp_path), {1: STRAYS[1], 2: [on_day(2, 3, trip_distance=0.0)]})
    frame(spark, trip()).limit(0).write.parquet(f"{root}/raw/year=2025/month=05")
    for only in (False, True):
        built = build_lake(spark, root, lookups, months=[(2025, "01"), (2025, "02"), (2025, "05")], only_given_months=only)
        assert len(trips_of(spark, root)) == 9 and built.funnel.collect()[0].rows_left == 10


def months_in(spark, table):
    return {tuple(r) for r in spark.table(table).groupBy("pickup_year", "pickup_month").count().collect()}


def test_a_run_that_keeps_no_trip(spark, lookups, tmp_path):
    late = {"tpep_pickup_datetime": datetime(2026, 2, 3, 9), "tpep_dropoff_datetime": datetime(2026, 2, 3, 10)}
    month_file(spark, str(tmp_path), 1, trip(), trip(trip_distance=0.0))
    month_file(spark, str(tmp_path), 2, trip(**late), trip(**late, passenger_count=None))
    built = build_lake(spark, str(tmp_path), lookups, run_bytes=0)
    assert {(r.stage, r.rows_left) for r in built.funnel.collect()} == {
        ("raw", 4), ("nulls", 3), ("times", 2), ("duration", 2), ("speed", 1), ("fare_distance", 1), ("passengers", 1), ("dedup", 1)
    }
    assert len(trips_of(spark, str(tmp_path))) == 1


def test_a_failure_between_two_months_leaves_each_old_or_new(spark, lookups, tmp_path, monkeypatch):
    root, other = (files_at(spark, str(tmp_path / name)) for name in ("one", "other"))
    table = in_database(spark, "pointed", tmp_path) + ".trips"
    build_lake(spark, root, lookups, table=table)
    before = months_in(spark, table)
    for place in (root, other):
        month_file(spark, place, 2, on_day(2, 3), on_day(2, 4), on_day(3, 9), on_day(1, 30), on_day(1, 31))
    after = {(2025, 1, 10), (2025, 2, 3), (2025, 3, 2), (2025, 4, 1), (2025, 12, 1)}
    point, moved = catalog.point_month, []

    def fails_second(spark, table, month, folder):
        if len(moved) == 1:
            raise Stopped
        moved.append(month)
        point(spark, table, month, folder)

    with monkeypatch.context() as patch:
        patch.setattr(catalog, "point_month", fails_second)
        with pytest.raises(Stopped):
            build_lake(spark, root, lookups, months=[(2025, "02")], only_given_months=True, table=table)
    between = months_in(spark, table)
    assert {m[:2] for m in between} == {m[:2] for m in before}
    assert between <= before | after and between != before and between != after
    build_lake(spark, root, lookups, months=[(2025, "02")], only_given_months=True, table=table)
    assert months_in(spark, table) == after
    build_lake(spark, other, lookups)
    assert trips_of(spark, root, table) == trips_of(spark, other)
    assert sorted_insights(spark, root) == sorted_insights(spark, other)
    places = {r.f for r in spark.table(table).select(F.regexp_extract("_metadata.file_path", "^(.*)/pickup_year", 1).alias("f")).distinct().collect()}
    assert len(places) == 2
    staged = tmp_path / "one/processed/trips_cleaned_months"
    assert {folder.name for folder in staged.iterdir()} == {place.rsplit("/", 1)[-1] for place in places}


def test_a_failed_renaming_is_taken_back(spark, lookups, tmp_path):
    root = files_at(spark, str(tmp_path))
    build_lake(spark, root, lookups)
    month = f"{root}/{catalog.CLEANED}/pickup_year=2025/pickup_month=1"
    with pytest.raises(OSError, match="cannot be renamed"):
        batch.replace_folder(spark, f"{root}/nowhere", month)
    assert len(trips_of(spark, root)) == 14


def test_columns_that_only_some_runs_have(spark, lookups, tmp_path):
    for name, size in (("one", 1), ("other", 10**9)):
        root = str(tmp_path / name)
        month_file(spark, root, 1, on_day(1, 2))
        more = frame(spark, on_day(2, 2)).withColumn("passenger_count", F.lit(1).cast("bigint")).withColumn("tolls", F.lit(1.0))
        more.drop("congestion_surcharge").write.parquet(f"{root}/raw/year=2025/month=02")
        build_lake(spark, root, lookups, run_bytes=size)
        trips = lake.scan_cleaned(spark, f"{root}/{catalog.CLEANED}").orderBy("pickup_ts").collect()
        assert [(r.passenger_count, r.tolls, r.congestion_surcharge) for r in trips] == [(1.0, None, 2.5), (1.0, 1.0, None)]


def test_a_month_gone_from_raw_goes_from_the_lake(spark, lookups, tmp_path):
    root = files_at(spark, str(tmp_path))
    build_lake(spark, root, lookups)
    month_file(spark, root, 3, on_day(3, 20) | {"tpep_dropoff_datetime": on_day(3, 20)["tpep_pickup_datetime"] + timedelta(0)})
    build_lake(spark, root, lookups)
    assert not [t for t in trips_of(spark, root) if "2025-03" in t]
    assert {r.pickup_month for r in spark.read.parquet(f"{root}/insights/monthly_trends").collect()} == {1, 2, 4, 12}
