"""Every capability as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.operators import cleaning as cl
from farebox.operators import decode, metrics
from farebox.plans.batch import Lake, build_lake
from farebox.plans.insights import INSIGHTS, insight
from farebox.plans.questions import QUESTIONS, VIEWS, ask, create_catalog_views, view_of
from farebox.plans.sqlrun import OutOfTime, run_sql, table_columns
from farebox.schema import CRITICAL_COLUMNS, TRIP_IDENTITY
from farebox.session import apply_settings, counting_session, work_folder
from farebox.sources import catalog, lake, lookups, raw, raw_files
from lakecheck.trips import raw_trips, zone_lookup

Query = Callable[[SparkSession, str], DataFrame]

SUMS = ("total_",)
MEANS = ("avg_", "trips_per_")


def mean_shown(name: str) -> Column:
    """Six decimals. A mean of cents can lie halfway; the nudge rounds it up everywhere."""
    return F.round(F.col(name) + 1e-9, 6).alias(name)


def presentable(df: DataFrame) -> DataFrame:
    """Round aggregates and write times as text, for comparison across engines."""
    shown = {}
    for name, kind in df.dtypes:
        if kind.startswith("timestamp"):
            shown[name] = F.date_format(name, "yyyy-MM-dd HH:mm:ss")
        elif kind == "double" and name.startswith(SUMS) and name != "total_amount":
            shown[name] = F.round(name, 2)
        elif kind == "double" and name.startswith(MEANS):
            shown[name] = mean_shown(name)
    return df.withColumns(shown) if shown else df


# --- cleaning steps, each after the ones before it ---

STEPS: list[tuple[str, Callable[[DataFrame], DataFrame], tuple[str, ...]]] = [
    ("require_columns", cl.require_columns, ()),
    ("standardize_columns", cl.standardize_columns, ()),
    ("drop_null_critical", cl.drop_null_critical, ()),
    ("valid_times", cl.valid_times, ("pickup_ts", "dropoff_ts")),
    ("trip_duration", cl.trip_duration, ("trip_duration_minutes",)),
    ("valid_duration", cl.valid_duration, ("trip_duration_minutes",)),
    ("trip_speed", cl.trip_speed, ("trip_speed_mph",)),
    ("valid_speed", cl.valid_speed, ("trip_speed_mph",)),
    ("valid_fare_distance", cl.valid_fare_distance, ()),
    ("valid_passengers", cl.valid_passengers, ("passenger_count",)),
    ("dedup_trips", cl.dedup_trips, ("vendorid", "payment_type", "total_amount")),
    (
        "temporal_features",
        cl.temporal_features,
        (
            "pickup_year",
            "pickup_month",
            "pickup_day",
            "pickup_hour",
            "pickup_day_of_week",
            "pickup_date",
        ),
    ),
    ("tip_percentage", cl.tip_percentage, ("tip_amount", "total_amount", "tip_percentage")),
    ("trip_length_category", cl.trip_length_category, ("trip_length_category",)),
    (
        "airport_flags",
        cl.airport_flags,
        ("is_airport_pickup", "is_airport_dropoff", "is_airport_trip"),
    ),
    ("quality_flags", cl.quality_flags, ("has_valid_locations", "has_valid_payment")),
]


def _step(upto: int, spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = raw_trips(spark, sf_dir)
    for _, step, _ in STEPS[: upto + 1]:
        trips = trips.transform(step)
    name, _, added = STEPS[upto]
    if name == "require_columns":
        trips = trips.select(*CRITICAL_COLUMNS)
    elif name != "standardize_columns":
        trips = trips.select(*TRIP_IDENTITY, *added)
    return presentable(trips)


def _parse_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times written as text, a seventh of them spoiled, and read again."""
    trips = cl.standardize_columns(raw_trips(spark, sf_dir))
    text = F.when(F.col("payment_type") == 6, F.lit("no time")).otherwise(
        F.date_format("tpep_pickup_datetime", "yyyy-MM-dd HH:mm:ss")
    )
    written = trips.select(text.alias("written"), text.alias("parsed"))
    return presentable(cl.parse_ts(written, "parsed"))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.clean_trips(raw_trips(spark, sf_dir))


def _clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(_cleaned(spark, sf_dir))


def _funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.cleaning_funnel(raw_trips(spark, sf_dir))


def _insight(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(insight(written_trips(spark, sf_dir), name))


# --- a lake on disk, written once per session and data set ---


def _once(make: Callable) -> Callable:
    """Keep what ``make`` returns for a session and data set."""
    made: dict = {}

    def get(spark: SparkSession, sf_dir: str):
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in made:
            made[key] = make(spark, sf_dir)
        return made[key]

    return get


@_once
def raw_lake(spark: SparkSession, sf_dir: str) -> str:
    root = work_folder(spark, "lake")
    pickup = F.col("tpep_pickup_datetime")
    trips = raw_trips(spark, sf_dir).withColumns(
        {"year": F.year(pickup), "month": F.format_string("%02d", F.month(pickup))}
    )
    rebalanced = trips.hint("rebalance", F.col("year"), F.col("month"))
    lake.write_table(rebalanced, f"{root}/{catalog.RAW}", partition_by=("year", "month"))
    return root


def lookup_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "payment_type_lookup": lookups.payment_types(spark),
        "vendor_lookup": lookups.vendors(spark),
        "taxi_zone_lookup": zone_lookup(spark, sf_dir),
    }


@_once
def built_lake(spark: SparkSession, sf_dir: str) -> Lake:
    return build_lake(spark, raw_lake(spark, sf_dir), lookup_frames(spark, sf_dir))


def written_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake.scan_cleaned(spark, built_lake(spark, sf_dir).tables["trips_cleaned"])


def written_insight(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(built_lake(spark, sf_dir).tables[name])


def _by_raw_month(trips: DataFrame) -> DataFrame:
    sums = (F.count("*").alias("trip_count"), F.sum("total_amount").alias("total_billed"))
    return presentable(trips.groupBy("year", "month").agg(*sums))


def _scan_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_raw_month(raw.scan_raw(spark, f"{raw_lake(spark, sf_dir)}/raw"))


def _scan_recorded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the record of files, the second time over, when none is new."""
    base, kept = f"{raw_lake(spark, sf_dir)}/raw", work_folder(spark, "raw-files")
    raw_files.scan_recorded(spark, base, kept)
    return _by_raw_month(raw_files.scan_recorded(spark, base, kept))


def _scan_raw_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = f"{raw_lake(spark, sf_dir)}/raw"
    return _by_raw_month(raw.scan_raw_months(spark, base, ["02", "04-06", "05"], 2024))


def _by_cleaned_month(trips: DataFrame) -> DataFrame:
    sums = (F.count("*").alias("trip_count"), F.sum("total_amount").alias("total_billed"))
    return presentable(trips.groupBy("pickup_year", "pickup_month").agg(*sums))


def _scan_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_cleaned_month(lake.scan_cleaned(spark, built_lake(spark, sf_dir).tables["trips_cleaned"]))


def _scan_lookup_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup through CSV files with the columns in another order, with the raw
    pickups in each zone."""
    path = work_folder(spark, "zones-csv")
    zones = zone_lookup(spark, sf_dir).select("service_zone", "Zone", "LocationID", "Borough")
    lake.write_table(zones, path, "csv", options={"header": "true"})
    pickups = raw_trips(spark, sf_dir).groupBy("PULocationID").agg(F.count("*").alias("pickups"))
    read = lookups.scan_lookup_csv(spark, path, "taxi_zone_lookup")
    joined = read.join(pickups, read.LocationID == pickups.PULocationID, "left").drop("PULocationID")
    return joined.fillna(0, ["pickups"])


def _write_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overwritten twice and appended to once, every row is there twice."""
    path = work_folder(spark, "by-vendor")
    vendors = raw_trips(spark, sf_dir).groupBy("VendorID").agg(F.count("*").alias("trip_count"))
    for mode in ("overwrite", "overwrite", "append"):
        lake.write_table(vendors, path, "json", mode)
    schema = "VendorID INT, trip_count BIGINT"
    stored = spark.read.schema(schema).json(path)
    return stored.groupBy("VendorID").agg(
        F.count("*").alias("copies"), F.max("trip_count").alias("trip_count")
    )


def _write_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written whole, then 2024 written again on its own."""
    path = work_folder(spark, "cleaned")
    trips = _cleaned(spark, sf_dir)
    lake.write_cleaned(trips, path)
    lake.write_cleaned(trips.where("pickup_year = 2024"), path, only_given_months=True)
    return _by_cleaned_month(lake.scan_cleaned(spark, path))


def _lookup_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each published code with its name and the cleaned trips that carry it."""
    paths = lookups.publish_lookups(lookup_frames(spark, sf_dir), work_folder(spark, "lookups"))
    trips = lake.scan_cleaned(spark, built_lake(spark, sf_dir).tables["trips_cleaned"])
    shapes = [
        ("payment_type_lookup", "payment_type_id", "payment_type_name", "payment_type"),
        ("vendor_lookup", "vendor_id", "vendor_name", "vendorid"),
        ("taxi_zone_lookup", "LocationID", "Zone", "pulocationid"),
    ]
    parts = []
    for table, code, name, column in shapes:
        used = trips.groupBy(F.col(column).alias("code")).agg(F.count("*").alias("trip_count"))
        named = spark.read.parquet(paths[table]).select(
            F.lit(table).alias("lookup"), F.col(code).alias("code"), F.col(name).alias("name")
        )
        parts.append(named.join(used, "code", "left").fillna(0, ["trip_count"]))
    return reduce(DataFrame.unionByName, parts)


@_once
def _registered(spark: SparkSession, sf_dir: str) -> str:
    built = built_lake(spark, sf_dir)
    name = "trip_lake_" + built.root.rsplit("-", 1)[-1][:8]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_folder(spark, 'database')}'")
    for _ in range(2):  # the second time finds every table in place
        catalog.register_lake(spark, built.root, name)
    return name


def _register_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _registered(spark, sf_dir)
    tables = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    parts = [
        spark.table(f"{database}.{t}").agg(F.count("*").alias("row_count")).select(
            F.lit(t).alias("table_name"),
            F.lit(any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{t}"))).alias(
                "is_partitioned"
            ),
            "row_count",
        )
        for t in tables
    ]
    return reduce(DataFrame.unionByName, parts)


def _table_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _registered(spark, sf_dir)
    expected = ["raw", "trips_cleaned", *INSIGHTS, *lookup_frames(spark, sf_dir), "never_written"]
    return catalog.table_audit(spark, expected, database)


def _lake_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw and cleaned partitions; files and bytes depend on the writer, so they are compared
    with the sums over the single files."""
    built = built_lake(spark, sf_dir)
    parts = []
    for layer, base, keys in (
        ("raw", f"{built.root}/raw", ("year", "month")),
        ("cleaned", built.tables["trips_cleaned"], ("pickup_year", "pickup_month")),
    ):
        found = lake.lake_inventory(spark, base, keys)
        place = "/" + "/".join(f"{key}=0*([0-9]+)" for key in keys) + "/"
        files = lake.lake_files(spark, base).select(
            *[F.regexp_extract("path", place, i + 1).cast("int").alias(key) for i, key in enumerate(keys)], "bytes"
        )
        summed = files.groupBy(*keys).agg(F.count("*").alias("files"), F.sum("bytes").alias("size"))
        parts.append(
            found.join(summed, list(keys), "full").select(
                F.lit(layer).alias("layer"),
                F.col(keys[0]).alias("year"),
                F.col(keys[1]).alias("month"),
                (F.col("file_count") > 0).alias("has_files"),
                (F.col("total_bytes") > 0).alias("has_bytes"),
                ((F.col("file_count") == F.col("files")) & (F.col("total_bytes") == F.col("size"))).alias("adds_up"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _long_form(table: DataFrame, name: str) -> DataFrame:
    """Every measure of every row: table_name, key, measure, value."""
    spec = INSIGHTS[name]
    measures = [spec.counted, *spec.measures]
    keys = [c for c in table.columns if c not in measures]
    key = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
    shown = presentable(table)
    pairs = F.array(
        *[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures]
    )
    return shown.select(F.lit(name).alias("table_name"), key.alias("key"), F.inline(pairs))


def _build_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key and measure of every insight table the batch wrote."""
    parts = [_long_form(written_insight(spark, sf_dir, name), name) for name in INSIGHTS]
    return reduce(DataFrame.unionByName, parts)


@_once
def _reloaded_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake whose month files hold some trips of neighbouring months, built without the
    trips of one file that are dearer than the rest, then reloaded with the whole file."""
    root = work_folder(spark, "reloaded")
    pickup = F.col("tpep_pickup_datetime")
    filed = F.when(F.hour(pickup) < 3, F.add_months(pickup, -1)).otherwise(F.to_date(pickup))
    trips = raw_trips(spark, sf_dir).withColumns(
        {"year": F.year(filed), "month": F.format_string("%02d", F.month(filed))}
    )
    changed = "year = 2024 AND month = '03'"

    def written(rows: DataFrame, mode: str) -> None:
        rows = rows.hint("rebalance", F.col("year"), F.col("month"))
        options = {"partitionOverwriteMode": "dynamic"}
        lake.write_table(rows, f"{root}/{catalog.RAW}", mode=mode, partition_by=("year", "month"), options=options)

    written(trips.where(f"NOT ({changed}) OR fare_amount < 15"), "overwrite")
    build_lake(spark, root, lookup_frames(spark, sf_dir))
    written(trips.where(changed), "overwrite")
    return build_lake(
        spark, root, lookup_frames(spark, sf_dir), months=[(2024, "03")], only_given_months=True
    )


def _reload_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = lake.scan_cleaned(spark, _reloaded_lake(spark, sf_dir).tables["trips_cleaned"])
    return presentable(
        trips.select(*TRIP_IDENTITY, "vendorid", "payment_type", "total_amount", "pickup_year", "pickup_month")
    )


def _reloaded_insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key and measure of every insight table after the reload of one month's file."""
    tables = _reloaded_lake(spark, sf_dir).tables
    parts = [_long_form(spark.read.parquet(tables[name]), name) for name in INSIGHTS]
    return reduce(DataFrame.unionByName, parts)


@_once
def _lake_in_runs(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake whose trips are a table of the catalog, cleaned in some ten runs of months, with
    one month reloaded after dear trips were added to its file."""
    root = work_folder(spark, "in-runs")
    pickup = F.col("tpep_pickup_datetime")
    trips = raw_trips(spark, sf_dir).withColumns(
        {"year": F.year(pickup), "month": F.format_string("%02d", F.month(pickup))}
    )
    changed = "year = 2023 AND month = '11'"
    options = {"partitionOverwriteMode": "dynamic"}
    for rows in (trips.where(f"NOT ({changed}) OR fare_amount < 15"), trips.where(changed)):
        rows = rows.hint("rebalance", F.col("year"), F.col("month"))
        lake.write_table(rows, f"{root}/{catalog.RAW}", partition_by=("year", "month"), options=options)
        size = lake.lake_files(spark, f"{root}/{catalog.RAW}").agg(F.sum("bytes")).head()[0]
        built = build_lake(
            spark,
            root,
            lookup_frames(spark, sf_dir),
            months=[(2023, "11")],
            only_given_months=True,
            run_bytes=size // 10,
            table="trips_" + root.rsplit("-", 1)[-1][:8],
        )
    return built


def _build_in_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_cleaned_month(spark.table(_lake_in_runs(spark, sf_dir).table))


@_once
def _uneven_lake(spark: SparkSession, sf_dir: str) -> str:
    """Raw months that disagree: whole passengers, an extra column, and one under two names."""
    root = work_folder(spark, "uneven")
    pickup = F.col("tpep_pickup_datetime")
    trips = raw_trips(spark, sf_dir).withColumns(
        {"year": F.year(pickup), "month": F.format_string("%02d", F.month(pickup))}
    )
    kinds = [
        ("year < 2022", {"Airport_fee": F.col("extra")}),
        ("year = 2022", {"passenger_count": F.col("passenger_count").cast("bigint"), "airport_fee": F.col("extra")}),
        ("year > 2022", {"PULocationID": F.col("PULocationID").cast("bigint"), "tolls_amount": F.col("tip_amount")}),
    ]
    for years, columns in kinds:
        rows = trips.where(years).withColumns(columns).hint("rebalance", F.col("year"), F.col("month"))
        lake.write_table(rows, f"{root}/{catalog.RAW}", mode="append", partition_by=("year", "month"))
    return f"{root}/{catalog.RAW}"


def _scan_uneven_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = raw.scan_raw(spark, _uneven_lake(spark, sf_dir))
    known = {"passengers": "passenger_count", "zones": "PULocationID", "fees": "airport_fee", "tolls": "tolls_amount"}
    return trips.groupBy("year", "month").agg(
        F.count("*").alias("trip_count"),
        *[F.count(column).alias(f"known_{name}") for name, column in known.items()],
        F.round(F.sum("passenger_count"), 2).alias("total_passengers"),
        F.round(F.sum("airport_fee"), 2).alias("total_fees"),
    )


# --- SQL ---


def _tables(spark: SparkSession, sf_dir: str, text: str) -> dict[str, DataFrame]:
    """The written tables that a query names, by name."""
    found = {"trips_cleaned": written_trips(spark, sf_dir), **lookup_frames(spark, sf_dir)}
    for name in INSIGHTS:
        if name in text or any(table == name and view in text for view, (table, _) in VIEWS.items()):
            found[name] = written_insight(spark, sf_dir, name)
    return found | {view: view_of(view, found) for view in VIEWS if view in text}


COUNTS = ("sql_row_count", "sql_trips_in_month")


def _count(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A question that file footers answer."""
    path = built_lake(spark, sf_dir).tables["trips_cleaned"]
    counting = counting_session(spark)
    return ask(counting, name, {"trips_cleaned": counting.read.parquet(path)})


def _question(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    if name in COUNTS:
        return _count(name, spark, sf_dir)
    return presentable(ask(spark, name, _tables(spark, sf_dir, QUESTIONS[name])))


def _date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """January 2025 by day, read from the written table so that months are pruned."""
    trips = written_trips(spark, sf_dir)
    january = metrics.trips_between(trips, "2025-01-01", "2025-02-01")
    return presentable(
        january.groupBy("pickup_date").agg(
            F.count("*").alias("trip_count"), F.sum("total_amount").alias("total_billed")
        )
    )


def _decode_payment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payment names for both insight tables that carry the code, and for trips."""
    trips, payments = written_trips(spark, sf_dir), lookups.payment_types(spark)
    by_code = trips.groupBy("payment_type").agg(F.count("*").alias("trip_count"))
    parts = [
        decode.decode_payment(rows, payments).select(
            F.lit(name).alias("table_name"), "payment_type", "payment_type_name", "trip_count"
        )
        for name, rows in (
            ("revenue_by_payment_type", written_insight(spark, sf_dir, "revenue_by_payment_type")),
            ("tip_analysis", written_insight(spark, sf_dir, "tip_analysis")),
            ("trips_cleaned", by_code),
        )
    ]
    return reduce(DataFrame.unionByName, parts)


def _decode_vendor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = written_insight(spark, sf_dir, "revenue_by_vendor")
    return presentable(decode.decode_vendor(rows, lookups.vendors(spark)))


def _decode_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned trips by vendor and zones: counted by code, then named, then summed by name."""
    zones = zone_lookup(spark, sf_dir)
    codes = written_trips(spark, sf_dir).groupBy("vendorid", "pulocationid", "dolocationid")
    trips = codes.agg(F.count("*").alias("trips"), F.sum("total_amount").alias("billed"))
    trips = decode.decode_vendor(trips, lookups.vendors(spark))
    trips = decode.decode_zone(trips, zones, "pulocationid", "pickup_")
    trips = decode.decode_zone(trips, zones, "dolocationid", "dropoff_")
    return presentable(
        trips.groupBy("vendor_name", "pickup_borough", "pickup_zone", "dropoff_borough").agg(
            F.sum("trips").alias("trip_count"), F.sum("billed").alias("total_billed")
        )
    )


def _utilization(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips in each hour, day and month that has any; days and months are summed from the hours."""
    hours = metrics.utilization(written_trips(spark, sf_dir), "hour").select("period", "trip_count")
    parts = [hours.select(F.lit("hour").alias("unit"), "period", "trip_count")]
    for unit in ("day", "month"):
        summed = hours.groupBy(F.date_trunc(unit, "period").alias("period")).agg(F.sum("trip_count").alias("trip_count"))
        parts.append(summed.select(F.lit(unit).alias("unit"), "period", "trip_count"))
    return presentable(reduce(DataFrame.unionByName, parts))


ZONE_TABLES = (
    "trip_volume_by_zone",
    "trip_duration_by_zone",
    "popular_pickup_zones",
    "popular_dropoff_zones",
    "airport_pickup_zones",
    "airport_dropoff_zones",
)


def _decode_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    zones = zone_lookup(spark, sf_dir)
    parts = []
    for name in ZONE_TABLES:
        rows = decode.decode_zone(written_insight(spark, sf_dir, name), zones)
        code = rows.columns[0]
        parts.append(
            rows.select(
                F.lit(name).alias("table_name"),
                F.col(code).alias("location_id"),
                "zone",
                "borough",
                F.col(INSIGHTS[name].counted).alias("trip_count"),
                mean_shown("avg_distance"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _decode_zone_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = written_insight(spark, sf_dir, "zone_pair_analysis")
    return presentable(decode.decode_zone_pairs(pairs, zone_lookup(spark, sf_dir)))


def _key_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return presentable(metrics.key_metrics(written_trips(spark, sf_dir)))


def _views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five views through SQL, as key, trips and mean fare."""
    insights = {name: written_insight(spark, sf_dir, name) for name, _ in VIEWS.values()}
    shown = {name: view_of(name, insights) for name in VIEWS}
    parts = [
        f"SELECT '{name}' AS view_name, CAST({view.columns[0]} AS STRING) AS view_key, "
        f"{view.columns[1]} AS trip_count, round(avg_fare + 1e-9, 6) AS avg_fare FROM {{{name}}}"
        for name, view in shown.items()
    ]
    return spark.sql(" UNION ALL ".join(parts), **shown)


@_once
def _database_of_views(spark: SparkSession, sf_dir: str) -> str:
    name = _registered(spark, sf_dir) + "_views"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{work_folder(spark, 'views')}'")
    for _ in range(2):  # the second time replaces them
        create_catalog_views(spark, _registered(spark, sf_dir), name)
    return name


def _catalog_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five views of the catalog, as key, trips and mean fare, each audited."""
    database = _database_of_views(spark, sf_dir)
    parts = [
        f"SELECT '{name}' AS view_name, CAST({spark.table(f'{database}.{name}').columns[0]} AS STRING) AS view_key, "
        f"trip_count_ AS trip_count, round(avg_fare + 1e-9, 6) AS avg_fare FROM {database}.{name}"
        .replace("trip_count_", spark.table(f"{database}.{name}").columns[1])
        for name in VIEWS
    ]
    audit = catalog.table_audit(spark, VIEWS, database).select(
        F.col("table_name").alias("view_name"), "present", "row_count"
    )
    return spark.sql(" UNION ALL ".join(parts)).join(audit, "view_name")


def _timed_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips of each hour, and a question without end over them, which is cancelled."""
    by_hour = written_insight(spark, sf_dir, "trip_volume_by_hour")
    endless = """SELECT count(*) FROM range(10000000000000) AS r
                 JOIN {by_hour} ON r.id % 24 = pickup_hour WHERE r.id % 1000003 % 7 = 8 + trip_count"""
    try:
        ended = str(run_sql(spark, endless, seconds=2, by_hour=by_hour).total)
    except OutOfTime as late:
        ended = str(late)
    answer = run_sql(spark, "SELECT pickup_hour, trip_count FROM {by_hour} ORDER BY 1", by_hour=by_hour)
    rows = spark.createDataFrame(answer.rows, "pickup_hour INT, trip_count BIGINT")
    return rows.withColumn("endless", F.lit(ended))


def _run_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone pairs leaving a zone matched without regard to case: the rows shown, how many
    there are in all, and the note that says so."""
    answer = run_sql(
        spark,
        """SELECT Zone AS zone_name, pickup_location_id, dropoff_location_id, trip_count
           FROM {pairs} JOIN {zones} ON pickup_location_id = LocationID
           WHERE Zone ILIKE '%nation_1%' AND Borough NOT ILIKE 'europe'
           ORDER BY trip_count DESC, pickup_location_id, dropoff_location_id""",
        pairs=written_insight(spark, sf_dir, "zone_pair_analysis"),
        zones=zone_lookup(spark, sf_dir),
    )
    schema = "zone_name STRING, pickup_location_id INT, dropoff_location_id INT, trip_count BIGINT"
    shown = spark.createDataFrame(answer.rows, schema)
    return shown.select(
        "*", F.lit(answer.total).cast("bigint").alias("total_rows"), F.lit(answer.note).alias("note")
    )


def _table_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of every registered table, as a user would list them."""
    listed = table_columns(spark, _registered(spark, sf_dir))
    return listed.groupBy("table_name").agg(
        F.count("*").alias("column_count"), F.count_if("is_partition").alias("partition_columns")
    )


def _in_settings(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(apply_settings(spark), sf_dir)

    return run


def queries() -> dict[str, Query]:
    found: dict[str, Query] = {
        "scan_raw": _scan_raw,
        "scan_recorded": _scan_recorded,
        "scan_raw_months": _scan_raw_months,
        "scan_cleaned": _scan_cleaned,
        "scan_lookup_csv": _scan_lookup_csv,
        "write_table": _write_table,
        "write_cleaned": _write_cleaned,
        "lookup_tables": _lookup_tables,
        "register_lake": _register_lake,
        "lake_inventory": _lake_inventory,
        "reload_month": _reload_month,
        "scan_uneven_months": _scan_uneven_months,
        "table_audit": _table_audit,
        "build_lake": _build_lake,
        "reloaded_insights": _reloaded_insights,
        "build_in_runs": _build_in_runs,
    }
    found |= {name: partial(_step, place) for place, (name, _, _) in enumerate(STEPS)}
    found |= {"parse_ts": _parse_ts, "cleaning_funnel": _funnel, "clean_trips": _clean_trips}
    found |= {name: partial(_insight, name) for name in INSIGHTS}
    found |= {name: partial(_question, name) for name in QUESTIONS}
    found |= {
        "sql_date_range": _date_range,
        "decode_payment": _decode_payment,
        "decode_vendor": _decode_vendor,
        "decode_trips": _decode_trips,
        "decode_zone": _decode_zone,
        "decode_zone_pairs": _decode_zone_pairs,
        "key_metrics": _key_metrics,
        "utilization": _utilization,
        "views": _views,
        "catalog_views": _catalog_views,
        "timed_sql": _timed_sql,
        "run_sql": _run_sql,
        "table_columns": _table_columns,
    }
    return {name: _in_settings(query) for name, query in found.items()}
