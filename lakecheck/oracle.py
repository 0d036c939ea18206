"""The same queries as DuckDB SQL, written apart from the library.

Each statement is a chain of common table expressions from ``lineitem`` on.
"""

from __future__ import annotations

TS = "'%Y-%m-%d %H:%M:%S'"

# What each stage selects from the one before it.
CHAIN: list[tuple[str, str]] = [
    (
        "items",
        "SELECT * FROM lineitem UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 50 = 0",
    ),
    (
        "hashed",
        "SELECT *, l_orderkey*31 + l_partkey*17 + l_suppkey*13 + l_linenumber*7 AS h FROM items",
    ),
    (
        "timed",
        """SELECT *, l_shipdate + to_seconds(8900*86400 + h % 86400) AS pickup,
           CASE WHEN h % 211 = 0 THEN 90000
                ELSE (l_partkey*7 + l_linenumber*911 + l_suppkey) % 5400 - 120 END AS dur,
           CASE WHEN h % 89 = 0 THEN -500
                ELSE CAST(floor(l_extendedprice / 15) AS BIGINT) END AS fc,
           h % 4 * 50 AS ec,
           CASE l_returnflag WHEN 'R' THEN 250 WHEN 'A' THEN 0 END AS cc FROM hashed""",
    ),
    (
        "tipped",
        """SELECT *, CAST(floor(fc * round(l_discount * 100) * 2 / 100) AS BIGINT) AS tc FROM timed""",
    ),
    (
        "trips",
        """SELECT CAST(CASE h % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 6 ELSE 7 END AS INT) AS vendorid,
           pickup AS tpep_pickup_datetime,
           CASE WHEN h % 307 <> 0 THEN pickup + to_seconds(dur) END AS tpep_dropoff_datetime,
           CASE WHEN h % 97 <> 0 THEN CAST(l_partkey % 9 AS DOUBLE) END AS passenger_count,
           CASE WHEN h % 101 = 0 THEN 0.0::DOUBLE ELSE l_quantity / 4 END AS trip_distance,
           CASE WHEN h % 113 <> 0 THEN CAST(l_partkey % 265 + 1 AS INT) END AS pulocationid,
           CASE WHEN h % 127 <> 0 THEN CAST((l_orderkey + l_suppkey) % 265 + 1 AS INT) END AS dolocationid,
           CASE WHEN h % 131 <> 0 THEN CAST(l_orderkey % 7 AS INT) END AS payment_type,
           CAST(fc AS DOUBLE) / 100 AS fare_amount,
           CAST(ec AS DOUBLE) / 100 AS extra,
           CAST(tc AS DOUBLE) / 100 AS tip_amount,
           CAST(cc AS DOUBLE) / 100 AS congestion_surcharge,
           CASE WHEN h % 503 = 0 THEN 0.0::DOUBLE
                ELSE CAST(fc + tc + ec + coalesce(cc, 0) AS DOUBLE) / 100 END AS total_amount
           FROM tipped""",
    ),
    (
        "not_null",
        """SELECT * FROM trips WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL
           AND passenger_count IS NOT NULL AND trip_distance IS NOT NULL
           AND fare_amount IS NOT NULL AND total_amount IS NOT NULL""",
    ),
    (
        "in_time",
        """SELECT *, tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff_ts FROM not_null
           WHERE tpep_dropoff_datetime > tpep_pickup_datetime
           AND floor(epoch(tpep_pickup_datetime)) <= epoch(TIMESTAMP '2025-12-31 23:59:59')
           AND floor(epoch(tpep_dropoff_datetime)) <= epoch(TIMESTAMP '2025-12-31 23:59:59')""",
    ),
    (
        "lasting",
        """SELECT *, CAST(floor(epoch(dropoff_ts)) - floor(epoch(pickup_ts)) AS DOUBLE)
           / CAST(60 AS DOUBLE) AS trip_duration_minutes FROM in_time""",
    ),
    (
        "right_length",
        "SELECT * FROM lasting WHERE trip_duration_minutes >= 1 AND trip_duration_minutes <= 1440",
    ),
    (
        "moving",
        """SELECT *, CASE WHEN trip_duration_minutes > 0
           THEN trip_distance / (trip_duration_minutes / CAST(60 AS DOUBLE)) END AS trip_speed_mph
           FROM right_length""",
    ),
    (
        "right_speed",
        """SELECT * FROM moving WHERE trip_speed_mph IS NULL
           OR (trip_speed_mph >= 1 AND trip_speed_mph <= 100)""",
    ),
    ("paid", "SELECT * FROM right_speed WHERE fare_amount >= 0 AND trip_distance > 0"),
    ("seated", "SELECT * FROM paid WHERE passenger_count >= 0 AND passenger_count <= 6"),
    (
        "single",
        """SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (
             PARTITION BY tpep_pickup_datetime, tpep_dropoff_datetime, pulocationid, dolocationid,
                          trip_distance, fare_amount
             ORDER BY vendorid NULLS FIRST, passenger_count NULLS FIRST, payment_type NULLS FIRST,
                      extra NULLS FIRST, tip_amount NULLS FIRST, congestion_surcharge NULLS FIRST,
                      total_amount NULLS FIRST) AS place FROM seated) WHERE place = 1""",
    ),
    (
        "dated",
        """SELECT *, CAST(year(pickup_ts) AS INT) AS pickup_year, CAST(month(pickup_ts) AS INT) AS pickup_month,
           CAST(day(pickup_ts) AS VARCHAR) AS pickup_day, CAST(hour(pickup_ts) AS INT) AS pickup_hour,
           CAST(dayofweek(pickup_ts) + 1 AS INT) AS pickup_day_of_week,
           strftime(pickup_ts, '%Y-%m-%d') AS pickup_date FROM single""",
    ),
    (
        "shared",
        """SELECT *, CASE WHEN total_amount > 0 THEN tip_amount / total_amount * 100
           ELSE CAST(0 AS DOUBLE) END AS tip_percentage FROM dated""",
    ),
    (
        "banded",
        """SELECT *, CASE WHEN trip_distance < 2 THEN 'short' WHEN trip_distance < 5 THEN 'medium'
           ELSE 'long' END AS trip_length_category FROM shared""",
    ),
    (
        "flagged",
        """SELECT *, pulocationid IN (1, 2, 3) AS is_airport_pickup,
           dolocationid IN (1, 2, 3) AS is_airport_dropoff,
           pulocationid IN (1, 2, 3) OR dolocationid IN (1, 2, 3) AS is_airport_trip FROM banded""",
    ),
    (
        "cleaned",
        """SELECT *, pulocationid IS NOT NULL AND dolocationid IS NOT NULL AS has_valid_locations,
           payment_type IS NOT NULL AS has_valid_payment FROM flagged""",
    ),
]

LOOKUPS = [
    (
        "payments",
        """SELECT * FROM (VALUES (0, 'Flex Fare'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'),
           (4, 'Dispute'), (5, 'Unknown'), (6, 'Voided trip')) AS p(payment_type_id, payment_type_name)""",
    ),
    (
        "vendors",
        """SELECT * FROM (VALUES (1, 'Creative Mobile Technologies'), (2, 'Curb Mobility'),
           (6, 'Myle Technologies'), (7, 'Helix')) AS v(vendor_id, vendor_name)""",
    ),
    (
        "zones",
        """SELECT CAST(i AS INT) AS "LocationID", r_name AS "Borough",
           n_name || ' ' || CAST(i // 50 AS VARCHAR) AS "Zone",
           CASE i % 3 WHEN 0 THEN 'Yellow Zone' WHEN 1 THEN 'Boro Zone' ELSE 'Airports' END AS service_zone
           FROM range(1, 266) AS g(i) JOIN nation ON i % 25 = n_nationkey
           JOIN region ON n_regionkey = r_regionkey""",
    ),
]


def over(stage: str, select: str, *extra: tuple[str, str]) -> str:
    """``select`` over the chain up to ``stage``, the lookups and more expressions."""
    upto = [name for name, _ in CHAIN].index(stage) + 1
    parts = [*CHAIN[:upto], *LOOKUPS, *extra]
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in parts) + "\n" + select


def _texted(columns: list[str]) -> str:
    times = {"tpep_pickup_datetime", "tpep_dropoff_datetime", "pickup_ts", "dropoff_ts"}
    return ", ".join(f"strftime({c}, {TS}) AS {c}" if c in times else c for c in columns)


RAW_COLUMNS = [
    "vendorid",
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "pulocationid",
    "dolocationid",
    "payment_type",
    "fare_amount",
    "extra",
    "tip_amount",
    "congestion_surcharge",
    "total_amount",
]
IDENTITY = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "pulocationid",
    "dolocationid",
    "trip_distance",
    "fare_amount",
]
CRITICAL = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "total_amount",
]
CALENDAR = [
    "pickup_year",
    "pickup_month",
    "pickup_day",
    "pickup_hour",
    "pickup_day_of_week",
    "pickup_date",
]
AIRPORT = ["is_airport_pickup", "is_airport_dropoff", "is_airport_trip"]
QUALITY = ["has_valid_locations", "has_valid_payment"]
DERIVED = ["pickup_ts", "dropoff_ts", "trip_duration_minutes", "trip_speed_mph"]

STEP_STAGES = {
    "require_columns": ("trips", CRITICAL),
    "standardize_columns": ("trips", RAW_COLUMNS),
    "drop_null_critical": ("not_null", IDENTITY),
    "valid_times": ("in_time", [*IDENTITY, "pickup_ts", "dropoff_ts"]),
    "trip_duration": ("lasting", [*IDENTITY, "trip_duration_minutes"]),
    "valid_duration": ("right_length", [*IDENTITY, "trip_duration_minutes"]),
    "trip_speed": ("moving", [*IDENTITY, "trip_speed_mph"]),
    "valid_speed": ("right_speed", [*IDENTITY, "trip_speed_mph"]),
    "valid_fare_distance": ("paid", IDENTITY),
    "valid_passengers": ("seated", [*IDENTITY, "passenger_count"]),
    "dedup_trips": ("single", [*IDENTITY, "vendorid", "payment_type", "total_amount"]),
    "temporal_features": ("dated", [*IDENTITY, *CALENDAR]),
    "tip_percentage": ("shared", [*IDENTITY, "tip_amount", "total_amount", "tip_percentage"]),
    "trip_length_category": ("banded", [*IDENTITY, "trip_length_category"]),
    "airport_flags": ("flagged", [*IDENTITY, *AIRPORT]),
    "quality_flags": ("cleaned", [*IDENTITY, *QUALITY]),
    "clean_trips": (
        "cleaned",
        [
            *RAW_COLUMNS,
            *DERIVED,
            *CALENDAR,
            "tip_percentage",
            "trip_length_category",
            *AIRPORT,
            *QUALITY,
        ],
    ),
}

# --- insight tables ---

MEANS = """round(avg(trip_distance) + 1e-9, 6) AS avg_distance, round(avg(fare_amount) + 1e-9, 6) AS avg_fare,
    round(avg(total_amount) + 1e-9, 6) AS avg_total"""
TAKINGS = """count(*) AS trip_count, round(sum(fare_amount), 2) AS total_fare,
    round(avg(fare_amount) + 1e-9, 6) AS avg_fare, round(sum(total_amount), 2) AS total_revenue,
    round(avg(total_amount) + 1e-9, 6) AS avg_total"""
TAKINGS_TIPS = TAKINGS + """, round(sum(tip_amount), 2) AS total_tip,
    round(avg(tip_amount) + 1e-9, 6) AS avg_tip"""
REVENUE = "round(sum(total_amount), 2) AS total_revenue"
MINUTES = "round(avg(trip_duration_minutes) + 1e-9, 6) AS avg_duration_minutes"
DISTANCE = "round(avg(trip_distance) + 1e-9, 6) AS avg_distance"
TIPS = """count(*) AS trip_count, round(sum(tip_amount), 2) AS total_tips,
    round(avg(tip_amount) + 1e-9, 6) AS avg_tip, round(avg(tip_percentage) + 1e-9, 6) AS avg_tip_percentage"""

INSIGHT_SQL = {
    "trip_volume_by_hour": f"SELECT pickup_hour, count(*) AS trip_count, {MEANS} FROM cleaned GROUP BY 1",
    "trip_volume_by_day": f"SELECT pickup_day_of_week, count(*) AS trip_count, {MEANS} FROM cleaned GROUP BY 1",
    "trip_volume_by_zone": f"SELECT pulocationid, count(*) AS trip_count, {MEANS} FROM cleaned GROUP BY 1",
    "trip_duration_by_hour": f"SELECT pickup_hour, count(*) AS trip_count, {MINUTES}, {DISTANCE} FROM cleaned GROUP BY 1",
    "trip_duration_by_zone": f"SELECT pulocationid, count(*) AS trip_count, {MINUTES}, {DISTANCE} FROM cleaned GROUP BY 1",
    "trip_speed_by_hour": f"""SELECT pickup_hour, count(*) AS trip_count,
        round(avg(trip_speed_mph) + 1e-9, 6) AS avg_speed_mph, {DISTANCE}
        FROM cleaned WHERE trip_speed_mph IS NOT NULL GROUP BY 1""",
    "monthly_trends": f"SELECT pickup_month, count(*) AS trip_count, {MEANS}, {REVENUE} FROM cleaned GROUP BY 1",
    "trips_by_length_category": f"""SELECT trip_length_category, count(*) AS trip_count, {MEANS}, {MINUTES}
        FROM cleaned GROUP BY 1""",
    "popular_pickup_zones": f"SELECT pulocationid AS location_id, count(*) AS pickup_count, {MEANS} FROM cleaned GROUP BY 1",
    "popular_dropoff_zones": f"SELECT dolocationid AS location_id, count(*) AS dropoff_count, {MEANS} FROM cleaned GROUP BY 1",
    "zone_pair_analysis": f"""SELECT pulocationid AS pickup_location_id, dolocationid AS dropoff_location_id,
        count(*) AS trip_count, {MEANS} FROM cleaned GROUP BY 1, 2""",
    "airport_trip_analysis": f"""SELECT is_airport_pickup, is_airport_dropoff, count(*) AS trip_count, {MEANS}, {REVENUE}
        FROM cleaned WHERE is_airport_trip GROUP BY 1, 2""",
    "airport_pickup_zones": f"""SELECT pulocationid, count(*) AS pickup_count, {MEANS}
        FROM cleaned WHERE is_airport_trip AND is_airport_pickup GROUP BY 1""",
    "airport_dropoff_zones": f"""SELECT dolocationid, count(*) AS dropoff_count, {MEANS}
        FROM cleaned WHERE is_airport_trip AND is_airport_dropoff GROUP BY 1""",
    "revenue_by_payment_type": f"SELECT payment_type, {TAKINGS_TIPS} FROM cleaned GROUP BY 1",
    "revenue_by_time": f"SELECT pickup_hour, {TAKINGS_TIPS} FROM cleaned GROUP BY 1",
    "congestion_fee_analysis": f"""SELECT congestion_surcharge, {TAKINGS},
        round(sum(congestion_surcharge), 2) AS total_congestion_fee FROM cleaned GROUP BY 1""",
    "revenue_by_vendor": f"SELECT vendorid, {TAKINGS} FROM cleaned GROUP BY 1",
    "tip_analysis": f"""SELECT payment_type, {TIPS}, round(avg(total_amount) + 1e-9, 6) AS avg_total
        FROM cleaned GROUP BY 1""",
    "tip_by_time": f"SELECT pickup_hour, {TIPS} FROM cleaned GROUP BY 1",
}

STANDARD_COLUMNS = "avg_distance, avg_fare, avg_total"
TAKINGS_COLUMNS = "trip_count, total_fare, avg_fare, total_revenue, avg_total"

# Columns of every lake table, in the order they are written.
TABLE_COLUMNS = {
    "raw": (
        "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, "
        "PULocationID, DOLocationID, payment_type, fare_amount, extra, tip_amount, "
        "congestion_surcharge, total_amount, year, month"
    ),
    "trips_cleaned": (
        ", ".join([*RAW_COLUMNS, "year", "month", *DERIVED, *CALENDAR[2:]])
        + ", tip_percentage, trip_length_category, "
        + ", ".join([*AIRPORT, *QUALITY, "pickup_year", "pickup_month"])
    ),
    "trip_volume_by_hour": f"pickup_hour, trip_count, {STANDARD_COLUMNS}",
    "trip_volume_by_day": f"pickup_day_of_week, trip_count, {STANDARD_COLUMNS}",
    "trip_volume_by_zone": f"pulocationid, trip_count, {STANDARD_COLUMNS}",
    "trip_duration_by_hour": "pickup_hour, trip_count, avg_duration_minutes, avg_distance",
    "trip_duration_by_zone": "pulocationid, trip_count, avg_duration_minutes, avg_distance",
    "trip_speed_by_hour": "pickup_hour, trip_count, avg_speed_mph, avg_distance",
    "monthly_trends": f"pickup_month, trip_count, {STANDARD_COLUMNS}, total_revenue",
    "trips_by_length_category": f"trip_length_category, trip_count, {STANDARD_COLUMNS}, avg_duration_minutes",
    "popular_pickup_zones": f"location_id, pickup_count, {STANDARD_COLUMNS}",
    "popular_dropoff_zones": f"location_id, dropoff_count, {STANDARD_COLUMNS}",
    "zone_pair_analysis": f"pickup_location_id, dropoff_location_id, trip_count, {STANDARD_COLUMNS}",
    "airport_trip_analysis": f"is_airport_pickup, is_airport_dropoff, trip_count, {STANDARD_COLUMNS}, total_revenue",
    "airport_pickup_zones": f"pulocationid, pickup_count, {STANDARD_COLUMNS}",
    "airport_dropoff_zones": f"dolocationid, dropoff_count, {STANDARD_COLUMNS}",
    "revenue_by_payment_type": f"payment_type, {TAKINGS_COLUMNS}, total_tip, avg_tip",
    "revenue_by_time": f"pickup_hour, {TAKINGS_COLUMNS}, total_tip, avg_tip",
    "congestion_fee_analysis": f"congestion_surcharge, {TAKINGS_COLUMNS}, total_congestion_fee",
    "revenue_by_vendor": f"vendorid, {TAKINGS_COLUMNS}",
    "tip_analysis": "payment_type, trip_count, total_tips, avg_tip, avg_tip_percentage, avg_total",
    "tip_by_time": "pickup_hour, trip_count, total_tips, avg_tip, avg_tip_percentage",
    "payment_type_lookup": "payment_type_id, payment_type_name",
    "vendor_lookup": "vendor_id, vendor_name",
    "taxi_zone_lookup": "LocationID, Borough, Zone, service_zone",
}

ROW_SOURCES = {
    "raw": "SELECT * FROM trips",
    "trips_cleaned": "SELECT * FROM cleaned",
    **INSIGHT_SQL,
    "payment_type_lookup": "SELECT * FROM payments",
    "vendor_lookup": "SELECT * FROM vendors",
    "taxi_zone_lookup": "SELECT * FROM zones",
}


def _layer(table: str) -> str:
    if table.endswith("_lookup"):
        return "lookup"
    return {"raw": "raw", "trips_cleaned": "processed"}.get(table, "insights")


def _long_sql(table: str, text: str) -> str:
    """Every measure of every row of an insight table, under its keys as text."""
    columns = TABLE_COLUMNS[table].split(", ")
    first = next(i for i, c in enumerate(columns) if c.endswith("_count"))
    key = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns[:first])
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, {key} AS key, '{measure}' AS measure, "
        f"CAST({measure} AS DOUBLE) AS value FROM ({text})"
        for measure in columns[first:]
    )


def _lake_sql() -> dict[str, str]:
    month_of = "CAST(year(tpep_pickup_datetime) AS INT) AS year, CAST(month(tpep_pickup_datetime) AS INT) AS month"
    sums = "count(*) AS trip_count, round(sum(total_amount), 2) AS total_billed"
    by_cleaned_month = over(
        "cleaned", f"SELECT pickup_year, pickup_month, {sums} FROM cleaned GROUP BY 1, 2"
    )
    used = " UNION ALL ".join(
        f"""SELECT '{table}' AS lookup, {code} AS code, {name} AS name, count(t.used) AS trip_count
            FROM {source} LEFT JOIN (SELECT {column} AS used FROM cleaned) t ON t.used = {code} GROUP BY ALL"""
        for table, source, code, name, column in (
            ("payment_type_lookup", "payments", "payment_type_id", "payment_type_name", "payment_type"),
            ("vendor_lookup", "vendors", "vendor_id", "vendor_name", "vendorid"),
            ("taxi_zone_lookup", "zones", '"LocationID"', '"Zone"', "pulocationid"),
        )
    )
    partitioned = {"raw", "trips_cleaned"}
    registered = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, {str(t in partitioned).lower()} AS is_partitioned, "
        f"count(*) AS row_count FROM ({text})"
        for t, text in ROW_SOURCES.items()
    )
    audited = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, true AS present, '{_layer(t)}' AS layer, "
        f"'{TABLE_COLUMNS[t]}' AS columns, count(*) AS row_count FROM ({text})"
        for t, text in ROW_SOURCES.items()
    ) + " UNION ALL SELECT 'never_written', false, NULL, NULL, NULL"
    built = " UNION ALL ".join(_long_sql(t, text) for t, text in INSIGHT_SQL.items())
    return {
        "scan_raw": over("trips", f"SELECT {month_of}, {sums} FROM trips GROUP BY 1, 2"),
        "scan_recorded": over("trips", f"SELECT {month_of}, {sums} FROM trips GROUP BY 1, 2"),
        "scan_raw_months": over(
            "trips",
            f"""SELECT {month_of}, {sums} FROM trips WHERE year(tpep_pickup_datetime) = 2024
                AND month(tpep_pickup_datetime) IN (2, 4, 5, 6) GROUP BY 1, 2""",
        ),
        "scan_cleaned": by_cleaned_month,
        "write_cleaned": by_cleaned_month,
        "scan_lookup_csv": over(
            "trips",
            """SELECT z.*, count(t.pulocationid) AS pickups FROM zones z
               LEFT JOIN trips t ON t.pulocationid = z."LocationID" GROUP BY ALL""",
        ),
        "write_table": over(
            "trips",
            """SELECT vendorid AS "VendorID", CAST(2 AS BIGINT) AS copies, count(*) AS trip_count
               FROM trips GROUP BY 1""",
        ),
        "lookup_tables": over("cleaned", used),
        "register_lake": over("cleaned", registered),
        "lake_inventory": over(
            "cleaned",
            f"""SELECT DISTINCT 'raw' AS layer, {month_of}, true AS has_files, true AS has_bytes,
                true AS adds_up FROM trips
                UNION ALL SELECT DISTINCT 'cleaned', pickup_year, pickup_month, true, true, true FROM cleaned""",
        ),
        "reload_month": over(
            "cleaned",
            f"""SELECT {_texted(IDENTITY)}, vendorid, payment_type, total_amount, pickup_year, pickup_month
                FROM cleaned""",
        ),
        "scan_uneven_months": over(
            "trips",
            f"""SELECT {month_of}, count(*) AS trip_count, count(passenger_count) AS known_passengers,
                count(pulocationid) AS known_zones,
                count(extra) FILTER (year(tpep_pickup_datetime) <= 2022) AS known_fees,
                count(tip_amount) FILTER (year(tpep_pickup_datetime) > 2022) AS known_tolls,
                round(sum(passenger_count), 2) AS total_passengers,
                round(sum(extra) FILTER (year(tpep_pickup_datetime) <= 2022), 2) AS total_fees
                FROM trips GROUP BY 1, 2""",
        ),
        "table_columns": " UNION ALL ".join(
            f"SELECT '{t}' AS table_name, CAST({len(columns.split(', '))} AS BIGINT) AS column_count, "
            f"CAST({2 if t in partitioned else 0} AS BIGINT) AS partition_columns"
            for t, columns in TABLE_COLUMNS.items()
        ),
        "table_audit": over("cleaned", audited),
        "build_lake": over("cleaned", built),
        "reloaded_insights": over("cleaned", built),
        "build_in_runs": by_cleaned_month,
        "timed_sql": over(
            "cleaned",
            """SELECT pickup_hour, count(*) AS trip_count, 'cancelled after 2 seconds' AS endless
               FROM cleaned GROUP BY 1""",
        ),
    }


def _funnel_sql() -> str:
    stages = [
        ("raw", "trips"),
        ("nulls", "not_null"),
        ("times", "in_time"),
        ("duration", "right_length"),
        ("speed", "right_speed"),
        ("fare_distance", "paid"),
        ("passengers", "seated"),
        ("dedup", "single"),
    ]
    counts = " UNION ALL ".join(
        f"SELECT {n} AS stage_no, '{stage}' AS stage, count(*) AS rows_left FROM {table}"
        for n, (stage, table) in enumerate(stages)
    )
    return over(
        "single",
        """SELECT stage_no, stage, rows_left,
           coalesce(lag(rows_left) OVER (ORDER BY stage_no), rows_left) - rows_left AS rows_removed
           FROM counts""",
        ("counts", counts),
    )


def _sql_questions() -> dict[str, str]:
    by_payment = ("by_payment", INSIGHT_SQL["revenue_by_payment_type"])
    named = "FROM by_payment JOIN payments ON payment_type = payment_type_id"

    def payment(columns: str, tail: str = "") -> str:
        return over(
            "cleaned", f"SELECT payment_type_name AS payment_method, {columns} {named} {tail}", by_payment
        )

    top_fare = ("exact", "SELECT payment_type, avg(fare_amount) AS fare FROM cleaned GROUP BY 1")
    january = "pickup_year = 2025 AND pickup_month = 1"
    return {
        "sql_trip_volume_by_day": over(
            "cleaned",
            f"""SELECT strftime(date_trunc('day', tpep_pickup_datetime), {TS}) AS trip_date,
                count(*) AS trip_count FROM cleaned GROUP BY 1 ORDER BY 1 LIMIT 20""",
        ),
        "sql_fare_by_payment_type": over(
            "cleaned",
            """SELECT payment_type, round(avg(fare_amount) + 1e-9, 6) AS avg_fare,
               round(avg(tip_amount) + 1e-9, 6) AS avg_tip, count(*) AS trip_count
               FROM cleaned WHERE payment_type IS NOT NULL GROUP BY 1""",
        ),
        "sql_popular_pickup_zones": over(
            "cleaned",
            """SELECT pulocationid, count(*) AS pickup_count, round(avg(fare_amount) + 1e-9, 6) AS avg_fare,
               round(avg(trip_distance) + 1e-9, 6) AS avg_distance FROM cleaned
               WHERE pulocationid IS NOT NULL GROUP BY 1 ORDER BY pickup_count DESC, 1 LIMIT 10""",
        ),
        "sql_row_count": over("cleaned", "SELECT count(*) AS row_count FROM cleaned"),
        "sql_trips_in_month": over(
            "cleaned", f"SELECT count(*) AS total_trips FROM cleaned WHERE {january}"
        ),
        "sql_avg_fare_by_payment_name": payment("avg_fare, trip_count"),
        "sql_popular_zone_names": over(
            "cleaned",
            """SELECT "Zone" AS zone_name, "Borough", location_id, pickup_count, avg_fare
               FROM popular JOIN zones ON location_id = "LocationID"
               ORDER BY pickup_count DESC, location_id LIMIT 10""",
            ("popular", INSIGHT_SQL["popular_pickup_zones"]),
        ),
        "sql_congestion_revenue": payment("total_revenue, avg_fare"),
        "sql_volume_by_hour": over(
            "cleaned",
            """SELECT pickup_hour, count(*) AS trip_count, round(avg(fare_amount) + 1e-9, 6) AS avg_fare
               FROM cleaned GROUP BY 1""",
        ),
        "sql_payment_usage": payment("trip_count, total_revenue"),
        "sql_revenue_by_payment_name": payment("avg_fare, avg_tip, total_revenue"),
        "sql_top_fare_payment": over(
            "cleaned",
            f"""SELECT payment_type_name AS payment_method, avg_fare, trip_count {named}
                JOIN exact USING (payment_type) ORDER BY fare DESC, payment_method LIMIT 1""",
            by_payment,
            top_fare,
        ),
        "sql_month_fare_by_payment_name": over(
            "cleaned",
            f"""SELECT payment_type_name, round(avg(fare_amount) + 1e-9, 6) AS avg_fare FROM cleaned
                JOIN payments ON payment_type = payment_type_id WHERE {january} GROUP BY 1""",
        ),
        "sql_month_top_zones": over(
            "cleaned",
            f"""SELECT "Zone" AS zone_name, "Borough" AS borough, count(*) AS trip_count FROM cleaned
                JOIN zones ON pulocationid = "LocationID" WHERE {january} GROUP BY 1, 2
                ORDER BY trip_count DESC, zone_name, borough LIMIT 10""",
        ),
        "sql_date_range": over(
            "cleaned",
            """SELECT pickup_date, count(*) AS trip_count, round(sum(total_amount), 2) AS total_billed
               FROM cleaned WHERE tpep_pickup_datetime >= TIMESTAMP '2025-01-01'
               AND tpep_pickup_datetime < TIMESTAMP '2025-02-01' GROUP BY 1""",
        ),
    }


def _decode_sql() -> dict[str, str]:
    payment_tables = " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, payment_type, payment_type_name, count(*) AS trip_count
            FROM cleaned JOIN payments ON payment_type = payment_type_id GROUP BY ALL"""
        for table in ("revenue_by_payment_type", "tip_analysis", "trips_cleaned")
    )
    zone_tables = " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, {column} AS location_id, "Zone" AS zone, "Borough" AS borough,
            count(*) AS trip_count, {DISTANCE}
            FROM cleaned JOIN zones ON {column} = "LocationID" WHERE {only} GROUP BY ALL"""
        for table, column, only in (
            ("trip_volume_by_zone", "pulocationid", "true"),
            ("trip_duration_by_zone", "pulocationid", "true"),
            ("popular_pickup_zones", "pulocationid", "true"),
            ("popular_dropoff_zones", "dolocationid", "true"),
            ("airport_pickup_zones", "pulocationid", "is_airport_pickup"),
            ("airport_dropoff_zones", "dolocationid", "is_airport_dropoff"),
        )
    )
    views = " UNION ALL ".join(
        f"""SELECT '{view}' AS view_name, CAST({key} AS VARCHAR) AS view_key, count(*) AS trip_count,
            round(avg(fare_amount) + 1e-9, 6) AS avg_fare FROM cleaned GROUP BY {key}"""
        for view, key in (
            ("view_fare_by_payment_type", "payment_type"),
            ("view_popular_pickup_zones", "pulocationid"),
            ("view_trip_volume_by_hour", "pickup_hour"),
            ("view_revenue_by_time", "pickup_hour"),
            ("view_trip_volume_by_zone", "pulocationid"),
        )
    )
    pairs = ("pairs", INSIGHT_SQL["zone_pair_analysis"])
    return {
        "decode_payment": over("cleaned", payment_tables),
        "decode_vendor": over(
            "cleaned",
            "SELECT r.*, vendor_name FROM by_vendor r JOIN vendors ON vendorid = vendor_id",
            ("by_vendor", INSIGHT_SQL["revenue_by_vendor"]),
        ),
        "decode_trips": over(
            "cleaned",
            """SELECT vendor_name, a."Borough" AS pickup_borough, a."Zone" AS pickup_zone,
               b."Borough" AS dropoff_borough, count(*) AS trip_count,
               round(sum(total_amount), 2) AS total_billed
               FROM cleaned JOIN vendors ON vendorid = vendor_id
               JOIN zones a ON pulocationid = a."LocationID" JOIN zones b ON dolocationid = b."LocationID"
               GROUP BY ALL""",
        ),
        "utilization": over(
            "cleaned",
            " UNION ALL ".join(
                f"""SELECT '{unit}' AS unit, strftime(date_trunc('{unit}', pickup_ts), {TS}) AS period,
                    count(*) AS trip_count FROM cleaned GROUP BY ALL"""
                for unit in ("hour", "day", "month")
            ),
        ),
        "decode_zone": over("cleaned", zone_tables),
        "decode_zone_pairs": over(
            "cleaned",
            """SELECT p.*, a."Zone" AS pickup_zone, a."Borough" AS pickup_borough,
               b."Zone" AS dropoff_zone, b."Borough" AS dropoff_borough FROM pairs p
               JOIN zones a ON pickup_location_id = a."LocationID"
               JOIN zones b ON dropoff_location_id = b."LocationID" """,
            pairs,
        ),
        "key_metrics": over(
            "cleaned",
            """SELECT count(*) AS total_trips, round(sum(total_amount), 2) AS total_revenue,
               round(avg(fare_amount) + 1e-9, 6) AS avg_fare,
               round(count(*) / count(DISTINCT date_trunc('hour', pickup_ts)) + 1e-9, 6) AS trips_per_hour,
               round(count(*) / count(DISTINCT pickup_date) + 1e-9, 6) AS trips_per_day FROM cleaned""",
        ),
        "views": over("cleaned", views),
        "catalog_views": over(
            "cleaned",
            f"""SELECT *, true AS present, count(*) OVER (PARTITION BY view_name) AS row_count
                FROM ({views})""",
        ),
        "run_sql": over(
            "cleaned",
            """SELECT *, CASE WHEN total_rows > 100 THEN 'showing 100 of ' || total_rows || ' rows'
                         ELSE '' END AS note
               FROM (SELECT "Zone" AS zone_name, pickup_location_id, dropoff_location_id, trip_count,
                            count(*) OVER () AS total_rows
                     FROM pairs JOIN zones ON pickup_location_id = "LocationID"
                     WHERE lower("Zone") LIKE '%nation_1%' AND lower("Borough") NOT LIKE 'europe'
                     ORDER BY trip_count DESC, pickup_location_id, dropoff_location_id NULLS FIRST LIMIT 100)""",
            pairs,
        ),
    }


def oracle_sql() -> dict[str, str]:
    found = _lake_sql()
    for name, (stage, columns) in STEP_STAGES.items():
        found[name] = over(stage, f"SELECT {_texted(columns)} FROM {stage}")
    written = f"CASE WHEN payment_type = 6 THEN 'no time' ELSE strftime(tpep_pickup_datetime, {TS}) END"
    found["parse_ts"] = over(
        "trips",
        f"""SELECT written, CASE WHEN written <> 'no time' THEN written END AS parsed
            FROM (SELECT {written} AS written FROM trips)""",
    )
    found["cleaning_funnel"] = _funnel_sql()
    found |= {name: over("cleaned", text) for name, text in INSIGHT_SQL.items()}
    return found | _sql_questions() | _decode_sql()
