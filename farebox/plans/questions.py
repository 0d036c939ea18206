"""Questions in SQL over cleaned trips, insight tables, views and lookups.

Table names in braces are filled with DataFrames by ``ask``. Every order ends
in a key, so that a limited result is always the same rows. Trips are grouped
by code before a lookup names the groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# view name: (insight table, columns shown under another name)
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "view_fare_by_payment_type": ("revenue_by_payment_type", {}),
    "view_popular_pickup_zones": ("popular_pickup_zones", {}),
    "view_trip_volume_by_hour": ("trip_volume_by_hour", {}),
    "view_revenue_by_time": ("revenue_by_time", {}),
    "view_trip_volume_by_zone": ("trip_volume_by_zone", {"pulocationid": "location_id"}),
}

QUESTIONS: dict[str, str] = {
    "sql_trip_volume_by_day": """
        SELECT date_trunc('DAY', tpep_pickup_datetime) AS trip_date, count(*) AS trip_count
        FROM {trips_cleaned} GROUP BY ALL ORDER BY trip_date LIMIT 20""",
    "sql_fare_by_payment_type": """
        SELECT payment_type, avg(fare_amount) AS avg_fare, avg(tip_amount) AS avg_tip,
               count(*) AS trip_count
        FROM {trips_cleaned} WHERE payment_type IS NOT NULL
        GROUP BY ALL ORDER BY payment_type""",
    "sql_popular_pickup_zones": """
        SELECT pulocationid, count(*) AS pickup_count, avg(fare_amount) AS avg_fare,
               avg(trip_distance) AS avg_distance
        FROM {trips_cleaned} WHERE pulocationid IS NOT NULL
        GROUP BY ALL ORDER BY pickup_count DESC, pulocationid LIMIT 10""",
    "sql_row_count": "SELECT count(*) AS row_count FROM {trips_cleaned}",
    "sql_trips_in_month": """
        SELECT count(*) AS total_trips FROM {trips_cleaned}
        WHERE pickup_year = 2025 AND pickup_month = 1""",
    "sql_avg_fare_by_payment_name": """
        SELECT payment_type_name AS payment_method, avg_fare, trip_count
        FROM {view_fare_by_payment_type}
        JOIN {payment_type_lookup} ON payment_type = payment_type_id
        ORDER BY trip_count DESC, payment_method""",
    "sql_popular_zone_names": """
        SELECT Zone AS zone_name, Borough, location_id, pickup_count, avg_fare
        FROM {view_popular_pickup_zones} JOIN {taxi_zone_lookup} ON location_id = LocationID
        ORDER BY pickup_count DESC, location_id LIMIT 10""",
    "sql_congestion_revenue": """
        SELECT payment_type_name AS payment_method, total_revenue, avg_fare
        FROM {view_fare_by_payment_type}
        JOIN {payment_type_lookup} ON payment_type = payment_type_id
        ORDER BY total_revenue DESC, payment_method""",
    "sql_volume_by_hour": """
        SELECT pickup_hour, trip_count, avg_fare FROM {view_trip_volume_by_hour}
        ORDER BY pickup_hour""",
    "sql_payment_usage": """
        SELECT payment_type_name AS payment_method, trip_count, total_revenue
        FROM {revenue_by_payment_type}
        JOIN {payment_type_lookup} ON payment_type = payment_type_id
        ORDER BY trip_count DESC, payment_method""",
    "sql_revenue_by_payment_name": """
        SELECT payment_type_name AS payment_method, avg_fare, avg_tip, total_revenue
        FROM {view_fare_by_payment_type}
        JOIN {payment_type_lookup} ON payment_type = payment_type_id
        ORDER BY total_revenue DESC, payment_method""",
    "sql_top_fare_payment": """
        SELECT payment_type_name AS payment_method, avg_fare, trip_count
        FROM {view_fare_by_payment_type}
        JOIN {payment_type_lookup} ON payment_type = payment_type_id
        ORDER BY avg_fare DESC, payment_method LIMIT 1""",
    "sql_month_fare_by_payment_name": """
        WITH by_code AS (
            SELECT payment_type, sum(fare_amount) AS fares, count(fare_amount) AS paid
            FROM {trips_cleaned} WHERE pickup_year = 2025 AND pickup_month = 1 GROUP BY ALL)
        SELECT payment_type_name, try_divide(sum(fares), sum(paid)) AS avg_fare
        FROM by_code JOIN {payment_type_lookup} ON payment_type = payment_type_id
        GROUP BY ALL ORDER BY payment_type_name""",
    "sql_month_top_zones": """
        WITH by_code AS (
            SELECT pulocationid, count(*) AS trips
            FROM {trips_cleaned} WHERE pickup_year = 2025 AND pickup_month = 1 GROUP BY ALL)
        SELECT Zone AS zone_name, Borough AS borough, sum(trips) AS trip_count
        FROM by_code JOIN {taxi_zone_lookup} ON pulocationid = LocationID
        GROUP BY ALL ORDER BY trip_count DESC, zone_name, borough LIMIT 10""",
}


def ask(spark: SparkSession, name: str, tables: dict[str, DataFrame]) -> DataFrame:
    """Answer a named question over the given tables."""
    text = QUESTIONS[name]
    used = {table: df for table, df in tables.items() if "{" + table + "}" in text}
    return spark.sql(text, **used)


def view_of(name: str, insights: dict[str, DataFrame]) -> DataFrame:
    """The content of one view, from the insight table it shows."""
    table, renamed = VIEWS[name]
    return insights[table].withColumnsRenamed(renamed)


def create_views(insights: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Make the temporary views whose insight table is at hand."""
    views = {name: view_of(name, insights) for name, (table, _) in VIEWS.items() if table in insights}
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views


def create_catalog_views(spark: SparkSession, database: str, views_in: str | None = None) -> list[str]:
    """Make the views whose insight table is in the database, in it or in another one; they
    outlive the session where the catalog does. Views of that name are replaced."""
    made = []
    for name, (table, renamed) in VIEWS.items():
        if spark.catalog.tableExists(f"{database}.{table}"):
            shown = ", ".join(
                f"`{column}` AS `{renamed.get(column, column)}`" for column in spark.table(f"{database}.{table}").columns
            )
            spark.sql(f"CREATE OR REPLACE VIEW {views_in or database}.{name} AS SELECT {shown} FROM {database}.{table}")
            made.append(name)
    return made
