"""A raw trip table derived from ``lineitem``, for checking the library.

Every line item becomes a trip; order keys divisible by 50 come twice, so that
there are exact copies to remove. Odd values are planted by a hash of the keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CENTS = 100


# What the cleaning tests look at is made by the generator, once per row: a plain
# projection would be copied into the filter wherever it is used.
SEED = """struct(
    timestamp_seconds(start_second) AS tpep_pickup_datetime,
    if(h % 307 <> 0, timestamp_seconds(start_second + lasts), NULL) AS tpep_dropoff_datetime,
    if(h % 89 = 0, -500, floor(l_extendedprice / 15)) AS fc)"""

TRIP = """
    if(h % 4 = 3, 7, if(h % 4 = 2, 6, CAST(h % 4 + 1 AS INT))) AS VendorID;
    tpep_pickup_datetime;
    tpep_dropoff_datetime;
    if(h % 97 <> 0, CAST(l_partkey % 9 AS DOUBLE), NULL) AS passenger_count;
    if(h % 101 = 0, 0D, l_quantity / 4) AS trip_distance;
    if(h % 113 <> 0, CAST(l_partkey % 265 + 1 AS INT), NULL) AS PULocationID;
    if(h % 127 <> 0, CAST((l_orderkey + l_suppkey) % 265 + 1 AS INT), NULL) AS DOLocationID;
    if(h % 131 <> 0, CAST(l_orderkey % 7 AS INT), NULL) AS payment_type;
    fc / 100D AS fare_amount;
    ec / 100D AS extra;
    tc / 100D AS tip_amount;
    cc / 100D AS congestion_surcharge;
    if(h % 503 = 0, 0D, (fc + tc + ec + coalesce(cc, 0)) / 100D) AS total_amount
"""


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return (
        items.selectExpr("*", "l_orderkey*31 + l_partkey*17 + l_suppkey*13 + l_linenumber*7 AS h")
        .selectExpr(
            "*",
            "unix_seconds(CAST(l_shipdate AS TIMESTAMP)) + 8900*86400 + h % 86400 AS start_second",
            "if(h % 211 = 0, 90000, (l_partkey*7 + l_linenumber*911 + l_suppkey) % 5400 - 120) AS lasts",
        )
        .selectExpr("*", f"inline(array_repeat({SEED}, if(l_orderkey % 50 = 0, 2, 1)))")
        .selectExpr(
            "*",
            "h % 4 * 50 AS ec",
            "CASE l_returnflag WHEN 'R' THEN 250 WHEN 'A' THEN 0 END AS cc",
            "floor(fc * round(l_discount * 100) * 2 / 100) AS tc",
        )
        .selectExpr(*TRIP.split(";"))
    )


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """265 zones in five boroughs, with zone names that repeat."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    zone = F.col("LocationID")
    service = F.when(zone % 3 == 0, "Yellow Zone").when(zone % 3 == 1, "Boro Zone").otherwise("Airports")
    return (
        spark.range(1, 266)
        .select(F.col("id").cast("int").alias("LocationID"))
        .join(nation, zone % 25 == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "LocationID",
            F.col("r_name").alias("Borough"),
            F.concat_ws(" ", "n_name", F.floor(zone / 50).cast("string")).alias("Zone"),
            service.alias("service_zone"),
        )
    )
