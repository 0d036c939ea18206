"""Lake folders as catalog tables, and an audit of what is there."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.schema import CLEANED_PARTITIONS
from farebox.session import remove_folder
from farebox.sources.lake import STRAY_FILES

RAW = "raw"
CLEANED = "processed/trips_cleaned"
INSIGHT_FOLDER = "insights"
LOOKUP_FOLDER = "insights/lookups"


def _folders_holding(spark: SparkSession, base: str, pattern: str) -> set[str]:
    """Table folders below ``base`` with files of that name; one row per table, so few."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(base)
    )
    folder = F.regexp_replace("path", r"(/[^/]+=[^/]*)*/[^/]+$", "").alias("folder")
    return {row.folder for row in files.select(folder).distinct().collect()}


def folders_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly in a folder that is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(status.getPath().getName() for status in files.listStatus(path) if status.isDirectory())


def lake_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Table name to folder, for the raw, cleaned, insight and lookup tables."""
    root = root.rstrip("/")
    insights = sorted(_folders_holding(spark, f"{root}/{INSIGHT_FOLDER}", "*.parquet"))
    folders = [f"{root}/{RAW}", f"{root}/{CLEANED}", *insights]
    tables: dict[str, str] = {}
    for folder in folders:
        name = folder.rsplit("/", 1)[-1]
        if name in tables:
            raise ValueError(f"{tables[name]} and {folder} would both be the table {name}")
        tables[name] = folder
    return tables


def _create(spark: SparkSession, table: str, path: str, stray: bool) -> None:
    # A catalog that lists partitions itself does not apply the name filter, so
    # with stray files about, Spark is left to discover the partitions.
    listed = "spark.sql.hive.manageFilesourcePartitions"
    before = spark.conf.get(listed)
    spark.conf.set(listed, str(not stray).lower())
    try:
        spark.sql(
            f"CREATE TABLE {table} USING parquet "
            f"OPTIONS (pathGlobFilter '*.parquet') LOCATION '{path}'"
        )
    finally:
        spark.conf.set(listed, before)
    _recover(spark, table)


def create_month_table(spark: SparkSession, table: str, path: str, schema: T.StructType) -> None:
    """A table of cleaned trips whose months the catalog knows, if it is not there; a known one
    gets the columns it lacks."""
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        months = ", ".join(CLEANED_PARTITIONS)
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY ({months}) LOCATION '{path}'")
        return
    known = {name.lower() for name in spark.table(table).columns}
    new = [f for f in schema.fields if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")


def _month_folder(spark: SparkSession, table: str, where: str) -> str | None:
    """Where the catalog finds a month, or None if it knows of none."""
    if spark.sql(f"SHOW PARTITIONS {table} PARTITION ({where})").head() is None:
        return None
    told = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION ({where})").collect()
    return next((row.data_type for row in told if row.col_name == "Location"), None)


def month_folders(spark: SparkSession, table: str) -> list[str]:
    """Where the catalog finds each month of a table that may not be there."""
    if not spark.catalog.tableExists(table):
        return []
    months = spark.sql(f"SHOW PARTITIONS {table}").collect()
    return [folder for row in months if (folder := _month_folder(spark, table, row.partition.replace("/", ", ")))]


def point_month(spark: SparkSession, table: str, month: tuple[int, int], folder: str | None) -> None:
    """Let the catalog find a month in another folder, or not at all. The files of the folder it
    was in are deleted afterwards."""
    where = f"pickup_year = {month[0]}, pickup_month = {month[1]}"
    before = _month_folder(spark, table, where)
    if folder is None:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({where})")
    elif before:
        spark.sql(f"ALTER TABLE {table} PARTITION ({where}) SET LOCATION '{folder}'")
    else:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({where}) LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    if before and (folder is None or _without_scheme(before) != _without_scheme(folder)):
        remove_folder(spark, before)


def _described(spark: SparkSession, table: str, entry: str) -> str | None:
    found = spark.sql(f"DESCRIBE EXTENDED {table}").where(F.col("col_name") == entry).head()
    return found["data_type"] if found else None


def _recover(spark: SparkSession, table: str) -> None:
    """Tell the catalog of new partitions, where it is the one to list them."""
    if _described(spark, table, "Partition Provider") == "Catalog":
        spark.catalog.recoverPartitions(table)


def _without_scheme(path: str) -> str:
    return "/" + re.sub(r"^\w+:(//[^/]*)?", "", path).strip("/")


def _check_ours(spark: SparkSession, table: str, path: str) -> None:
    """Raise unless the table is external and at that folder."""
    kind, place = _described(spark, table, "Type"), _described(spark, table, "Location")
    if kind != "EXTERNAL" or _without_scheme(place or "") != _without_scheme(path):
        raise ValueError(f"{table} is a table of another kind or place ({kind}, {place}); it is left alone")


def _set_columns(spark: SparkSession, table: str, columns: list[T.StructField]) -> None:
    """Give a table other columns in the catalog, in place: what else is known of it stays."""
    database, name = table.rsplit(".", 1)
    schema = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(T.StructType(columns).json())
    spark._jsparkSession.sessionState().catalog().externalCatalog().alterTableDataSchema(database, name, schema)


def _refresh(spark: SparkSession, table: str, path: str) -> None:
    """Bring a table's columns and partitions up to date with its folder. New columns are added;
    where a type has changed, the columns are set anew. The entry is never removed."""
    _check_ours(spark, table, path)
    known = {f.name.lower(): f.dataType for f in spark.table(table).schema.fields}
    found = spark.read.option("pathGlobFilter", "*.parquet").parquet(path).schema.fields
    if any(known.get(f.name.lower(), f.dataType) != f.dataType for f in found):
        partitions = {c.name.lower() for c in spark.catalog.listColumns(table) if c.isPartition}
        _set_columns(spark, table, [f for f in found if f.name.lower() not in partitions])
    else:
        new = [f for f in found if f.name.lower() not in known]
        if new:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    spark.catalog.refreshTable(table)
    _recover(spark, table)


def _same(path: str, folders: set[str]) -> bool:
    """Whether the folder is among those Spark listed, which name a scheme as well."""
    return any(folder == path or folder.split(":", 1)[-1] == path for folder in folders)


def register_lake(spark: SparkSession, root: str, database: str | None = None) -> dict[str, str]:
    """Make every lake folder a table; returns table names and folders.

    With ``database`` they become external tables in it: new ones are created,
    known ones get new columns, types and partitions in place, and none is dropped. A table of that name that is not external, or is elsewhere, is an
    error, and so are two folders of one name. Without ``database`` they become temporary
    views.
    """
    tables = lake_tables(spark, root)
    stray = _folders_holding(spark, f"{root.rstrip('/')}/{CLEANED}", STRAY_FILES) if database else set()
    for name, path in tables.items():
        if database is None:
            spark.read.option("pathGlobFilter", "*.parquet").parquet(path).createOrReplaceTempView(name)
        elif spark.catalog.tableExists(f"{database}.{name}"):
            _refresh(spark, f"{database}.{name}", path)
        else:
            _create(spark, f"{database}.{name}", path, _same(path, stray))
    return tables


def _layer(name: str, path: str) -> str:
    place = f"{path}/{name}".lower()
    if "lookup" in place:
        return "lookup"
    return next((layer for layer in ("processed", "insights", "raw") if layer in place), "other")


def table_audit(
    spark: SparkSession,
    expected: Iterable[str],
    database: str | None = None,
    locations: dict[str, str] | None = None,
) -> DataFrame:
    """For each expected table: is it there, in which layer, its columns and rows."""
    prefix = f"{database}." if database else ""
    schema = T.StructType.fromDDL("table_name STRING, present BOOLEAN, layer STRING, columns STRING")
    rows, counts = [], []
    for name in expected:
        present = spark.catalog.tableExists(prefix + name)
        path = (locations or {}).get(name) or (_described(spark, prefix + name, "Location") if present else "")
        columns = ", ".join(spark.table(prefix + name).columns) if present else None
        rows.append((name, present, _layer(name, path or "") if present else None, columns))
        if present:
            counted = spark.table(prefix + name).agg(F.count("*").alias("row_count"))
            counts.append(counted.select(F.lit(name).alias("table_name"), "row_count"))
    audit = spark.createDataFrame(rows, schema)
    if not counts:
        return audit.withColumn("row_count", F.lit(None).cast("bigint"))
    counted = reduce(DataFrame.unionByName, counts)
    return audit.join(counted, "table_name", "left").orderBy("table_name")
