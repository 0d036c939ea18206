"""Free SQL over the registered tables, with an answer bounded in rows and in time."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

SHOWN_ROWS = 100
SECONDS = 120.0  # what a question may take before it is cancelled

TAG = "farebox-sql-"


class OutOfTime(RuntimeError):
    """A query was cancelled because it ran for longer than it may."""


@dataclass(frozen=True)
class Answer:
    columns: list[str]
    rows: list[Row]
    note: str = ""
    total: int = 0

    def __str__(self) -> str:
        lines = [", ".join(self.columns)]
        lines += [", ".join(str(value) for value in row) for row in self.rows]
        return "\n".join(lines + ([self.note] if self.note else []))


@contextmanager
def time_limit(spark: SparkSession, seconds: float | None) -> Iterator[None]:
    """Cancel the jobs that this thread starts here once the time is up; other jobs go on.

    Jobs are known by a tag of their own. A timer cancels what has the tag again and again until the
    block is left, as a query may start one job after another.
    """
    if seconds is None:
        yield
        return
    context = spark.sparkContext
    tag, left, late = TAG + uuid.uuid4().hex, threading.Event(), threading.Event()

    def watch() -> None:
        wait = seconds
        while not left.wait(wait):
            late.set()
            context.cancelJobsWithTag(tag)
            wait = 0.2

    watcher = threading.Thread(target=watch, daemon=True)
    context.addJobTag(tag)
    watcher.start()
    try:
        yield
    except Exception as error:
        if late.is_set():
            raise OutOfTime(f"cancelled after {seconds:g} seconds") from error
        raise
    finally:
        left.set()
        watcher.join()
        context.removeJobTag(tag)


def _rearranges(result: DataFrame) -> bool:
    """Whether rows are shuffled or sorted on the way, so that a part costs as much as the whole."""
    return "Exchange" in result._jdf.queryExecution().executedPlan().toString()


def _first_of_all(result: DataFrame, max_rows: int) -> tuple[list[Row], int]:
    """The first rows in the result's order, and how many there are, from one job."""
    total, place = Observation(), "_place"
    while place in result.columns:
        place += "_"
    numbered = result.observe(total, F.count(F.lit(1)).alias("n")).select(
        F.monotonically_increasing_id().alias(place), *[F.col(f"`{name}`") for name in result.columns]
    )
    rows = numbered.orderBy(place).limit(max_rows).drop(place).collect()
    return rows, total.get["n"]


def run_sql(
    spark: SparkSession,
    text: str,
    max_rows: int = SHOWN_ROWS,
    seconds: float | None = SECONDS,
    **tables: DataFrame,
) -> Answer:
    """Run SQL and bring back at most ``max_rows`` rows, saying how many there are.

    DataFrames may be given for names in braces. A plan that shuffles or sorts runs once: its
    rows are counted while the first are found. Of any other, one row more than shown is fetched,
    and only if it exists are the rows counted, which reads next to nothing. After ``seconds``
    the query is cancelled and ``OutOfTime`` raised; None sets no limit.
    """
    with time_limit(spark, seconds):
        result = spark.sql(text, **tables)
        if _rearranges(result) and len(set(result.columns)) == len(result.columns):
            rows, total = _first_of_all(result, max_rows)
        else:
            rows = result.limit(max_rows + 1).collect()
            total = len(rows) if len(rows) <= max_rows else result.count()
    if total <= max_rows:
        return Answer(result.columns, rows, total=total)
    return Answer(result.columns, rows[:max_rows], f"showing {max_rows} of {total} rows", total)


def table_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Every table and view one can query, with its columns and their types."""
    prefix = f"{database}." if database else ""
    rows = [
        (table.name, column.name, column.dataType, column.isPartition)
        for table in spark.catalog.listTables(database)
        if not (database and table.isTemporary)
        for column in spark.catalog.listColumns(table.name if table.isTemporary else prefix + table.name)
    ]
    schema = "table_name STRING, column_name STRING, data_type STRING, is_partition BOOLEAN"
    return spark.createDataFrame(rows, schema).orderBy(F.col("table_name"))
