"""The whole batch: lookups, cleaned trips in runs of pickup months, then every insight table.

Copies of a trip have its pickup time, so any set of pickup months can be cleaned alone. The
record of raw files says which files have trips in a month; a run of months reads those files,
shuffles what it needs and no more, puts its months in place and leaves a commit. A batch that
stopped goes on after its last commit, as long as raw files, rules and months are the same.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from farebox.functions.trip_columns import pickup_time
from farebox.operators.cleaning import DEFAULT_RULES, TripRules, clean_trips, funnel_rows, stage_counts
from farebox.plans.insights import (
    LATTICE,
    available_insights,
    fee_column,
    month_partials,
    tables_from_partials,
    write_month_partials,
)
from farebox.session import folder_exists, remove_folder, replace_folder, shuffle_width, side_by_side
from farebox.sources import catalog
from farebox.sources.lake import scan_cleaned, write_cleaned, write_table
from farebox.sources.lookups import publish_lookups
from farebox.sources.raw import Month as FiledMonth
from farebox.sources.raw_files import filed_in, in_months, list_files, read_files, read_record, record

RUN_BYTES = 96 * 1024**3  # raw bytes cleaned at once: some 6,000 partitions

Month = tuple[int, int]
NO_MONTH = -1  # the number of the commit for trips without a pickup time


@dataclass(frozen=True)
class Lake:
    """Where the tables of a built lake are, and how the cleaning went when it was built."""

    root: str
    tables: dict[str, str]
    funnel: DataFrame
    table: str | None = None


def picked_up_in(months: Iterable[Month]) -> Column:
    """Whether a trip is picked up in one of the months, as time ranges that reach the scan."""
    ranges: list[list[int]] = []
    for place in sorted(12 * year + month - 1 for year, month in months):
        if ranges and ranges[-1][1] == place:
            ranges[-1][1] += 1
        else:
            ranges.append([place, place + 1])

    def begins(place: int) -> Column:
        one = F.lit(1)
        return F.make_timestamp(F.lit(place // 12), F.lit(place % 12 + 1), one, F.lit(0), F.lit(0), F.lit(0))

    tests = [(pickup_time() >= begins(first)) & (pickup_time() < begins(end)) for first, end in ranges]
    return reduce(or_, tests, F.lit(False))


def runs_of(sizes: dict[Month, int], run_bytes: int) -> list[list[Month]]:
    """Months in order, as many to a run as fit, one at least."""
    runs: list[list[Month]] = []
    held = 0
    for month in sorted(sizes):
        if not runs or held + sizes[month] > run_bytes:
            runs.append([])
            held = 0
        runs[-1].append(month)
        held += sizes[month]
    return runs


def _months(rows: DataFrame) -> set[Month]:
    found = rows.select("pickup_year", "pickup_month").where("pickup_month IS NOT NULL").distinct()
    return {tuple(row) for row in found.collect()}


def _month_folder(folder: str, month: Month) -> str:
    return f"{folder}/pickup_year={month[0]}/pickup_month={month[1]}"


def _sizes(files: DataFrame, months: set[Month]) -> dict[Month, int]:
    """Raw bytes of each month: of every file, the share of its trips that are in the month."""
    trips = files.groupBy("file").agg(F.sum("trips").alias("all"))
    share = F.col("bytes") * F.col("trips") / F.col("all")
    sums = files.where(F.col("trips") > 0).join(trips, "file").groupBy("pickup_year", "pickup_month").agg(F.sum(share))
    found = {(row[0], row[1]): int(row[2]) for row in sums.collect()}
    return {month: found.get(month, 0) for month in months}


@dataclass
class _Batch:
    """One batch over a lake, and where it keeps its state until it has ended."""

    spark: SparkSession
    root: str
    rules: TripRules
    months: list[FiledMonth] | None
    only_given_months: bool
    run_bytes: int
    table: str | None
    name: str = ""
    counts: dict[int, int] = field(default_factory=dict)
    kept: int = 0

    def __post_init__(self) -> None:
        self.raw = f"{self.root}/{catalog.RAW}"
        self.cleaned = f"{self.root}/{catalog.CLEANED}"
        self.partials = f"{self.root}/processed/insight_partials"
        self.known = f"{self.root}/processed/raw_files"
        self.state = f"{self.root}/processed/batch"
        self.staged = f"{self.root}/processed/trips_cleaned_months"
        has_lake = folder_exists(self.spark, self.cleaned) or (self.table and self.spark.catalog.tableExists(self.table))
        self.reloading = bool(
            self.only_given_months and self.months is not None and has_lake and folder_exists(self.spark, self.known)
        )
        self.scope = None if self.only_given_months else self.months

    def identity(self) -> str:
        """What must not have changed for a stopped batch to go on: files, rules and months."""
        files = list_files(self.spark, self.raw).where(filed_in(self.scope))
        seen = files.agg(F.bit_xor(F.xxhash64("file", "bytes", "modified")), F.count("*")).head()
        told = (*seen, self.rules, self.months, self.reloading, self.run_bytes, self.table)
        return hashlib.sha256(repr(told).encode()).hexdigest()[:24]

    def committed(self, run: int) -> bool:
        return folder_exists(self.spark, f"{self.state}/{self.name}/runs/{run}/_SUCCESS")

    def commit(self, run: int, counts: dict[int, int], kept: int) -> None:
        rows = [*counts.items(), (None, kept)]
        told = self.spark.createDataFrame(rows, "passed INT, trips BIGINT")
        write_table(told.coalesce(1), f"{self.state}/{self.name}/runs/{run}")

    def started_elsewhere(self) -> set[Month]:
        """Months that other batches began to replace and did not end. This one replaces them too."""
        found: set[Month] = set()
        if folder_exists(self.spark, self.state):
            for other in catalog.folders_in(self.spark, self.state):
                plan = f"{self.state}/{other}/plan"
                if other != self.name and folder_exists(self.spark, f"{plan}/_SUCCESS"):
                    found |= _months(self.spark.read.parquet(plan))
        return found

    def files(self) -> DataFrame:
        """The record of all raw files in scope as they are now, kept with the batch's state."""
        folder = f"{self.state}/{self.name}/raw_files"
        if not folder_exists(self.spark, f"{folder}/_SUCCESS"):
            write_table(record(self.spark, self.raw, [self.known], self.scope), folder)
        return read_record(self.spark, folder)

    def planned(self, files: DataFrame) -> list[list[Month]]:
        """Runs of months to clean. A reload's are those that its files have trips in, or had."""
        folder = f"{self.state}/{self.name}/plan"
        if not folder_exists(self.spark, f"{folder}/_SUCCESS"):
            touched = self.started_elsewhere()
            if self.reloading:
                before = read_record(self.spark, self.known)
                touched |= _months(files.where(filed_in(self.months)).unionByName(before.where(filed_in(self.months))))
            else:
                touched = _months(files)
            runs = runs_of(_sizes(files, touched), self.run_bytes)
            rows = [(n, *month) for n, run in enumerate(runs) for month in run]
            plan = self.spark.createDataFrame(rows, "run INT, pickup_year INT, pickup_month INT")
            write_table(plan.coalesce(1), folder)
        runs: dict[int, list[Month]] = {}
        for row in self.spark.read.parquet(folder).orderBy("run", "pickup_year", "pickup_month").collect():
            runs.setdefault(row.run, []).append((row.pickup_year, row.pickup_month))
        return list(runs.values())

    def trips(self) -> DataFrame:
        return self.spark.table(self.table) if self.table else scan_cleaned(self.spark, self.cleaned)

    def clean(self, run: int, months: list[Month], files: DataFrame, all_columns: list[str]) -> None:
        """Clean the months of one run, put them in place with their groupings, and commit."""
        held = files.where(in_months(months, "pickup_year", "pickup_month"))
        by_file = held.groupBy("file").agg(F.sum("trips").alias("trips"), F.max("bytes").alias("bytes"))
        expected, size = by_file.agg(F.sum("trips"), F.sum("bytes")).head()
        raw = read_files(held, self.raw, all_columns)
        counts, there = {}, {}
        # Never where an earlier try has written: months may be in place there already.
        staged = f"{self.staged}/{self.name}-{run}-{uuid.uuid4().hex[:8]}"
        if raw is not None:
            raw = raw.where(picked_up_in(months))
            with shuffle_width(self.spark, size):
                seen = Observation()
                cleaned = clean_trips(raw, self.rules, by_month=True, counts=seen)
                write_cleaned(cleaned, staged, gathered=True)
            rows = self.spark.read.schema(cleaned.schema).parquet(staged)
            there = {(r.pickup_year, r.pickup_month): r["count"] for r in _by_month(rows).collect()}
            if there:
                counts = {n: seen.get[f"passed_{n}"] for n in range(len(self.rules.stages()) + 1)}
            if sum(counts.values()) != expected:
                # Tasks that ran twice, on an executor that was lost, were counted twice; and where
                # no trip is kept, Spark drops the emptied plan, and what it counted with it.
                counts = {row.passed: row.copies for row in stage_counts(raw, self.rules).collect()}
            if self.table:
                catalog.create_month_table(self.spark, self.table, self.cleaned, cleaned.schema)
        self.put_in_place(staged, months, there)
        if there:
            placed = self.trips().where(in_months(there, "pickup_year", "pickup_month"))
            write_month_partials(placed, self.partials)
        for month in set(months) - set(there):
            self.remove_partials(month)
        self.commit(run, counts, sum(there.values()))

    def put_in_place(self, staged: str, months: list[Month], there: dict[Month, int]) -> None:
        """Each month is the old one or the new one at any time, whatever fails."""
        for month in months:
            if self.table:
                catalog.point_month(self.spark, self.table, month, _month_folder(staged, month) if month in there else None)
            elif month in there:
                replace_folder(self.spark, _month_folder(staged, month), _month_folder(self.cleaned, month))
            else:
                remove_folder(self.spark, _month_folder(self.cleaned, month))
        if not self.table:
            remove_folder(self.spark, staged)

    def remove_partials(self, month: Month) -> None:
        for grouping in LATTICE:
            remove_folder(self.spark, _month_folder(f"{self.partials}/{grouping}", month))

    def remove_others(self, months: set[Month]) -> None:
        """Months of an earlier build that have no trips any more."""
        for month in _months(self.trips()) - months:
            if self.table:
                catalog.point_month(self.spark, self.table, month, None)
            else:
                remove_folder(self.spark, _month_folder(self.cleaned, month))
            self.remove_partials(month)

    def run(self) -> None:
        self.name = self.identity()
        files = self.files()
        runs = self.planned(files)
        all_columns = sorted(row.columns for row in files.select("columns").distinct().collect())
        if not self.reloading and not self.committed(NO_MONTH):
            timeless = files.where("pickup_month IS NULL AND trips > 0")
            raw = read_files(timeless, self.raw, all_columns)
            rows = [] if raw is None else stage_counts(raw.where(pickup_time().isNull()), self.rules).collect()
            self.commit(NO_MONTH, {row.passed: row.copies for row in rows}, 0)
        for run, months in enumerate(runs):
            if not self.committed(run):
                self.clean(run, months, files, all_columns)
        if not self.reloading:
            self.remove_others({month for run in runs for month in run})
        numbers = [*range(len(runs)), *([] if self.reloading else [NO_MONTH])]
        told = self.spark.read.schema("passed INT, trips BIGINT").parquet(
            *[f"{self.state}/{self.name}/runs/{run}" for run in numbers]
        )
        sums = {row.passed: row.trips for row in told.groupBy("passed").agg(F.sum("trips").alias("trips")).collect()}
        self.kept = sums.pop(None, 0)
        self.counts = sums

    def end(self) -> None:
        """The files are known from now on; the state of this and of other batches goes."""
        held = f"{self.state}/{self.name}/raw_files"
        if self.reloading:
            # Files outside the reloaded months are as they were when last cleaned.
            now = read_record(self.spark, held).where(filed_in(self.months))
            before = read_record(self.spark, self.known).where(~F.coalesce(filed_in(self.months), F.lit(False)))
            held = f"{self.state}/{self.name}/known_files"
            write_table(now.unionByName(before), held)
        replace_folder(self.spark, held, self.known)
        remove_folder(self.spark, self.state)
        # What tries that failed have written and no month was pointed to.
        used = catalog.month_folders(self.spark, self.table) if self.table else []
        used = {folder.split("/pickup_year=")[0].rsplit("/", 1)[-1] for folder in used}
        if folder_exists(self.spark, self.staged):
            for folder in set(catalog.folders_in(self.spark, self.staged)) - used:
                remove_folder(self.spark, f"{self.staged}/{folder}")


def _by_month(rows: DataFrame) -> DataFrame:
    return rows.groupBy("pickup_year", "pickup_month").count()


def write_insights(
    spark: SparkSession, partials: str, trips: DataFrame, folder: str
) -> dict[str, str]:
    """All insight tables the trips' columns allow, from the groupings by month; their paths."""
    names = available_insights(trips)
    tables = tables_from_partials(month_partials(spark, partials), names, fee_column(trips.columns))
    paths = {name: f"{folder}/{name}" for name in names}
    side_by_side(lambda name: write_table(tables[name], paths[name]), names)
    return paths


def build_lake(
    spark: SparkSession,
    root: str,
    lookups: dict[str, DataFrame],
    rules: TripRules = DEFAULT_RULES,
    months: Iterable[FiledMonth] | None = None,
    only_given_months: bool = False,
    run_bytes: int = RUN_BYTES,
    table: str | None = None,
) -> Lake:
    """Build ``processed`` and ``insights`` from ``raw`` under one root folder.

    Trips are cleaned in runs of pickup months of about ``run_bytes`` raw bytes, at least one
    month each; the width of the shuffles follows from the run. Each run reads the rows it needs
    once, counts the funnel on the way, and ends in a commit: after a failure the same call goes
    on behind the last one. An error in cleaning ends the batch before any insight table is
    touched. ``months`` reads only those months' files.

    With ``only_given_months`` an existing lake is brought up to date after those months'
    files have changed. A file can hold trips of neighbouring months, so every pickup month
    that the files touch, or touched when last cleaned, is cleaned anew from all files that
    have trips in it. The insight tables follow from sums and counts by month, of which only
    those of the months cleaned are made anew.

    With ``table``, a name in the catalog, the cleaned trips are that table, and a month is
    replaced by pointing its partition to a new folder: a reader sees the old month or the new
    one. Without, folders are renamed, and a reader can for a moment miss a month.

    The funnel describes the trips cleaned by this batch.
    """
    root = root.rstrip("/")
    tables = publish_lookups(lookups, f"{root}/{catalog.LOOKUP_FOLDER}")
    batch = _Batch(
        spark, root, rules, None if months is None else list(months), only_given_months, run_bytes, table
    )
    batch.run()
    schema = "stage_no INT, stage STRING, rows_left BIGINT, rows_removed BIGINT"
    funnel = spark.createDataFrame(funnel_rows(batch.counts, batch.kept, rules), schema)
    tables["trips_cleaned"] = batch.cleaned
    tables |= write_insights(spark, batch.partials, batch.trips(), f"{root}/{catalog.INSIGHT_FOLDER}")
    batch.end()
    return Lake(root, tables, funnel, table)
