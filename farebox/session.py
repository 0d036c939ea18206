"""Session settings the lake relies on, and where a job may put working files."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cache

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

AT_ONCE = 4  # jobs sent side by side, as each alone leaves a cluster idle
TARGET_PARTITION_BYTES = 128 * 1024 * 1024
SORTED_PARTITION_BYTES = 48 * 1024 * 1024  # of a shuffle whose tasks sort all their rows

# Trip times are compared in UTC: another zone would change durations across
# a daylight-saving switch. In UTC a zoneless Parquet time is the same instant,
# so it is read as one, which saves a conversion per row and comparison.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Java does not compile methods over 8000 bytes: one long filter over computed
    # columns would run interpreted, about ten times slower.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Tasks whose sorts fit the memory of a small executor: what does not fit is written out and
    # read again. 24 MB of shuffled or filed trips are some 80 MB of rows in a sort.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "24m",
    "spark.sql.files.maxPartitionBytes": "24m",
    # Rows gathered by month are written without a sort: a task has a file open for each of its
    # few months. A task with more months than this sorts the rest.
    "spark.sql.maxConcurrentOutputFileWriters": "20",
}


def shuffle_partitions_for(input_bytes: int, cores: int = 1, partition_bytes: int | None = None) -> int:
    """Partitions that keep one shuffle task near 128 MB, or what is asked for.

    Trips are about three times larger as shuffle rows than as Parquet. AQE
    merges partitions that turn out small, so the number only has to be high
    enough.
    """
    return max(cores, math.ceil(3 * input_bytes / (partition_bytes or TARGET_PARTITION_BYTES)))


def apply_settings(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Set the runtime options on a session somebody else has built."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(
            "spark.sql.shuffle.partitions",
            str(shuffle_partitions_for(input_bytes, cores)),
        )
    return spark


def build_session(
    app_name: str = "farebox",
    master: str | None = None,
    settings: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Make (or get) a session; ``settings`` wins over the defaults here."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if input_bytes is not None:
        apply_settings(spark, input_bytes)
        for key, value in (settings or {}).items():
            if spark.conf.isModifiable(key):
                spark.conf.set(key, value)
    return spark


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="farebox-")


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name for intermediate tables, on storage all executors share.

    The cluster names that storage in ``spark.checkpoint.dir``. Only a local
    session, which has one machine, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        shared = _local_folder(spark.sparkContext.applicationId)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of tables, wherever it is stored; none there is no error."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)


def replace_folder(spark: SparkSession, new: str, old: str) -> None:
    """Put a folder in the place of another, or of none, by renaming; should the second step
    fail, the first is taken back."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(new), hadoop.Path(old)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    aside = hadoop.Path(target.getParent(), f"_replaced-{uuid.uuid4().hex}")
    files.mkdirs(target.getParent())
    there = files.exists(target)

    def moved(one, other) -> bool:
        try:
            return files.rename(one, other)
        except Py4JJavaError:
            return False

    if there and not moved(target, aside):
        raise OSError(f"{old} cannot be renamed")
    if not moved(source, target):
        if there:
            moved(aside, target)
        raise OSError(f"{new} cannot be renamed to {old}")
    if there:
        files.delete(aside, True)


@contextmanager
def shuffle_width(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Shuffles as wide as an input of that many bytes needs to be sorted in memory, for as long as
    this lasts."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    size = min(TARGET_PARTITION_BYTES, SORTED_PARTITION_BYTES)
    spark.conf.set(key, str(shuffle_partitions_for(input_bytes, spark.sparkContext.defaultParallelism, size)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def side_by_side(action: Callable[[str], object], names: Iterable[str]) -> None:
    """Run an action for several names, some at a time; the first error ends it."""
    with ThreadPoolExecutor(AT_ONCE) as workers:
        list(workers.map(action, names))


def counting_session(spark: SparkSession) -> SparkSession:
    """A session of the same application in which Parquet files are counted by their footers:
    ``count(*)``, with conditions on partitions or none, is answered by the scan."""
    counting = apply_settings(spark.newSession())
    sources = counting.conf.get("spark.sql.sources.useV1SourceList").split(",")
    counting.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in sources if s.strip() != "parquet"))
    counting.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return counting
