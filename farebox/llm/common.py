"""What several text operators need: sessions, folds, tables, and hashed words."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import farebox
from farebox.session import apply_settings, work_folder

ARROW_ROWS = 1000
ARROW_BYTES = "4m"
WORDS_AT_ONCE = 1 << 20  # bytes of text whose words are hashed in one go
LARGE_ROWS = {  # how Parquet writes rows of a megabyte or so
    "compression": "none",
    "parquet.enable.dictionary": "false",
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
}

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, for clusters that have not installed it."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    _shipped.add(application)
    root = os.path.dirname(os.path.dirname(os.path.abspath(farebox.__file__)))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        for folder, _, names in os.walk(os.path.join(root, "farebox")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, root))
    target = work_folder(spark, "code") + ".zip"
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    stream = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    stream.write(packed.getvalue())
    stream.close()
    spark.sparkContext.addPyFile(target)


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the text operators rely on: small Arrow batches, since texts can be long."""
    apply_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    ship(spark)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_fold(doc_id: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls into ``fold``; a NULL id is in none."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds == fold, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name += "_"
    return name


def stored(
    df: DataFrame, purpose: str, drop_shuffles: bool = False, file_rows: int = 0, batch_rows: int = 0
) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, lineage cut. With
    ``drop_shuffles`` the shuffle files of the write go when it ends, and not when the driver
    happens to collect its garbage. With ``file_rows`` rows are large and do not compress: a file
    has so many at most, a page no more than it must. With ``batch_rows`` Parquet is read so many
    rows at a time: a batch of large ones is one array for each column, grown by doubling."""
    spark, conf = df.sparkSession, df.sparkSession.conf
    path, settings = work_folder(spark, purpose), {}
    if drop_shuffles:
        settings["spark.sql.classic.shuffleDependency.fileCleanup.enabled"] = "true"
    if batch_rows:
        settings["spark.sql.parquet.columnarReaderBatchSize"] = str(batch_rows)
    options = {"maxRecordsPerFile": file_rows, **LARGE_ROWS} if file_rows else {}
    before = {key: conf.get(key) for key in settings}
    for key, value in settings.items():
        conf.set(key, value)
    try:
        df.write.options(**options).parquet(path)
    finally:
        for key, value in before.items():
            conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def hashed_sample(rows: DataFrame, most: int) -> DataFrame:
    """At most ``most`` distinct rows: those with the smallest hashes, so that a sample does
    not depend on order, partitions or copies. It is empty only if there are no rows.

    Distinct rows are counted first, to within some hundredths, and only a share expected to hold
    four times as many is ordered: what meets in one task or at the driver is bounded, however
    many partitions and copies there are.
    """
    place = F.xxhash64(*rows.columns)
    n = rows.agg(F.approx_count_distinct(place)).head()[0]
    share = min(1.0, 4 * most / max(n, 1))
    limit = min((1 << 63) - 1, -(1 << 63) + int(share * (1 << 64)))
    return rows.where(place <= F.lit(limit)).distinct().orderBy(place, *rows.columns).limit(most)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, target: str, held_out: Column, most: int
) -> DataFrame:
    """At most ``most`` labelled documents outside the held-out fold, as (doc_id, label, text).

    Only the bounded list of ids and labels is broadcast, and the documents are read for it once,
    however often the sample is used. Rows with NULL id or label teach
    nothing; of several labels of an id the greatest counts, of several texts the least.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & ~held_out)
        .groupBy("doc_id")
        .agg(F.max(target).cast("int").alias("label"))
    )
    chosen = hashed_sample(known, most)
    found = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )
    return stored(found, "labelled")


# --- words as hashes ---

SPACES = b" \t\n\x0b\x0c\r"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the input moves every bit of the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mixed(x.astype(np.uint64, copy=False) + np.uint64(0x9E3779B97F4A7C15))


@cache
def _byte_values() -> np.ndarray:
    """A 64-bit value per byte, the same for A-Z and a-z."""
    values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    values[65:91] = values[97:123]
    return values


_BASE = 0x9FB21C651E98DF25
_INVERSE = pow(_BASE, -1, 1 << 64)


@cache
def _powers(base: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        factors = np.full(n + 1, base, dtype=np.uint64)
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)


@cache
def separator_table(letters_only: bool) -> np.ndarray:
    """Which bytes part words: white space, or else all ASCII but letters and digits."""
    table = np.zeros(256, dtype=bool)
    table[list(SPACES)] = True
    if letters_only:
        table[:128] = [not chr(b).isalnum() for b in range(128)]
    return table


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each row begins and ends; NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    column = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_places(
    data: np.ndarray, offsets: np.ndarray, letters_only: bool = False
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words begin and end, and how many each row has; a row's end ends a word."""
    inside = ~separator_table(letters_only)[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[:1], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1:], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range, A-Z read as a-z; ranges begin in rising order."""
    hashes = np.empty(len(starts), dtype=np.uint64)
    values, at = _byte_values(), 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            low = starts[at]
            stop = max(at + 1, int(np.searchsorted(ends, low + WORDS_AT_ONCE, side="right")))
            span = int(ends[at:stop].max() - low)
            size = max(WORDS_AT_ONCE, 1 << (span - 1).bit_length())
            forward, back = _powers(_BASE, size), _powers(_INVERSE, size)
            sums = np.concatenate(
                ([np.uint64(0)], np.cumsum(values[data[low : low + span]] * forward[:span], dtype=np.uint64))
            )
            first, last = starts[at:stop] - low, ends[at:stop] - low
            hashes[at:stop] = (sums[last] - sums[first]) * back[first] + (last - first).astype(np.uint64)
            at = stop
        return mixed(hashes)


def words_hashed(texts: pa.Array, letters_only: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of every row, and how many words each row has."""
    data, offsets = text_bytes(texts)
    starts, ends, counts = word_places(data, offsets, letters_only)
    return range_hashes(data, starts, ends), counts


def row_starts(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts)))


def over_batches(
    function: Callable[[pa.RecordBatch], pa.RecordBatch | None],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Make a function of one batch fit ``mapInArrow``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = function(batch)
            if made is not None and made.num_rows:
                yield made

    return run
