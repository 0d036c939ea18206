"""Product codes of vectors: codebooks by Lloyd's rounds over cover trees.

Vectors become whole numbers and are cut into parts; each part has a codebook. Every task
gathers its vectors into blocks and plants cover trees over each block's parts, once; the
blocks are stored. In each round the trees are walked with the codebooks: whole subtrees go to
an entry by the triangle inequality, only doubtful ones are looked into. What comes back is a
sum and a count per entry, of which the next codebooks are made. How vectors fall into blocks
makes no difference to the result: everything is in whole numbers and exact.

Edge cases: vectors that are NULL or empty or hold NULL or non-finite components take no part,
nor do those whose length is not a multiple of the number of parts or not that of the vector
of the smallest id. A NULL id comes after all others. Repeated rows count as often as they
occur, and start the codebooks as often. Fewer vectors than entries make a smaller codebook.
Components so large that squared distances would leave 64 bits are an error, as is a sum that
does. No vectors give no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox.llm import cover_tree
from farebox.llm.common import stored
from farebox.llm.hot_keys import with_value

# Parts, entries of a codebook, rounds, steps of a component's unit.
PARTS = 16
ENTRIES = 64
ROUNDS = 2
STEPS = 256

BLOCK = 8192  # vectors whose trees are planted together


def usable(vector: str, parts: int) -> Column:
    """Whether every component is a finite number and the length a multiple of ``parts``."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    size = F.size(vector)
    return F.coalesce(finite & (size > 0) & (size % parts == 0), F.lit(False))


def whole_numbers(vectors: pa.Array, width: int) -> np.ndarray:
    """Components in steps, rounded down."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    held = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
    steps = np.floor(held * STEPS)
    most = (1 << 31) / np.sqrt(width)  # half the root of what 64 bits hold, per component
    if steps.size and np.abs(steps).max() >= most:
        raise ValueError(f"components of {most / STEPS:.3g} or more are too large for exact codes")
    return steps.astype(np.int64)


def _planted(width: int, parts: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def planted() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            forest = cover_tree.plant(whole_numbers(table["vector"], width), parts)
            offsets = pa.array([0, len(table)], pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, table[c].combine_chunks()) for c in ("vec_id", "label")]
            return pa.RecordBatch.from_arrays(
                [*lists, pa.array([forest.packed()], pa.binary())], ["vec_id", "label", "forest"]
            )

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= block:
                yield planted()
                held = []
        if sum(b.num_rows for b in held):
            yield planted()

    return run


def _summed(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The entries after one round: the mean of what each got, rounded down, or as before."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts * entries, width + 1), dtype=np.int64)
        for batch in batches:
            for packed in batch.column(0):
                forest = cover_tree.Forest.unpacked(packed.as_py())
                sums, counts = cover_tree.entry_sums(forest, cover_tree.assign(forest, books), entries)
                total[:, :width] += sums
                total[:, width] += counts
        slot = np.flatnonzero(np.repeat(total[:, width] > 0, width + 1))
        if len(slot):
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total.reshape(-1)[slot])], ["slot", "total"])

    found = blocks.select("forest").mapInArrow(run, "slot bigint, total bigint")
    # As many rows as the codebooks have numbers, however many vectors there are.
    table = found.groupBy("slot").agg(F.sum("total").alias("total")).toArrow()
    total = np.zeros(parts * entries * (width + 1), dtype=np.int64)
    total[table["slot"].to_numpy()] = table["total"].to_numpy()
    total = total.reshape(parts, entries, width + 1)
    count = total[:, :, width:]
    return np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books)


def _coded(blocks: DataFrame, books: np.ndarray, label: T.DataType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                forest = cover_tree.Forest.unpacked(batch.column(2)[i].as_py())
                code, error = cover_tree.codes(forest, cover_tree.assign(forest, books), books)
                digits = [row.tobytes().hex() for row in code.astype(np.uint8)]
                ids, labels = (batch.column(c)[i].values for c in range(2))
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array(digits), pa.array(error)], ["vec_id", "label", "code", "error"]
                )

    schema = T.StructType.fromDDL("vec_id bigint, code string, error bigint").fields
    schema.insert(1, T.StructField("label", label))
    return blocks.mapInArrow(run, T.StructType(schema))


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components as decimal text, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def code_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    block: int = BLOCK,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every vector that takes part, and the final codebooks as
    whole numbers, (parts, entries, length of a part).

    A code is two hexadecimal digits per part, so there may be 256 entries at most. Only the
    ``entries`` vectors of smallest id and the sums per entry come to the driver.
    """
    if not 0 < entries <= 256:
        raise ValueError("a codebook has between 1 and 256 entries")
    spark = vectors.sparkSession
    taken = vectors.where(usable(vector, parts)).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(label).alias("label"), F.col(vector).alias("vector")
    )
    least = [F.asc_nulls_last("vec_id"), "vector"]
    first = taken.orderBy(*least).limit(1).select(F.size("vector")).head()
    kind = taken.schema["label"].dataType
    if first is None:
        schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", kind)])
        return spark.createDataFrame([], schema.add("code", T.StringType()).add("error", T.LongType())), np.zeros((parts, 0, 0), int)
    width = first[0]
    taken = taken.where(F.size("vector") == width)
    start = taken.orderBy(*least).limit(entries).select("vector").toArrow()
    books = whole_numbers(start["vector"], width).reshape(-1, parts, width // parts).transpose(1, 0, 2)
    books = np.ascontiguousarray(books)
    schema = T.StructType(
        [
            T.StructField("vec_id", T.ArrayType(T.LongType())),
            T.StructField("label", T.ArrayType(kind)),
            T.StructField("forest", T.BinaryType()),
        ]
    )
    blocks = stored(taken.mapInArrow(_planted(width, parts, block), schema), "cover-trees")
    for _ in range(rounds):
        books = _summed(blocks, books)
    return _coded(blocks, books, kind), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error`` beside each code: the errors of all vectors of its label, NULLs together."""
    coded = stored(coded, "codes")
    sums = coded.groupBy("label").agg(F.count("*").alias("copies"), F.sum("error").alias("value"))
    return with_value(coded, F.col("label"), sums.withColumnRenamed("label", "key")).withColumnRenamed(
        "value", "label_error"
    )


def oracle() -> str:
    """The same as DuckDB SQL, comparing every part with every entry."""

    def whole(above: str, below: str) -> str:
        return f"({above} - ((({above}) % {below}) + {below}) % {below}) // {below}"

    steps = f"""
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({STEPS} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    places AS (SELECT CAST(unnest(range({PARTS})) AS INT) AS part),
    pieces AS (
        SELECT vec_id, part, v[part * (len(v) // {PARTS}) + 1 : (part + 1) * (len(v) // {PARTS})] AS piece
        FROM kept, places),
    seeds AS (
        SELECT vec_id, CAST(row_number() OVER (ORDER BY vec_id) - 1 AS INT) AS entry
        FROM kept ORDER BY vec_id LIMIT {ENTRIES}),
    book0 AS (SELECT part, entry, piece AS mean FROM pieces JOIN seeds USING (vec_id))"""
    apart = "list_sum(list_transform(range(1, len(piece) + 1), lambda i: (piece[i] - mean[i]) * (piece[i] - mean[i])))"
    for n in range(ROUNDS + 1):
        steps += f""",
    near{n} AS (
        SELECT vec_id, p.part, any_value(piece) AS piece, min(CAST({apart} AS BIGINT)) AS missed,
               arg_min(entry, CAST({apart} AS BIGINT) * {ENTRIES} + entry) AS entry
        FROM pieces p JOIN book{n} b ON p.part = b.part GROUP BY vec_id, p.part)"""
        if n < ROUNDS:
            steps += f""",
    sums{n} AS (
        SELECT part, entry, place, sum(x) AS total, count(*) AS n
        FROM (SELECT part, entry, unnest(piece) AS x, unnest(range(len(piece))) AS place FROM near{n}) GROUP BY ALL),
    book{n + 1} AS (
        SELECT b.part, b.entry, coalesce(any_value(mean) FILTER (total IS NULL),
               list(CAST({whole("total", "n")} AS BIGINT) ORDER BY place)) AS mean
        FROM book{n} b LEFT JOIN sums{n} s ON b.part = s.part AND b.entry = s.entry GROUP BY b.part, b.entry)"""
    return steps + f""",
    coded AS (
        SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(missed) AS BIGINT) AS error
        FROM near{ROUNDS} GROUP BY vec_id),
    hashed AS (
        SELECT sha256(string_agg(array_to_string(mean, ','), ',' ORDER BY part, entry)) AS codebooks_sha256
        FROM book{ROUNDS})
    SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id), hashed"""
