"""Nearest neighbours by multi-index hashing.

Vectors become binary codes: centred, projected by rotations that are learned (iterative
quantisation on a bounded sample), and cut at zero. A code is split into substrings of 16
bits, each indexed by value. Two codes within Hamming radius r must, in some substring, be
within r divided by the number of substrings; so probing each index that far finds every
code within r, and the true distances of the vectors found decide.

The radius is the one that held nearly all true neighbours in the sample, where they lie
farther apart than among all vectors. Where a batch of vectors has fewer than k within it,
the radius grows until it has.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import hashed_sample

MOST_TRAINING = 20_000  # vectors that rotations and radius are learned from
MOST_TRIED = 200  # of these, queries for the radius
BITS = 128
SUBSTRING = 16
COVERED = 0.98  # share of the sample's true neighbours within the radius
QUERIES_AT_ONCE = 2000
VECTORS_AT_ONCE = 16_384

_ONES = np.array([bin(v).count("1") for v in range(1 << SUBSTRING)], dtype=np.uint8)


@dataclass
class Codes:
    centre: np.ndarray
    rotation: np.ndarray
    radius: int = 0

    def substrings(self, vectors: np.ndarray) -> np.ndarray:
        """Codes as one 16-bit number per substring."""
        bits = (vectors - self.centre) @ self.rotation > 0
        packed = np.packbits(bits, axis=1, bitorder="little")
        return np.ascontiguousarray(packed).view("<u2")

    @property
    def n_substrings(self) -> int:
        return self.rotation.shape[1] // SUBSTRING


def _rotated(data: np.ndarray, rng: np.random.Generator, rounds: int = 30) -> np.ndarray:
    """An orthogonal rotation that brings the data close to the corners of a cube."""
    rotation = np.linalg.qr(rng.normal(size=(data.shape[1], data.shape[1])))[0]
    for _ in range(rounds):
        turned = np.where(data @ rotation > 0, 1.0, -1.0)
        u, _, v = np.linalg.svd(data.T @ turned)
        rotation = u @ v
    return rotation


def learn(sample: np.ndarray, k: int) -> Codes:
    rng = np.random.default_rng(11)
    centre = sample.mean(axis=0)
    data = sample - centre
    turns = [_rotated(data, rng) for _ in range(math.ceil(BITS / sample.shape[1]))]
    codes = Codes(centre, np.concatenate(turns, axis=1)[:, :BITS])
    marks = codes.substrings(sample)
    tried = rng.permutation(len(sample))[:MOST_TRIED]
    reached = []
    for i in tried:
        distance = ((sample - sample[i]) ** 2).sum(axis=1)
        distance[i] = np.inf
        near = np.argsort(distance, kind="stable")[: min(k, len(sample) - 1)]
        reached.append(_ONES[marks[near] ^ marks[i]].sum(axis=1, dtype=np.int64))
    found = np.concatenate(reached) if reached else np.zeros(0)
    codes.radius = int(np.quantile(found, COVERED)) if len(found) else BITS
    return codes


class SubstringIndex:
    """The vectors of a batch, with an index over each substring of their codes."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: Codes):
        self.ids, self.vectors, self.codes = ids, vectors, codes
        self.marks = codes.substrings(vectors)
        self.values, self.places = [], []
        for column in self.marks.T:
            values, place = np.unique(column, return_inverse=True)
            self.values.append(values)
            self.places.append(place)

    def within(self, mark: np.ndarray, radius: int) -> np.ndarray:
        """Every row whose code is at most ``radius`` bits from ``mark``."""
        share, rest = divmod(radius, self.codes.n_substrings)
        met = np.zeros(len(self.ids), dtype=bool)
        for i, (values, place) in enumerate(zip(self.values, self.places, strict=True)):
            # One of the first rest+1 substrings differs by share at most, or else one of
            # the others by share-1.
            bound = share if i <= rest else share - 1
            met |= (_ONES[values ^ mark[i]] <= bound)[place]
        rows = np.flatnonzero(met)
        return rows[_ONES[self.marks[rows] ^ mark].sum(axis=1, dtype=np.int64) <= radius]

    def nearest(self, query_id: int, query: np.ndarray, mark: np.ndarray, k: int) -> tuple:
        """Ids and distances of the k nearest found, each id once, ties to smaller ids."""
        radius = self.codes.radius
        rows = self.within(mark, radius)
        rows = rows[self.ids[rows] != query_id]
        while len(np.unique(self.ids[rows])) < k and radius < BITS:
            radius = min(BITS, radius + 8)
            rows = self.within(mark, radius)
            rows = rows[self.ids[rows] != query_id]
        return first_of(self.ids[rows], np.sqrt(((self.vectors[rows] - query) ** 2).sum(axis=1)), k)


def first_of(ids: np.ndarray, distances: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, distances))
    ids, distances = ids[order], distances[order]
    _, first = np.unique(ids, return_index=True)
    keep = np.sort(first)[:k]
    return ids[keep], distances[keep]


def as_matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)


def usable(vectors: DataFrame, vector: str) -> Column:
    """Neither NULL nor zero, and every component a finite number."""
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _batches(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors, some thousands at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= VECTORS_AT_ONCE:
            yield _joined(held, width)
            held = []
    if sum(b.num_rows for b in held):
        yield _joined(held, width)


def _joined(held: list[pa.RecordBatch], width: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.concatenate([b.column(0).to_numpy(zero_copy_only=False) for b in held])
    return ids, np.concatenate([as_matrix(b.column(1), width) for b in held])


FOUND = "query_id bigint, vec_id bigint, score double"


def _searched(vectors: DataFrame, block: tuple, codes: Codes, k: int) -> DataFrame:
    """The k nearest per query of one block within each partition."""
    sent = vectors.sparkSession.sparkContext.broadcast((*block, codes))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, codes = sent.value
        marks = codes.substrings(queries)
        best: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0))] * len(query_ids)
        for ids, matrix in _batches(batches, queries.shape[1]):
            index = SubstringIndex(ids, matrix, codes)
            for i, query_id in enumerate(query_ids):
                near = index.nearest(query_id, queries[i], marks[i], k)
                both = [np.concatenate(pair) for pair in zip(best[i], near, strict=True)]
                best[i] = first_of(*both, k)
        counts = [len(ids) for ids, _ in best]
        if sum(counts):
            columns = [np.repeat(query_ids, counts), *(np.concatenate(c) for c in zip(*best, strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score"])

    return vectors.mapInArrow(search, FOUND)


def nearest_neighbours(
    vectors: DataFrame, queries: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The k nearest vectors of every row for which ``queries`` holds: query_id, rank, vec_id
    and score, the Euclidean distance in double precision, nearest first, ties to smaller ids.

    Vectors that are NULL, zero or hold NULL or non-finite components take no part, nor do
    those with a NULL id or of another length than most of the sample. An id with several
    rows counts once, at its nearest; as a query it is its least vector. Without vectors or
    queries the result is empty. Queries are sent to the vectors in blocks of bounded size.
    """
    spark = vectors.sparkSession
    taken = vectors.where(usable(vectors, vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector")
    )
    sample = hashed_sample(taken, MOST_TRAINING).toArrow().sort_by("vec_id")
    empty = spark.createDataFrame([], FOUND)
    result = empty
    if len(sample):
        lists = sample["vector"].combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        width = int(np.bincount(lengths).argmax())
        codes = learn(as_matrix(lists.filter(pa.array(lengths == width)), width), k)
        taken = taken.where(F.size("vector") == width)
        asked = vectors.where(queries).select(F.col(vec_id).cast("bigint").alias("vec_id"))
        asked = taken.join(asked.distinct(), "vec_id", "left_semi").groupBy("vec_id").agg(F.min("vector").alias("vector"))
        blocks = math.ceil(asked.count() / QUERIES_AT_ONCE)
        parts = []
        for block in range(blocks):
            chosen = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).toArrow().sort_by("vec_id")
            if len(chosen):
                matrix = as_matrix(chosen["vector"].combine_chunks(), width)
                parts.append(_searched(taken, (chosen["vec_id"].to_numpy(), matrix), codes, k))
        result = reduce(DataFrame.unionByName, parts, empty)
    best = result.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
