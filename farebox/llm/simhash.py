"""Near copies by SimHash fingerprints, found with vantage-point trees.

Documents of one fingerprint are one row with the least of their ids. Fingerprints that differ
in few bits are found in vantage-point trees: a set is parted by the Hamming distance of its
members to one of them, into those up to a bound and those beyond, and so on. By the triangle
inequality two fingerprints within a radius of each other have distances to the vantage point
that differ by the radius at most; so it is enough to search the near side, and the far side
together with those of the near side that lie within the radius of the bound. The upper levels
of the trees, learned from a bounded sample, deal the fingerprints out to shards, of which
neighbouring ones overlap in that way; in each shard the tree is carried on, and what is too
small or too dense to part is compared pair by pair.

Distances between whole unlike fingerprints spread by four bits only, no more than the radius,
so that a tree over whole fingerprints parts next to nothing. There is a tree for each third of
the bits instead. If two fingerprints differ in four bits, the first or second third
differs in one at most or the last in none: with radii of 1, 1 and 0 bounds part well, no pair
is lost, and the whole fingerprints decide.

Of each group of linked fingerprints in a shard, links that join it are passed on, fewer than
there are members, and joined over all shards.

Edge cases: a NULL or empty text, or one without words, has fingerprint zero, which is linked
like any other. Fewer words than a shingle has are one shingle. A NULL id is never the least of
a component that has others; a component of NULL ids alone is NULL. Repeated rows stay rows.
Other columns are not read. No documents give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import hashed_sample, over_batches, row_starts, stored, text_bytes, word_places
from farebox.llm.components import components
from farebox.llm.hot_keys import with_value

# Words of a shingle, seed of their hash, bits that linked fingerprints differ in.
WORDS = 4
SEED = 42
RADIUS = 4

#: First bit, number of bits and radius of each part that has a tree.
PARTS = ((0, 21, 1), (21, 21, 1), (42, 22, 0))

MOST_SAMPLED = 1 << 17  # fingerprints that the upper levels of the trees are learned from
LEAST_SAMPLED = 24  # fewer of the sample in a shard are not parted further
SHARD = 8000  # fingerprints that a shard should have
MOST_AT_ONCE = 40_000  # a shard with more is searched in tiles
LEAF = 256  # so few are compared pair by pair
SIDE = 1024  # rows and columns compared at once

_LANES = np.uint64(0x0101010101010101)


# --- fingerprints ---


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For each row, the bits set in over half of its hashes; rows without hashes are zero."""
    made = np.zeros(len(counts), dtype=np.uint64)
    full = counts > 0
    if not full.any():
        return made
    # Sums of up to 255 bits at a time in the bytes of a word, eight shifts for all 64 bits.
    begins = row_starts(counts)[:-1][full]
    pieces = -(-counts[full] // 255)
    first = np.cumsum(pieces) - pieces
    at = np.repeat(begins, pieces) + 255 * (np.arange(pieces.sum()) - np.repeat(first, pieces))
    total = np.zeros((len(begins), 64), dtype=np.int64)
    for shift in range(8):
        lanes = (hashes >> np.uint64(shift)) & _LANES
        sums = np.add.reduceat(lanes, at).astype("<u8").view(np.uint8).reshape(-1, 8)
        total[:, shift::8] = np.add.reduceat(sums.astype(np.int64), first, axis=0)
    bits = 2 * total > counts[full][:, None]
    made[full] = np.packbits(bits, axis=1, bitorder="little").view("<u8")[:, 0]
    return made


def fingerprints(texts: pa.Array, words: int = WORDS) -> np.ndarray:
    """The fingerprint of every text, by the hashes of its shingles, repeats included."""
    data, offsets = text_bytes(texts)
    starts, ends, n_words = word_places(data, offsets)
    if not len(starts):
        return np.zeros(len(n_words), dtype=np.uint64)
    # Words one after another with a space between: a shingle is then one range of bytes.
    sizes = ends - starts
    joined = np.full(int(sizes.sum()) + len(sizes), 32, dtype=np.uint8)
    begin = np.cumsum(sizes + 1) - sizes - 1
    held = np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))
    lowered = data[held]
    lowered = np.where((lowered >= 65) & (lowered <= 90), lowered + 32, lowered).astype(np.uint8)
    joined[np.repeat(begin - np.cumsum(sizes) + sizes, sizes) + np.arange(len(held))] = lowered
    end = begin + sizes
    n_shingles = np.where(n_words > 0, np.maximum(n_words - words + 1, 1), 0)
    row = np.repeat(np.arange(len(n_words)), n_shingles)
    first_word = row_starts(n_words)[:-1]
    first = np.arange(len(row)) - np.repeat(row_starts(n_shingles)[:-1], n_shingles) + first_word[row]
    last = first + np.minimum(words, n_words[row]) - 1
    text, hashed = joined.tobytes(), xxhash.xxh64_intdigest
    spans = zip(begin[first].tolist(), end[last].tolist(), strict=True)
    hashes = np.fromiter((hashed(text[a:b], SEED) for a, b in spans), dtype=np.uint64, count=len(row))
    return majority_bits(hashes, n_shingles)


def _printed(batch: pa.RecordBatch) -> pa.RecordBatch:
    made = fingerprints(batch.column("text")).view(np.int64)
    return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made)], ["doc_id", "bits"])


# --- vantage-point trees ---


def _part(prints: np.ndarray, part: int) -> np.ndarray:
    first, size, _ = PARTS[part]
    return (prints >> np.uint64(first)) & np.uint64((1 << size) - 1)


def apart(values: np.ndarray, vantage: int | np.uint64) -> np.ndarray:
    return np.bitwise_count(values ^ np.uint64(vantage)).astype(np.int64)


def best_bound(distances: np.ndarray, radius: int) -> int | None:
    """The bound that leaves the fewest pairs on its two sides, or None where none leaves fewer
    than there are."""
    counts = np.bincount(distances, minlength=2)
    near = np.cumsum(counts)[:-1].astype(np.float64)
    edge = np.cumsum(np.concatenate((np.zeros(radius, np.int64), counts)))[: len(near)] if radius else near
    far = len(distances) - edge
    cost = near**2 + far**2
    cost[(near == 0) | (far == len(distances))] = np.inf
    best = int(cost.argmin())
    return best if cost[best] < 0.9 * float(len(distances)) ** 2 else None


@dataclass(frozen=True)
class Node:
    """A vantage point and a bound, or the number of a shard."""

    vantage: int = 0
    bound: int = 0
    near: Node | None = None
    far: Node | None = None
    shard: int = -1


def _vantage(values: np.ndarray, depth: int) -> int:
    """One of the values, by a rule that gives the same for the same values."""
    return int(values[(depth * 0x9E3779B1 + len(values) // 2) % len(values)])


def upper_tree(values: np.ndarray, radius: int, least: int) -> tuple[Node, int]:
    """A tree over a sample whose shards have about ``least`` of it, and how many shards."""
    shards = 0

    def grown(values: np.ndarray, depth: int) -> Node:
        nonlocal shards
        if len(values) > least:
            vantage = _vantage(values, depth)
            distances = apart(values, vantage)
            bound = best_bound(distances, radius)
            if bound is not None:
                near, far = values[distances <= bound], values[distances > bound - radius]
                return Node(vantage, bound, grown(near, depth + 1), grown(far, depth + 1))
        shards += 1
        return Node(shard=shards - 1)

    return grown(np.sort(values), 0), shards


def dealt(values: np.ndarray, radius: int, tree: Node) -> Iterator[tuple[int, np.ndarray]]:
    """The shards and the places of the values that belong into each, overlaps included."""
    waiting = [(tree, np.arange(len(values)))]
    while waiting:
        node, rows = waiting.pop()
        if not len(rows):
            continue
        if node.shard >= 0:
            yield node.shard, rows
            continue
        distances = apart(values[rows], node.vantage)
        waiting.append((node.near, rows[distances <= node.bound]))
        waiting.append((node.far, rows[distances > node.bound - radius]))


class Groups:
    """Numbers joined by pairs; each knows a lesser one of its group, or is its least."""

    def __init__(self, n: int) -> None:
        self.lesser = np.arange(n)

    def least(self, numbers: np.ndarray) -> np.ndarray:
        while True:
            onward = self.lesser[numbers]
            if (onward == numbers).all():
                return numbers
            numbers = onward

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.least(a), self.least(b)
            differ = a != b
            a, b = a[differ], b[differ]
            np.minimum.at(self.lesser, np.maximum(a, b), np.minimum(a, b))


def _compared(prints: np.ndarray, rows: np.ndarray, groups: Groups, radius: int) -> None:
    """Join what is within the radius, pair by pair, a bounded square at a time."""
    for i in range(0, len(rows), SIDE):
        left = rows[i : i + SIDE]
        for j in range(i, len(rows), SIDE):
            right = rows[j : j + SIDE]
            near = np.bitwise_count(prints[left][:, None] ^ prints[right][None]) <= radius
            a, b = np.nonzero(near)
            keep = left[a] != right[b]
            groups.join(left[a[keep]], right[b[keep]])


def joined(prints: np.ndarray, part: int, radius: int = RADIUS) -> np.ndarray:
    """For each fingerprint of a shard, the least place of those it is linked with by links
    that the part's tree finds."""
    groups = Groups(len(prints))
    values, reach = _part(prints, part), PARTS[part][2]
    waiting = [(np.argsort(values, kind="stable"), 0)]
    while waiting:
        rows, depth = waiting.pop()
        if len(rows) > LEAF:
            vantage = _vantage(values[rows], depth)
            distances = apart(values[rows], vantage)
            bound = best_bound(distances, reach)
            if bound is not None:
                waiting.append((rows[distances <= bound], depth + 1))
                waiting.append((rows[distances > bound - reach], depth + 1))
                continue
        _compared(prints, rows, groups, radius)
    return groups.least(np.arange(len(prints)))


# --- the search over all shards ---


def _to_shards(prints: DataFrame, trees: list[Node]) -> DataFrame:
    """(part, shard, bits): every fingerprint in all shards of every tree that it belongs into."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        bits = batch.column(0).to_numpy()
        parts, shards, rows = [], [], []
        for part, tree in enumerate(trees):
            for shard, places in dealt(_part(bits.view(np.uint64), part), PARTS[part][2], tree):
                parts.append(np.full(len(places), part, np.int32))
                shards.append(np.full(len(places), shard, np.int32))
                rows.append(bits[places])
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (parts, shards, rows)]
        kinds = (pa.int32(), pa.int32(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "shard", "bits"])

    return prints.select("bits").mapInArrow(over_batches(run), "part int, shard int, bits bigint")


def _in_tiles(dealt_out: DataFrame) -> DataFrame:
    """(part, shard, tile, bits): a shard too large for one task is cut into blocks by hash,
    and every two blocks make a tile, so that any two of its fingerprints meet in one."""
    sizes = dealt_out.groupBy("part", "shard").agg(F.count("*").alias("size"))
    half = MOST_AT_ONCE // 2
    blocks = F.when(F.col("size") <= MOST_AT_ONCE, F.lit(1)).otherwise(F.ceil(F.col("size") / half)).cast("int")
    large = dealt_out.join(F.broadcast(sizes.select("part", "shard", blocks.alias("blocks"))), ["part", "shard"])
    block = F.pmod(F.xxhash64("bits"), F.col("blocks"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.least(other, block) * F.col("blocks") + F.greatest(other, block),
    )
    return large.select("part", "shard", F.explode(pairs).alias("tile"), "bits")


def _links(table: pa.Table) -> pa.Table:
    """Links that join the groups of one tile: each member to its group's least place."""
    bits = np.unique(table["bits"].to_numpy())
    least = joined(bits.view(np.uint64), table["part"][0].as_py())
    member = np.flatnonzero(least != np.arange(len(least)))
    return pa.table({"a": bits[member], "b": bits[least[member]]})


def linked(prints: DataFrame) -> DataFrame:
    """(a, b): links between distinct fingerprints, column ``bits``, that join all that are linked."""
    n = prints.count()
    sample = hashed_sample(prints.select("bits"), MOST_SAMPLED).toArrow()["bits"].to_numpy().view(np.uint64)
    least = max(LEAST_SAMPLED, int(len(sample) * SHARD / max(n, 1)))
    trees = [upper_tree(_part(sample, part), reach, least)[0] for part, (_, _, reach) in enumerate(PARTS)]
    dealt_out = stored(_to_shards(prints, trees), "shards")
    tiles = _in_tiles(dealt_out).groupBy("part", "shard", "tile")
    return tiles.applyInArrow(_links, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, bits, component_id) for every document: its fingerprint, and the least id that
    can be reached by links between fingerprints."""
    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    rows = stored(read.mapInArrow(over_batches(_printed), "doc_id bigint, bits bigint"), "fingerprints")
    prints = rows.groupBy("bits").agg(F.count("*").alias("copies"), F.min("doc_id").alias("least"))
    prints = stored(prints, "distinct-fingerprints")
    found = components(stored(linked(prints), "links")).withColumnRenamed("node", "bits")
    named = stored(prints.join(found, "bits", "left").withColumn("component", F.coalesce("component", "bits")), "groups")
    least = named.groupBy(F.col("component").alias("key")).agg(
        F.count("*").alias("copies"), F.min("least").alias("value")
    )
    values = with_value(named, F.col("component"), least).select(F.col("bits").alias("key"), "copies", "value")
    return with_value(rows, F.col("bits"), values).withColumnRenamed("value", "component_id")
