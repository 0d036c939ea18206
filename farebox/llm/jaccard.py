"""Documents whose sets of five-word shingles overlap, joined exactly.

Two sets with a Jaccard similarity of ``LINKED`` percent or more have one in ``SPARE`` of
their shingles in common among the first quarter of each, in any one order. That order is
by hash, with shingles that are common in a sample of documents last. A document of whose
first shingles fewer are found elsewhere is linked with none and put aside; only documents
that share a first shingle are ever compared, and equal sets count as one.

Documents that first shingles connect, however indirectly, are a cluster; no link leads out
of it. The shingles that most documents have are left out of this as far as each document
has more in common with any it can be linked with. Clusters go to tiles: their documents by
size, in pieces of bounded length, and each piece beside itself and those of sizes near
enough. Within a tile, bands of size are compared by bitmaps of hashed shingles: the bits
that one has and the other lacks bound the overlap from above. Pairs that pass are decided
by the intersection of the sorted arrays, likeliest first, and only as long as the two are
not joined by links of the tile already; so a tile gives fewer links than it has documents.

Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.llm.common import free_name, hashed_sample, mixed, over_batches, row_starts, stored, words_hashed
from farebox.llm.components import components
from farebox.llm.lm import build_filter

SHINGLE = 5
LINKED = 80  # percent
SPARE = 20  # one in so many shingles is a further one that the first ones must share
# Of n shingles, how many first ones are in common with any set that can be linked; the
# smaller of two linked sets has at least LINKED percent of the larger's size.
IN_COMMON = f"(1 + floor(ceil(n * {LINKED} / 100) / {SPARE}))"
MOST_SAMPLED = 2000  # documents that tell which shingles are common
COMMON = 4  # of these
PEELED = 2  # times that documents with too little in common are put aside
TILE = 400_000  # shingles in a piece
BAND = 1.25  # sizes in a band; beyond the next band no pair can be linked
LEAST_BITS = 64
# Spark may filter a side of a join by a Bloom filter of the other, if that is this small;
# the filter's own size is bounded by Spark.
BLOOM_FILTERS = {"enabled": "true", "applicationSideScanSizeThreshold": "0", "creationSideThreshold": "256m"}
SIEVE_BYTES = 8 << 20  # of the Bloom filter that tells rows which may have to go

_PLACES = mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of every text, sorted within each, and how many each has."""
    words, counts = words_hashed(texts)
    starts, row = row_starts(counts)[:-1], np.repeat(np.arange(len(counts)), counts)
    with np.errstate(over="ignore"):
        n = max(len(words) - SHINGLE + 1, 0)
        whole = np.zeros(n, dtype=np.uint64)
        for k in range(SHINGLE):
            whole += words[k : n + k] * _PLACES[k]
        inside = np.flatnonzero(row[:n] == row[SHINGLE - 1 :]) if n else np.zeros(0, np.int64)
        hashes, rows = [mixed(whole[inside])], [row[inside]]
        short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
        summed = counts[short].astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
        for k in range(SHINGLE - 1):
            has = counts[short] > k
            summed[has] += words[starts[short[has]] + k] * _PLACES[k]
        hashes.append(mixed(summed))
        rows.append(short)
    hashes, rows = np.concatenate(hashes), np.concatenate(rows)
    # By hash, then by row in the same order: of small numbers a radix sort.
    order = np.argsort(hashes)
    order = order[np.argsort(rows[order].astype(np.min_scalar_type(len(counts))), kind="stable")]
    hashes, rows = hashes[order], rows[order]
    first = np.ones(len(hashes), dtype=bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    return hashes[first], np.bincount(rows[first], minlength=len(counts))


def set_keys(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A key for each set: equal sets have equal keys."""
    with np.errstate(over="ignore"):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(hashes), dtype=np.uint64)))
        bounds = row_starts(sizes)
        return mixed((sums[bounds[1:]] - sums[bounds[:-1]]) ^ sizes.astype(np.uint64)).view(np.int64)


def prefix_length(sizes: np.ndarray) -> np.ndarray:
    """How many first shingles hold enough that are also among any linked set's first.

    Of two linked sets the overlap is ``LINKED`` percent of the larger at least. If only one
    in common were asked of them, the shingles beyond that overlap and one more would do;
    each further one takes one more.
    """
    return np.minimum(sizes, sizes - -(-sizes * LINKED // 100) + 1 + sizes // SPARE)


def first_shingles(hashes: np.ndarray, sizes: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of every set, and how many each has; ``common`` ones come last."""
    row = np.repeat(np.arange(len(sizes)), sizes)
    late = np.zeros(len(hashes), dtype=bool)
    if len(common):
        late = common[np.minimum(np.searchsorted(common, hashes), len(common) - 1)] == hashes
    order = np.argsort(2 * row + late, kind="stable")
    place = np.arange(len(hashes)) - np.repeat(row_starts(sizes)[:-1], sizes)
    lengths = prefix_length(sizes)
    return hashes[order][place < lengths[row]], lengths


def _measured(batch: pa.RecordBatch, common: np.ndarray) -> pa.RecordBatch:
    """Size and key of each row's set, and the first shingles of one row of each set in the batch."""
    hashes, sizes = shingle_sets(batch.column(2))
    keys = set_keys(hashes, sizes)
    once = np.zeros(len(sizes), dtype=bool)
    once[np.unique(keys, return_index=True)[1]] = True
    kept = np.where(once, sizes, 0)
    found, lengths = first_shingles(hashes[np.repeat(once, sizes)], kept, common)
    ends = pa.array(8 * row_starts(lengths), pa.int32())
    first = pa.Array.from_buffers(pa.binary(), len(sizes), [None, ends.buffers()[1], pa.py_buffer(found.tobytes())])
    return pa.RecordBatch.from_arrays(
        [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(keys), first],
        ["doc_id", "row", "n", "key", "first"],
    )


def _postings(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(shingle, key) of the first shingles of each row."""
    held = batch.column(1).to_pylist()
    shingles = np.frombuffer(b"".join(held), np.int64)
    keys = np.repeat(batch.column(0).to_numpy(), [len(first) // 8 for first in held])
    return pa.RecordBatch.from_arrays([pa.array(shingles), pa.array(keys)], ["shingle", "key"])


def _bits(n: int) -> int:
    """Bits of a set's bitmap, a power of two that halves to that of smaller sets."""
    return max(LEAST_BITS, 1 << (2 * n - 1).bit_length())


def bitmap(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(_bits(len(hashes)), dtype=bool)
    bits[(hashes & np.uint64(len(bits) - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view(np.uint64)


def _signed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Key, size and sorted array of each set."""
    hashes, sizes = shingle_sets(batch.column(0))
    bounds = row_starts(sizes)
    arrays = [hashes[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
    columns = [pa.array(set_keys(hashes, sizes)), pa.array(sizes, pa.int64()), pa.array(arrays, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["key", "n", "shingles"])


def folded(bitmaps: list[np.ndarray], width: int) -> np.ndarray:
    """Bitmaps halved onto themselves to ``width`` bits, as rows of 64-bit numbers."""
    rows = np.empty((len(bitmaps), width // 64), dtype=np.uint64)
    for i, bits in enumerate(bitmaps):
        rows[i] = np.bitwise_or.reduce(bits.reshape(-1, width // 64), axis=0)
    return rows


def overlap_bounds(one: np.ndarray, n: int, others: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The most shingles that a set can share with each of the others, by their bitmaps."""
    lacking = np.bitwise_count(one & ~others).sum(axis=1, dtype=np.int64)
    extra = np.bitwise_count(others & ~one).sum(axis=1, dtype=np.int64)
    return np.minimum(n - lacking, sizes - extra)


def may_link(shared: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    return 100 * shared >= LINKED * (n + sizes - shared)


@dataclass
class Tile:
    """Documents of one or two pieces of a cluster, by size."""

    across: bool  # whether only pairs of different pieces count
    keys: np.ndarray
    sizes: np.ndarray
    piece: np.ndarray
    sets: list[np.ndarray]

    def links(self) -> list[tuple[int, int]]:
        """Links that join all documents which links within the tile connect."""
        sizes, found = self.sizes, []
        bitmaps = [bitmap(s) for s in self.sets]
        group = np.arange(len(sizes))
        start = 0
        while start < len(sizes):
            width = _bits(int(sizes[start]))
            band = max(start + 1, int(np.searchsorted(sizes, sizes[start] * BAND, side="left")))
            reach = int(np.searchsorted(sizes, 100 * sizes[band - 1] // LINKED, side="right"))
            marks = folded(bitmaps[start:reach], width) if reach > start + 1 else None
            for i in range(start, min(band, reach - 1)):
                other = group[i + 1 : reach] != group[i]
                if self.across:
                    other &= self.piece[i + 1 : reach] != self.piece[i]
                at = np.flatnonzero(other) + i + 1
                if not len(at):
                    continue
                bound = overlap_bounds(marks[i - start], int(sizes[i]), marks[at - start], sizes[at])
                fits = np.flatnonzero(may_link(bound, int(sizes[i]), sizes[at]))
                for j in at[fits[np.argsort(-bound[fits], kind="stable")]].tolist():
                    if group[i] != group[j] and are_linked(self.sets[i], self.sets[j]):
                        found.append((int(self.keys[i]), int(self.keys[j])))
                        group[group == group[j]] = group[i]
            start = band
        return found


def are_linked(one: np.ndarray, other: np.ndarray) -> bool:
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * shared >= LINKED * (len(one) + len(other) - shared)


TILE_COLUMNS = ["cluster", "left", "right", "n", "key", "piece", "shingles"]


def _tiles_in(batches: Iterator[pa.RecordBatch]) -> Iterator[Tile]:
    """Tiles from rows sorted by tile and size, which may run on from batch to batch."""
    held: list[pa.RecordBatch] = []
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            held.append(batch)
            marks = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(3)]
            if not len(marks[0]) or all(m[0] == m[-1] for m in marks) and len(held) == 1:
                continue
        if not held:
            return
        rows = pa.Table.from_batches(held).combine_chunks()
        marks = [rows[c].to_numpy() for c in TILE_COLUMNS[:3]]
        changed = np.zeros(max(len(rows) - 1, 0), dtype=bool)
        for m in marks:
            changed |= m[1:] != m[:-1]
        cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), len(rows)]
        whole = cuts if batch is None else cuts[:-1]  # the last tile may go on
        numbers = [rows[c].to_numpy() for c in ("key", "n", "piece")]
        arrays = rows["shingles"].combine_chunks()
        for a, b in itertools.pairwise(whole):
            if b - a > 1:
                keys, sizes, piece = (x[a:b] for x in numbers)
                sets = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in arrays[a:b]]
                yield Tile(marks[1][a] != marks[2][a], keys, sizes, piece, sets)
        held = rows.slice(whole[-1]).to_batches() if batch is not None else []


def _common_shingles(texts: DataFrame) -> np.ndarray:
    """Shingles that several sets of a bounded sample have; only the order depends on them."""
    sample = hashed_sample(texts, MOST_SAMPLED).toArrow()["text"]
    hashes, sizes = shingle_sets(sample)
    _, first = np.unique(set_keys(hashes, sizes), return_index=True)
    kept = np.zeros(len(sizes), dtype=bool)
    kept[first] = True
    found, times = np.unique(hashes[np.repeat(kept, sizes)], return_counts=True)
    return found[times >= COMMON]


def _tiles(clusters: DataFrame, signatures: DataFrame) -> DataFrame:
    """Rows of every tile: cluster, left and right piece, and the documents' arrays.

    A cluster is cut by size into pieces of ``TILE`` shingles or one document. A piece meets
    itself and the later ones whose least size is within reach of its greatest.
    """
    sizes = clusters.join(signatures.select("key", "n"), "key")
    by_size = Window.partitionBy("cluster").orderBy("n", "key")
    sizes = sizes.withColumn("piece", F.floor((F.sum("n").over(by_size) - F.col("n")) / TILE))
    sizes = stored(sizes, "tile-rows")
    pieces = sizes.groupBy("cluster", "piece").agg(F.min("n").alias("least"), F.max("n").alias("most"))
    left = pieces.select("cluster", F.col("piece").alias("left"), "most")
    right = pieces.select("cluster", F.col("piece").alias("right"), "least")
    tiles = left.join(right, "cluster").where(f"left <= right AND {LINKED} * least <= 100 * most")
    tiles = tiles.select(
        "cluster", "left", "right", F.explode(F.array_distinct(F.array("left", "right"))).alias("piece")
    )
    placed = sizes.join(tiles, ["cluster", "piece"]).join(signatures.select("key", "shingles"), "key")
    return placed.repartition("cluster", "left", "right").sortWithinPartitions(*TILE_COLUMNS[:5]).select(*TILE_COLUMNS)


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for tile in _tiles_in(batches):
        if found := tile.links():
            a, b = np.array(found, dtype=np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def _shared(postings: DataFrame) -> DataFrame:
    """The rows whose shingle several keys have, each once, with the least of these keys."""
    keys = postings.select("shingle", "key")
    ends = keys.groupBy("shingle").agg(F.min("key").alias("pivot"), F.max("key").alias("last"))
    return keys.join(ends.where("pivot <> last").select("shingle", "pivot"), "shingle").distinct()


def _rarest(shared: DataFrame, sized: DataFrame) -> DataFrame:
    """``shared`` without the shingles of each key that most keys have, one fewer of them than
    the key has in common with any that it can be linked with: the rarest in common stays."""
    common = shared.groupBy("shingle").agg(F.count("*").alias("keys"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("keys"), F.desc("shingle")))
    ranked = shared.join(common, "shingle").withColumn("place", place).join(sized, "key")
    return _shared(ranked.where(f"place > {IN_COMMON} - 1"))


def near_duplicate_links(texts: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between keys of different sets, enough of them to join every component.

    ``texts`` has the columns row and text, ``sets`` row, n, key and first: first shingles, of one
    row of each set at least.
    """
    postings = sets.where("n > 0 AND length(first) > 0").select("key", "first")
    postings = postings.mapInArrow(over_batches(_postings), "shingle bigint, key bigint")
    twice = postings.groupBy("shingle").agg(F.count("*").alias("times")).where("times > 1")
    # Read back with a test, so that Spark makes a Bloom filter of it and only shuffles the
    # postings that pass.
    twice = stored(twice, "shingles-met-twice").where("times > 1").select("shingle")
    shared = stored(_shared(stored(postings.join(twice, "shingle").distinct(), "postings")), "shared-shingles")
    sized = stored(sets.where("n > 0").groupBy("key").agg(F.min("n").alias("n"), F.min("row").alias("row")), "set-sizes")
    for _ in range(PEELED):
        active = shared.groupBy("key").agg(F.count("*").alias("times")).join(sized, "key").where(f"times >= {IN_COMMON}")
        shared = stored(_shared(shared.join(active.select("key"), "key", "left_semi")), "shared-shingles")
    rarest = _rarest(shared, sized).where("key <> pivot").select(F.col("pivot").alias("a"), F.col("key").alias("b"))
    clusters = components(rarest).select(F.col("node").alias("key"), F.col("component").alias("cluster"))
    wanted = stored(clusters.select("key").join(sized, "key").select("row"), "wanted")
    # Read back with a test on its column, so that Spark filters the texts by a Bloom filter
    # of these rows before it shuffles them.
    needed = texts.join(wanted.where(F.col("row") >= F.lit(-(1 << 63))), "row", "left_semi").select("text")
    signatures = needed.mapInArrow(over_batches(_signed), "key bigint, n bigint, shingles binary")
    signatures = stored(signatures.dropDuplicates(["key"]), "signatures")
    return stored(_tiles(clusters, signatures).mapInArrow(_linked, "a bigint, b bigint"), "all-links")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), _row().alias("row"), "text")


def _row() -> Column:
    """What tells rows apart; rows with equal id and text have the same."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), F.col("text"))


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, row, n, key and component of every row; the component of an empty set is its key."""
    spark = docs.sparkSession
    for setting, value in BLOOM_FILTERS.items():
        spark.conf.set(f"spark.sql.optimizer.runtime.bloomFilter.{setting}", value)
    texts = _texts(docs)
    sent = spark.sparkContext.broadcast(_common_shingles(texts.select("text")))

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _measured(batch, sent.value)

    # With first shingles, so that texts are cut into shingles once for both uses of these.
    sets = texts.mapInArrow(over_batches(measure), "doc_id bigint, row bigint, n bigint, key bigint, first binary")
    sets = stored(sets, "shingle-sets")
    links = near_duplicate_links(texts.select("row", "text"), sets)
    found = components(links).withColumnRenamed("node", "key")
    return sets.drop("first").join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    A NULL or empty text, or one of white space, has no shingle and is linked with nothing;
    a text of fewer than five words has one, all of it. Rows with equal sets are linked. A
    NULL doc_id is carried along and names no component; the component's id then is the least
    of the others, or NULL where there is none. Of ``docs`` only doc_id and text are read.
    """
    grouped = _grouped(docs)
    least = grouped.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
    return grouped.join(least, "component", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with one left of each group of near copies: that with the least
    id, a NULL id coming last. Rows without shingles all stay.

    Rows that go are found by their hash. A Bloom filter of fixed size lets the others pass
    without a shuffle; those it cannot tell are joined.
    """
    grouped = _grouped(docs).where("n > 0").select(
        "component", "row", F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row").alias("order")
    )
    first = grouped.groupBy("component").agg(F.min("order").alias("first"))
    judged = grouped.join(first, "component").groupBy("row").agg(
        F.count("*").alias("times"), F.max(F.col("order") == F.col("first")).alias("stays")
    )
    judged = stored(judged.where("times > 1 OR NOT stays").select("row", "stays"), "rows-to-judge")
    sieve = build_filter(judged.select(F.col("row").alias("key"), F.lit(1).alias("n")), SIEVE_BYTES)
    sent = docs.sparkSession.sparkContext.broadcast(sieve)

    @F.arrow_udf("boolean")
    def in_question(rows: pa.Array) -> pa.Array:
        return pa.array(sent.value.counts(rows.to_numpy(zero_copy_only=False).view(np.uint64)) > 0)

    row, stays, place = (free_name(docs, name) for name in ("row", "stays", "place"))
    named = docs.withColumn(row, _row())
    clear = named.where(~in_question(F.col(row))).drop(row)
    unsure = named.where(in_question(F.col(row)))
    unsure = unsure.join(judged.toDF(row, stays), row, "left").where(F.coalesce(stays, F.lit(True)))
    copy = Window.partitionBy(row).orderBy(row)
    unsure = unsure.withColumn(place, F.row_number().over(copy)).where(F.isnull(stays) | (F.col(place) == 1))
    return clear.unionByName(unsure.select(*docs.columns))
