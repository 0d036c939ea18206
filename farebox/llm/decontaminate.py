"""Benchmark decontamination by greedy string tiling.

Test items go to the documents in blocks of bounded size, as hashed words (letters and
digits, A-Z read as a-z) and the seeds they contain: runs of ``SEED`` words, or the whole
item where it is shorter. A document that shares a seed with an item is tiled against it:
the longest match of unmarked words is marked in both, again and again, down to the seed's
length. Matches are found by Karp-Rabin hashes of windows, whose length halves from pass to
pass. An item whose words are marked to ``COVERED`` or more has leaked, whatever the order
its passages come in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import mixed, row_starts, words_hashed

SEED = 5
COVERED = 0.6
BLOCK_BYTES = 4 << 20  # of item texts that are sent to the documents at once

_STEP = 0xA24BAED4963EE407
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    factors = np.full(n, base, dtype=np.uint64)
    factors[:1] = 1
    return np.cumprod(factors, dtype=np.uint64)


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of every run of ``length`` words, from sums over all before."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(words * _powers(_STEP, len(words)), out=sums[1:], dtype=np.uint64)
        return mixed((sums[length:] - sums[:-length]) * _powers(_STEP_INVERSE, n))


def _free(marked: np.ndarray, length: int) -> np.ndarray:
    """Where a run of ``length`` unmarked words begins."""
    sums = np.concatenate(([0], np.cumsum(marked)))
    return np.flatnonzero(sums[length:] == sums[:-length])


def _matches(a: np.ndarray, b: np.ndarray, marked: list[np.ndarray], length: int) -> list[tuple[int, int, int]]:
    """Maximal matches of at least ``length`` unmarked words, as (length, at in a, at in b)."""
    if min(len(a), len(b)) < length:
        return []
    at_a, at_b = _free(marked[0], length), _free(marked[1], length)
    hash_a, hash_b = window_hashes(a, length)[at_a], window_hashes(b, length)[at_b]
    order = np.argsort(hash_a, kind="stable")
    low = np.searchsorted(hash_a[order], hash_b, side="left")
    high = np.searchsorted(hash_a[order], hash_b, side="right")
    pairs = {(int(at_a[order[k]]), int(at_b[i])) for i in np.flatnonzero(high > low) for k in range(low[i], high[i])}
    found = []
    for i, j in sorted(pairs):
        if (i - 1, j - 1) in pairs:
            continue  # part of the match that begins there
        n = length
        while (i + n - length + 1, j + n - length + 1) in pairs:
            n += 1
        found.append((n, i, j))
    return found


def tiled(document: np.ndarray, item: np.ndarray, least: int) -> np.ndarray:
    """Which words of ``item`` are covered by tiles of at least ``least`` words."""
    marked = [np.zeros(len(document), dtype=bool), np.zeros(len(item), dtype=bool)]
    length = max(least, len(item))
    while True:
        while found := _matches(document, item, marked, length):
            longest = max(n for n, _, _ in found)
            for n, i, j in sorted(found, key=lambda m: (m[2], m[1])):
                if n == longest and not marked[0][i : i + n].any() and not marked[1][j : j + n].any():
                    marked[0][i : i + n] = marked[1][j : j + n] = True
        if length == least:
            return marked[1]
        length = max(least, length // 2)


@dataclass
class TestBlock:
    """Some test items: their words, and the seeds by length."""

    ids: list[int]
    words: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray]]  # length: sorted hashes, item of each

    @classmethod
    def of(cls, ids: list[int], texts: list[str]) -> TestBlock:
        hashes, counts = words_hashed(pa.array(texts, pa.string()), letters_only=True) if texts else (np.zeros(0, np.uint64), [])
        bounds = row_starts(np.asarray(counts, dtype=np.int64))
        words = [hashes[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]
        by_length: dict[int, list[tuple[int, int]]] = {}
        for place, own in enumerate(words):
            length = min(SEED, len(own))
            if length:
                by_length.setdefault(length, []).extend((int(h), place) for h in set(window_hashes(own, length).tolist()))
        seeds = {}
        for length, entries in by_length.items():
            entries.sort()
            seeds[length] = (
                np.array([h for h, _ in entries], dtype=np.uint64),
                np.array([place for _, place in entries], dtype=np.int64),
            )
        return cls(ids, words, seeds)

    def leaks(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int]]:
        """(row, item, its words, those covered) of every item that has leaked into a row."""
        hashes, counts = words_hashed(texts, letters_only=True)
        bounds = row_starts(counts)
        row_of = np.repeat(np.arange(len(counts)), counts)
        met: dict[tuple[int, int], list[np.ndarray]] = {}
        for length, (known, items) in self.seeds.items():
            grams = window_hashes(hashes, length)
            low = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            at = np.flatnonzero(known[low] == grams)
            at = at[row_of[at] == row_of[at + length - 1]]
            low, high = low[at], np.searchsorted(known, grams[at], side="right")
            places = np.repeat(at, high - low)
            offsets = np.arange(len(places)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
            shared = items[np.repeat(low, high - low) + offsets]
            order = np.lexsort((places, shared, row_of[places]))
            places, shared, rows = places[order], shared[order], row_of[places[order]]
            cuts = np.flatnonzero((np.diff(rows) != 0) | (np.diff(shared) != 0)) + 1
            for part in np.split(np.arange(len(places)), cuts) if len(places) else []:
                met.setdefault((int(rows[part[0]]), int(shared[part[0]])), []).append(places[part])
        for (row, item), found in sorted(met.items()):
            own = self.words[item]
            least = min(SEED, len(own))
            covered = int(tiled(_stretches(hashes, np.concatenate(found), least), own, least).sum())
            if covered >= COVERED * len(own):
                yield row, self.ids[item], len(own), covered


def _stretches(words: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The words within seeds; a word that nothing equals stands where some are left out.

    No match of a seed's length or more lies outside, so tiling needs no other words.
    """
    starts = np.unique(starts)
    covered = np.unique((starts[:, None] + np.arange(length)).ravel())
    gap = np.flatnonzero(np.diff(covered) > 1) + 1
    apart = mixed(np.arange(1, len(gap) + 1, dtype=np.uint64) ^ np.uint64(0x5DEECE66D5DEECE6))
    return np.insert(words[covered], gap, apart)


def test_blocks(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[TestBlock]:
    """The test items in blocks of about ``BLOCK_BYTES``; each is held by the driver in turn.

    Items with NULL id or text, or without words, cannot leak; of equal rows one is kept.
    """
    items = (
        benchmark.where(F.col(item_id).isNotNull() & F.col(text).isNotNull())
        .select(F.col(item_id).cast("bigint").alias("item_id"), F.col(text).alias("text"))
        .distinct()
    )
    size = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = math.ceil(size / BLOCK_BYTES)
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        chosen = sorted((row.item_id, row.text) for row in rows.collect())
        if chosen:
            yield TestBlock.of(*map(list, zip(*chosen, strict=True)))


FOUND = "doc_id bigint, item_id bigint, n_words bigint, n_covered bigint, coverage double"


def leaked_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each document and test item that has leaked into it, with the item's words, those
    covered, and their share.

    A NULL or empty text holds nothing; a NULL doc_id is carried along; equal rows of
    ``docs`` each give theirs. Without items or documents the result is empty.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")

    def against(block: TestBlock) -> DataFrame:
        sent = spark.sparkContext.broadcast(block)

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = list(sent.value.leaks(batch.column(1)))
                if found:
                    rows, items, words, covered = map(np.array, zip(*found, strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows)), *map(pa.array, (items, words, covered, covered / words))],
                        ["doc_id", "item_id", "n_words", "n_covered", "coverage"],
                    )

        return texts.mapInArrow(search, FOUND)

    return reduce(DataFrame.unionByName, map(against, test_blocks(benchmark)), spark.createDataFrame([], FOUND))


def has_leak(text: str, benchmark: DataFrame) -> Column:
    """Whether any test item has leaked into the text in column ``text``."""

    def against(block: TestBlock) -> Column:
        sent = benchmark.sparkSession.sparkContext.broadcast(block)

        @F.arrow_udf("boolean")
        def leaky(texts: pa.Array) -> pa.Array:
            found = np.zeros(len(texts), dtype=bool)
            found[[row for row, *_ in sent.value.leaks(texts)]] = True
            return pa.array(found)

        return leaky(F.col(text))

    return reduce(or_, map(against, test_blocks(benchmark)), F.lit(False))
