"""Language-model scores from a log-frequency Bloom filter.

Words and word pairs of the training documents are counted over the whole corpus. Counts
are quantised to steps of a square root of two and stored in one Bloom filter: an n-gram of
step q is entered with 1, 2, ... q, so that probing until the first miss gives its count
back. The filter has the same number of bits for every entry, whatever the corpus, and is
kept as rows, one for each segment of keys. No task and no broadcast ever holds more than a
segment: a chunk of documents asks each segment for its distinct n-grams in one row, and the
steps come back to the chunk. Texts are cut into words once, for the chunks; these are counted,
and then ask in a few rounds, so that only a share of all questions is on disk at a time.

A pair's probability is (count(u, w) + weight * p(w)) / (count(u) + weight), where p(w) is
the add-one estimate; the weight is the one that explains all training documents best when
each document's own occurrences are taken away.

The base score uses exact word counts: those of the most frequent words are looked up in a
table of bounded size, all others are joined.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import mixed, row_starts, stored, words_hashed

SEGMENTS = 256  # of a filter, at least
SEGMENT_TOKENS = 2_000_000  # of the training documents for each segment, at most
BITS = 24  # of the filter for each entry
KEY_BYTES = 5  # of a key that tell it apart within its segment
HEAD_WORDS = 1 << 18  # most frequent words, whose exact counts are broadcast
HELD_KEYS = 2_000_000  # n-grams a task holds before it counts and hands them on
ROUNDS = 4  # in which chunks ask, one after another
FILE_CHUNKS = 32  # in a file of chunks, at most; a round reads whole files
TEXTS_READ = 256  # at a time
CHUNKS_READ = 2  # at a time: a chunk has more than a megabyte
STEPS = 2  # quantisation steps per doubling
PROBES = 2  # bits per entry
AT_ONCE = 8  # probabilities multiplied before their logarithm is taken
WEIGHTS = (1.0, 10.0, 100.0, 1e3, 1e4, 1e5, 1e6)

START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)
_LEVEL = np.uint64(0x9E3779B97F4A7C15)
_PROBE = np.uint64(0xD1B54A32D192ED03)


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed tokens with an end for each row, and how many each row has."""
    words, counts = words_hashed(texts)
    return np.insert(words, np.cumsum(counts), END), counts + 1


def pair_keys(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(before * _PAIR + tokens)


def summed_by_key(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of each one's counts."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    starts = np.flatnonzero(first)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(starts) else counts


def distinct_keys(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order, by sorting: of mostly different ones, numpy's own way by a hash
    table takes ten times as long."""
    keys = np.sort(keys)
    first = np.ones(len(keys), dtype=bool)
    first[1:] = keys[1:] != keys[:-1]
    return keys[first]


@dataclass
class LogFrequencyFilter:
    """Quantised counts of n-grams by key, in segments by the key's first bits."""

    bits: np.ndarray  # bytes of all segments
    least: int  # count of the first step
    segments: int = SEGMENTS

    def _bit(self, keys: np.ndarray, level: int, probe: int) -> np.ndarray:
        size = len(self.bits) * 8 // self.segments
        return _positions(keys, level, probe, size) + _segment(keys, self.segments) * size

    def steps(self, keys: np.ndarray) -> np.ndarray:
        """Each key's last step; 0 for one not entered."""
        steps = np.zeros(len(keys), dtype=np.int64)
        left = np.arange(len(keys))
        level = 1
        while len(left):
            for probe in range(PROBES):
                bit = self._bit(keys[left], level, probe)
                left = left[(self.bits[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1]
            steps[left] = level
            level += 1
        return steps

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """The count that each key's last step stands for; 0 for one not entered."""
        return self.least * stands_for(self.steps(keys))


def _segment(keys: np.ndarray, segments: int) -> np.ndarray:
    if segments == 1:
        return np.zeros(len(keys), dtype=np.int64)
    return (keys >> np.uint64(64 - int(math.log2(segments)))).astype(np.int64)


def _positions(keys: np.ndarray, level: int, probe: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        turned = mixed(keys + np.uint64(level) * _LEVEL + np.uint64(probe) * _PROBE)
    return (turned % np.uint64(size)).astype(np.int64)


def step_of(ratio: np.ndarray) -> np.ndarray:
    """The step of a count, given over the least count."""
    return 1 + np.floor(STEPS * np.log2(ratio) + 1e-9).astype(np.int64)


def middle(steps: np.ndarray) -> np.ndarray:
    """What a step stands for: exactly 1 for the first, else the middle of its range."""
    low, high = 2.0 ** ((steps - 1) / STEPS), 2.0 ** (steps / STEPS)
    return np.where(steps == 1, 1.0, (low + high) / 2)


def stands_for(steps: np.ndarray) -> np.ndarray:
    """The count of each step, over the least; 0 for no step."""
    return np.where(steps > 0, middle(np.maximum(steps, 1)), 0.0)


def _set_bits(keys: np.ndarray, steps: np.ndarray, size: int) -> bytes:
    """A segment of ``size`` bits with the entries of each key."""
    bits = np.zeros(size, dtype=np.uint8)
    for level in range(1, int(steps.max()) + 1):
        keys, steps = keys[steps >= level], steps[steps >= level]
        for probe in range(PROBES):
            bits[_positions(keys, level, probe, size)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def build_filter(ngrams: DataFrame, size: int) -> LogFrequencyFilter:
    """A filter of ``size`` bytes at the driver with all (key, n) rows; every segment is filled
    by the task that has its keys."""
    size_of_segment = size * 8 // SEGMENTS

    def fill(key: tuple, group: pa.Table) -> pa.Table:
        steps = step_of(group["n"].to_numpy())
        made = _set_bits(group["key"].to_numpy().view(np.uint64), steps, size_of_segment)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([made], pa.binary())})

    shift = 64 - int(math.log2(SEGMENTS))
    entered = ngrams.withColumn("segment", F.shiftrightunsigned("key", shift))
    filled = entered.groupBy("segment").applyInArrow(fill, "segment bigint, bits binary").collect()
    bits = np.zeros((SEGMENTS, size_of_segment // 8), dtype=np.uint8)
    for row in filled:
        bits[row.segment] = np.frombuffer(row.bits, dtype=np.uint8)
    return LogFrequencyFilter(bits.ravel(), 1)


# --- the filter as rows: keys are packed, without what their segment says ---


def packed(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def unpacked(held: bytes | pa.Buffer) -> np.ndarray:
    short = np.frombuffer(held, np.uint8).reshape(-1, KEY_BYTES)
    keys = np.zeros((len(short), 8), dtype=np.uint8)
    keys[:, :KEY_BYTES] = short
    return keys.view(np.uint64).ravel()


def packed_counts(counts: np.ndarray) -> bytes:
    """A byte for each count; one too large for it is a zero there, and follows behind all."""
    large = counts > 255
    return np.where(large, 0, counts).astype(np.uint8).tobytes() + counts[large].astype(np.uint32).tobytes()


def unpacked_counts(held: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(held, np.uint8, n).astype(np.int64)
    counts[counts == 0] = np.frombuffer(held, np.uint8)[n:].view(np.uint32)
    return counts


def segments_for(tokens: int, size: int) -> int:
    """How many segments keep to ``size`` tokens each: a power of two."""
    segments = SEGMENTS
    while tokens > segments * size:
        segments *= 2
    return segments


def filled_segment(keys: np.ndarray, counts: np.ndarray, bits: int = BITS) -> bytes:
    """The bits of a segment, ``bits`` for every entry, from its keys' counts in parts."""
    kinds, place = np.unique(keys, return_inverse=True)
    steps = step_of(np.bincount(place, counts))
    return _set_bits(kinds, steps, max(64, -(-bits * int(steps.sum()) // 8) * 8))


def _by_segment(keys: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The segments of sorted keys, and where each begins."""
    return np.unique(_segment(keys, segments), return_index=True)


@dataclass
class LanguageModel:
    segments: int  # of the filter
    total: int  # N: training tokens
    distinct: int  # V: distinct ones
    head_keys: np.ndarray  # most frequent words, sorted
    head_counts: np.ndarray

    def odds(self, words: np.ndarray, pairs: np.ndarray, context: np.ndarray, weight: float) -> np.ndarray:
        """The smoothed probability; 1 where nothing was learned."""
        alone = (words + 1) / (self.total + self.distinct + 1)
        # The filter can give a pair more than its context; the context then is what counts.
        return (pairs + weight * alone) / (np.maximum(context, pairs) + weight)

    def sums(self, counts: np.ndarray, words: np.ndarray, pairs: np.ndarray, context: np.ndarray) -> pa.Array:
        """The sum of log10 of each row's probabilities under each weight. Logarithms are of the
        products of a few, none of which is so small that they leave the range of a double."""
        groups = -(-counts // AT_ONCE)
        row, first = np.repeat(np.arange(len(counts)), groups), row_starts(groups)[:-1]
        starts = row_starts(counts)[row] + AT_ONCE * (np.arange(len(row)) - first[row])
        summed = []
        for weight in WEIGHTS:
            together = np.multiply.reduceat(self.odds(words, pairs, context, weight), starts)
            summed.append(np.bincount(row, np.log10(together), minlength=len(counts)))
        ends = np.arange(0, (len(counts) + 1) * len(WEIGHTS), len(WEIGHTS))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.stack(summed, axis=1).ravel()))

    def head(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact counts of tokens, and which are among the most frequent words."""
        if not len(self.head_keys):
            return np.zeros(len(tokens), np.int64), np.zeros(len(tokens), dtype=bool)
        at = np.minimum(np.searchsorted(self.head_keys, tokens), len(self.head_keys) - 1)
        known = self.head_keys[at] == tokens
        return np.where(known, self.head_counts[at], 0), known


def _times_in_row(row: np.ndarray, place: np.ndarray, kinds: int) -> np.ndarray:
    """How often what stands at each place, one of so many kinds, occurs in its row."""
    _, at, times = np.unique(row * kinds + place, return_inverse=True, return_counts=True)
    return times[at]


def _least_frequent(words: DataFrame, most: int) -> int:
    """The count from which on at most ``most`` words are, to within a sixteenth."""
    step = F.floor(16 * F.log2("n")).cast("int")
    steps = words.groupBy(step.alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("least")).collect()
    least, above = 1 << 62, 0
    for row in sorted(steps, key=lambda row: -row.step):
        above += row.words
        if above > most:
            break
        least = row.least
    return least


# A chunk of documents: its distinct words in order and, for each token, its place there.
CHUNKS = (
    "chunk bigint, kinds binary, place binary, doc_id array<bigint>, held_out array<boolean>, "
    "n_tokens array<bigint>"
)
LEARNED = ("kinds", "place", "held_out", "n_tokens")
SUMMED = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_head bigint, head_sum double, scores array<double>, "
    "left_out array<double>, rare map<bigint,bigint>"
)


def _place_type(kinds: int) -> type:
    return np.uint16 if kinds <= 1 << 16 else np.int32


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch of (doc_id, held_out, text) as a chunk."""
    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        words, counts = tokens_of(batch.column(2))
        if not len(words):
            continue
        kinds, place = np.unique(words, return_inverse=True)
        # Common words make places compress to a fraction; keys are as good as random.
        places = zstandard.compress(place.astype(_place_type(len(kinds))).tobytes())
        columns = [pa.array([chunk], pa.int64()), pa.array([kinds.tobytes()]), pa.array([places])]
        for values in (batch.column(0), batch.column(1), pa.array(counts, pa.int64())):
            columns.append(pa.array([values.to_pylist()], pa.list_(values.type)))
        yield pa.RecordBatch.from_arrays(columns, ["chunk", "kinds", "place", "doc_id", "held_out", "n_tokens"])
        chunk += 1


@dataclass
class Chunk:
    """The tokens of some documents, as places among their distinct words."""

    kinds: np.ndarray
    place: np.ndarray
    counts: np.ndarray  # tokens of each document

    @classmethod
    def of(cls, row: dict) -> Chunk:
        kinds = np.frombuffer(row["kinds"], np.uint64)
        place = np.frombuffer(zstandard.decompress(row["place"]), _place_type(len(kinds)))
        return cls(kinds, place, np.array(row["n_tokens"]))

    @property
    def starts(self) -> np.ndarray:
        return row_starts(self.counts)[:-1]

    def pairs(self) -> np.ndarray:
        """The key of each token with what stands before it."""
        tokens = self.kinds[self.place]
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[self.starts] = START
        return pair_keys(before, tokens)

    def asks(self, pairs: np.ndarray) -> np.ndarray:
        """What it asks for, given its distinct pairs: its words, the start and these."""
        return np.concatenate([self.kinds, [START], pairs])


def _learned(rows: pa.RecordBatch) -> Iterator[tuple[Chunk, np.ndarray]]:
    """Chunks, and which of their tokens are to be learned from."""
    for row in rows.to_pylist():
        chunk = Chunk.of(row)
        yield chunk, np.repeat([held_out is False for held_out in row["held_out"]], chunk.counts)


Counts = tuple[np.ndarray, np.ndarray]  # of keys


def _words_of(chunk: Chunk, learned: np.ndarray) -> Counts:
    times = np.bincount(chunk.place[learned], minlength=len(chunk.kinds))
    return chunk.kinds[times > 0], times[times > 0]


def _pairs_of(chunk: Chunk, learned: np.ndarray) -> Counts:
    return np.unique(chunk.pairs()[learned], return_counts=True)


def _counted(
    batches: Iterator[pa.RecordBatch], kinds: tuple[Callable[[Chunk, np.ndarray], Counts], ...]
) -> Iterator[Counts]:
    """What chunks have to learn from, counted in what a task holds."""
    held: list[Counts] = []
    for batch in batches:
        for chunk, learned in _learned(batch):
            held += [kind(chunk, learned) for kind in kinds]
            if sum(len(keys) for keys, _ in held) >= HELD_KEYS:
                yield summed_by_key(*map(np.concatenate, zip(*held, strict=True)))
                held.clear()
    if sum(len(keys) for keys, _ in held):
        yield summed_by_key(*map(np.concatenate, zip(*held, strict=True)))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, counts in _counted(batches, (_words_of,)):
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "n"])


def word_counts(chunks: DataFrame) -> DataFrame:
    """(key, n) of every word; tasks count what they hold before the shuffle. They have no table
    of all their words besides, as a grouping would make before its shuffle."""
    counted = chunks.select(*LEARNED).mapInArrow(_word_counts, "key bigint, n bigint")
    return counted.repartition("key").groupBy("key").agg(F.sum("n").alias("n"))


def _parts(batches: Iterator[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    """Words and pairs with their counts in what a task holds, a row for each segment."""
    for keys, counts in _counted(batches, (_words_of, _pairs_of)):
        found, starts = _by_segment(keys, segments)
        columns = [
            pa.array(found),
            pa.array([packed(part) for part in np.split(keys, starts[1:])], pa.binary()),
            pa.array([packed_counts(part) for part in np.split(counts, starts[1:])], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["segment", "keys", "counts"])


def filter_rows(chunks: DataFrame, segments: int, bits: int = BITS) -> DataFrame:
    """(segment, bits) of all words and pairs; every segment is counted, sized and filled by
    the task that has its parts."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _parts(batches, segments)

    def fill(key: tuple, group: pa.Table) -> pa.Table:
        held, counted = group["keys"].to_pylist(), group["counts"].to_pylist()
        keys = unpacked(b"".join(held))
        sizes = (len(part) // KEY_BYTES for part in held)
        counts = np.concatenate([unpacked_counts(part, n) for part, n in zip(counted, sizes, strict=True)])
        made = filled_segment(keys, counts, bits)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([made], pa.binary())})

    parts = chunks.select(*LEARNED).mapInArrow(part, "segment bigint, keys binary, counts binary")
    return parts.groupBy("segment").applyInArrow(fill, "segment bigint, bits binary")


def train(chunks: DataFrame, size: int = SEGMENT_TOKENS, head: int = HEAD_WORDS) -> tuple[LanguageModel, DataFrame]:
    """The model of the rows that are not held out, and the exact count of every word as (key, n)."""
    words = stored(word_counts(chunks), "word-counts", drop_shuffles=True, batch_rows=CHUNKS_READ)
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).head()
    frequent = words.where(F.col("n") >= _least_frequent(words, head)).toArrow()
    keys = frequent["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    segments = segments_for(int(total), size)
    return LanguageModel(segments, int(total), int(distinct), keys[order], frequent["n"].to_numpy()[order]), words


def _asked(batches: Iterator[pa.RecordBatch], segments: int) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of each chunk in order, a row for each segment."""
    for batch in batches:
        for row in batch.to_pylist():
            chunk = Chunk.of(row)
            keys = np.sort(chunk.asks(distinct_keys(chunk.pairs())))
            found, starts = _by_segment(keys, segments)
            columns = [
                pa.array(found),
                pa.array(np.full(len(found), row["chunk"])),
                pa.array([packed(part) for part in np.split(keys, starts[1:])], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["segment", "chunk", "data"])


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Steps for the keys of rows (segment, chunk, data), sorted by these: a segment's bits
    come first, as chunk -1. A segment without bits has none of its keys. All that a batch asks of
    a segment is looked up at once."""
    have, held = -1, None
    for batch in batches:
        segments, chunks = (batch.column(c).to_numpy() for c in range(2))
        data = batch.column(2)
        cuts = np.flatnonzero(segments[1:] != segments[:-1]) + 1
        for a, b in itertools.pairwise([0, *cuts.tolist(), len(segments)]):
            if a < b and segments[a] != have:
                have, held = segments[a], None
            if a < b and chunks[a] < 0:
                held = LogFrequencyFilter(np.frombuffer(data[a].as_py(), np.uint8), 1, segments=1)
                a += 1
            if a == b:
                continue
            asked = data.slice(a, b - a).to_pylist()
            keys = unpacked(b"".join(asked))
            steps = held.steps(keys) if held else np.zeros(len(keys))
            parts = np.split(steps.astype(np.uint8), np.cumsum([len(part) // KEY_BYTES for part in asked])[:-1])
            columns = [
                pa.array(segments[a:b]),
                pa.array(chunks[a:b]),
                pa.array([part.tobytes() for part in parts], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["segment", "chunk", "data"])


def _scored(rows: pa.Table, model: LanguageModel) -> pa.Table:
    """The sums of a chunk's rows, from its own row and the answers of all segments."""
    rows = rows.sort_by("segment").combine_chunks()
    own = rows.slice(0, 1).to_pylist()[0]
    chunk = Chunk.of(own)
    place, counts, starts, kinds = chunk.place, chunk.counts, chunk.starts, len(chunk.kinds)
    keys = chunk.pairs()
    distinct, pair = np.unique(keys, return_inverse=True)
    steps = np.empty(kinds + 1 + len(distinct), np.uint8)
    steps[np.argsort(chunk.asks(distinct))] = np.frombuffer(b"".join(rows["data"].slice(1).to_pylist()), np.uint8)
    found = stands_for(steps.astype(np.int64))
    words, start, pairs = found[:kinds][place], found[kinds], found[kinds + 1 :][pair]

    def shifted(values: np.ndarray, first: float) -> np.ndarray:
        context = np.empty_like(values)
        context[1:] = values[:-1]
        context[starts] = first
        return context

    row = np.repeat(np.arange(len(counts)), counts)
    # Without the row's own occurrences; whatever stands before a token stands there as often
    # as it is in the row.
    other_words = np.maximum(words - _times_in_row(row, place, kinds), 0)
    other_pairs = np.maximum(pairs - _times_in_row(row, pair, len(distinct)), 0)
    exact, frequent = (known[place] for known in model.head(chunk.kinds))
    rare, times = np.unique((row * kinds + place)[~frequent], return_counts=True)
    rare_counts = np.bincount(rare // kinds, minlength=len(counts))
    return pa.Table.from_arrays(
        [
            pa.array(own["doc_id"], pa.int64()),
            pa.array(own["held_out"], pa.bool_()),
            pa.array(counts, pa.int64()),
            pa.array(np.bincount(row, frequent, minlength=len(counts)).astype(np.int64)),
            pa.array(np.bincount(row, np.log10(exact + 1.0), minlength=len(counts))),
            model.sums(counts, words, pairs, shifted(words, start)),
            model.sums(counts, other_words, other_pairs, shifted(other_words, max(start - 1, 0))),
            pa.MapArray.from_arrays(
                pa.array(row_starts(rare_counts), pa.int32()),
                pa.array(chunk.kinds[rare % kinds].view(np.int64)),
                pa.array(times),
            ),
        ],
        ["doc_id", "held_out", "n_tokens", "n_head", "head_sum", "scores", "left_out", "rare"],
    )


def lm_scores(
    docs: DataFrame, held_out: Column, size: int = SEGMENT_TOKENS, head: int = HEAD_WORDS, bits: int = BITS
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row,
    learned from the rows that are not held out.

    A NULL or empty text is its end alone. A NULL doc_id is carried along, and repeated
    rows each get their scores. With nothing to learn from both scores are 0. No segment of
    the filter has the n-grams of more than about ``size`` tokens.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out.alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    spark = docs.sparkSession
    chunks = stored(rows.mapInArrow(_chunks, CHUNKS), "chunks", file_rows=FILE_CHUNKS, batch_rows=TEXTS_READ)
    model, words = train(chunks, size, head)
    sent = spark.sparkContext.broadcast(model)
    segments = model.segments

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _asked(batches, segments)

    def score(chunk: pa.Table) -> pa.Table:
        return _scored(chunk, sent.value)

    no_chunk = F.lit(-1).cast("bigint").alias("chunk")
    # Written before anything is asked, so that the shuffle it is counted by is gone by then.
    entered = filter_rows(chunks, segments, bits)
    filled = stored(entered, "filter", drop_shuffles=True, file_rows=FILE_CHUNKS, batch_rows=CHUNKS_READ)
    filled = filled.select("segment", no_chunk, F.col("bits").alias("data"))

    files = sorted(map(unquote, chunks.inputFiles()))
    rounds = min(ROUNDS, len(files))

    def summed_in(turn: int) -> DataFrame:
        own = spark.read.schema(CHUNKS).parquet(*files[turn::rounds])
        asked = own.select("chunk", "kinds", "place", "n_tokens").mapInArrow(
            ask, "segment bigint, chunk bigint, data binary"
        )
        by_segment = filled.unionByName(asked).repartition("segment").sortWithinPartitions("segment", "chunk")
        answers = by_segment.mapInArrow(_answered, "segment bigint, chunk bigint, data binary")
        own = own.withColumn("segment", F.lit(-1).cast("bigint"))
        together = own.unionByName(answers, allowMissingColumns=True)
        scored = together.groupBy("chunk").applyInArrow(score, SUMMED)
        row = (F.monotonically_increasing_id() * rounds + turn).alias("row")
        return stored(scored.select("*", row), "row-sums", drop_shuffles=True, batch_rows=CHUNKS_READ)

    summed = reduce(DataFrame.unionByName, map(summed_in, range(rounds)))
    gains = summed.where(~F.col("held_out")).agg(*[F.sum(F.col("left_out")[k]) for k in range(len(WEIGHTS))]).head()
    best = int(np.argmax([gain or 0.0 for gain in gains]))
    rare = summed.select("row", F.explode("rare").alias("key", "times"))
    # Words are distinct, so none of a shuffle's tasks has many: tables of them take a fraction of
    # what it takes to sort both sides, most of which are occurrences.
    found = rare.join(words.hint("shuffle_hash"), "key").groupBy("row").agg(
        F.sum("times").alias("n_rare"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_sum")
    )
    per_token = math.log10(model.total + model.distinct + 1)
    return summed.join(found, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_head") + F.coalesce("n_rare", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("head_sum") + F.coalesce("rare_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(per_token)).alias(
            "base_score"
        ),
        F.col("scores")[best].alias("score"),
    )
