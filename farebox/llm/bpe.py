"""BPE by dynamic programming over prefixes.

A BPE encoding is the one sequence of tokens whose neighbours are all compatible: encoding
the two joined gives the same two back. So each prefix of a word has exactly one possible
last token. An automaton over the vocabulary names every token that ends at a position,
longest first; the one that is compatible with the last token of the prefix before it is
stored, and back-pointers from the word's end give the ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.llm.word_vocab import WordVocabulary, chunks, vocabulary

KEPT_CHUNKS = 100_000  # chunks whose ids a worker remembers before it starts anew
KEPT_WORDS = 300_000
KEPT_PAIRS = 200_000
LONGEST_KEPT = 48
END = "Ā"  # stands for the word's end after bytes read as Latin-1


class PrefixEncoder:
    """Encodes words with one vocabulary; remembers chunks and compatible pairs."""

    def __init__(self, vocab: WordVocabulary):
        self.vocab = vocab
        self._rank = {(a << 20) | b: rank for rank, (a, b, _) in enumerate(vocab.merges.tolist())}
        self._parts = {token: (a, b, rank) for rank, (a, b, token) in enumerate(vocab.merges.tolist())}
        spelled = {int(t): bytes([b]).decode("latin-1") for b, t in enumerate(vocab.inner)}
        spelled |= {int(t): bytes([b]).decode("latin-1") + END for b, t in enumerate(vocab.final)}
        canonical = set(spelled)
        for rank, (a, b, token) in enumerate(vocab.merges.tolist()):
            spelled[token] = spelled[a] + spelled[b]
            # The token is its own encoding if nothing joins across a|b before this merge.
            if a in canonical and b in canonical and not self._joins(a, b, rank):
                canonical.add(token)
        self._automaton = ahocorasick.Automaton()
        for token in canonical:
            self._automaton.add_word(spelled[token], (len(spelled[token]), token))
        self._automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._kept: dict[str, bytes] = {}
        self._words: dict[bytes, bytes] = {}

    def _edge(self, token: int, side: int, until: int) -> list[tuple[int, int]]:
        """The pieces that are at one edge of a token in turn, each with the rank at which it
        is used up; the token itself lasts ``until``."""
        pieces = [(token, until)]
        while token in self._parts:
            *halves, rank = self._parts[token]
            token = halves[side]
            pieces.append((token, rank))
        return pieces

    def _joins(self, before: int, token: int, until: int) -> bool:
        """Whether some merge takes a piece from each side while both are still there.

        Of merges of one rank the leftmost comes first: the left piece must be used up
        later than this merge, the right one not sooner.
        """
        rank_of = self._rank.get
        left = self._edge(token, 0, until)
        for x, x_used in self._edge(before, 1, until):
            for y, y_used in left:
                rank = rank_of((x << 20) | y)
                if rank is not None and rank < x_used and rank <= y_used:
                    return True
        return False

    def forget(self) -> None:
        """Let go of what was remembered, so that an idle worker holds little."""
        for kept in (self._pairs, self._kept, self._words):
            kept.clear()

    def _tested(self, before: int, token: int) -> bool:
        """Whether two tokens may stand side by side; the answer is remembered."""
        if len(self._pairs) >= KEPT_PAIRS:
            self._pairs.clear()
        fits = not self._joins(before, token, len(self._parts))
        self._pairs[(before << 20) | token] = fits
        return fits

    def encode_word(self, word: bytes) -> list[int]:
        spelled = word.decode("latin-1") + END
        last = [-1] * (len(spelled) + 1)
        start_of = [0] * (len(spelled) + 1)
        known = self._pairs.get
        for stop, (length, token) in self._automaton.iter(spelled):
            stop += 1
            if last[stop] >= 0:
                continue
            start = stop - length
            if start:
                before = last[start]
                fits = known((before << 20) | token)
                if fits is None:
                    fits = self._tested(before, token)
                if not fits:
                    continue
            last[stop], start_of[stop] = token, start
        ids, place = [], len(spelled)
        while place:
            ids.append(last[place])
            place = start_of[place]
        ids.reverse()
        return ids

    def _packed_word(self, word: bytes | int) -> bytes:
        if isinstance(word, int):
            return pack("<I", word)
        packed = self._words.get(word)
        if packed is None:
            ids = self.encode_word(word)
            packed = pack(f"<{len(ids)}I", *ids)
            if len(word) <= LONGEST_KEPT:
                if len(self._words) >= KEPT_WORDS:
                    self._words.clear()
                self._words[word] = packed
        return packed

    def encode_chunk(self, chunk: str) -> bytes:
        packed = b"".join(map(self._packed_word, self.vocab.words(chunk)))
        if len(chunk) <= LONGEST_KEPT:
            if len(self._kept) >= KEPT_CHUNKS:
                self._kept.clear()
            self._kept[chunk] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        kept, found = self._kept, []
        for chunk in chunks(text):
            packed = kept.get(chunk)
            found.append(self.encode_chunk(chunk) if packed is None else packed)
        return b"".join(found)


@cache
def encoder(path: str) -> PrefixEncoder:
    return PrefixEncoder(vocabulary(path))


@cache
def _token_strings(path: str) -> pa.Array:
    return pa.array(vocabulary(path).strings, pa.large_string())


def encode_texts(texts: pa.Array, path: str) -> list[bytes]:
    encode = encoder(path).encode
    return [encode(text or "") for text in texts.to_pylist()]


def decode_ids(ids: pa.Array, path: str) -> pa.Array:
    """Token strings joined by spaces, as the library does for a file with no decoder."""
    flat = pc.list_flatten(ids)
    tokens = _token_strings(path).take(flat)
    joined = pa.LargeListArray.from_arrays(ids.offsets.cast(pa.int64()), tokens)
    return pc.binary_join(joined, pa.scalar(" ", pa.large_string()))


def _as_lists(packed: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(p) // 4 for p in packed])))
    flat = np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))


def bpe_encode(text: str, path: str) -> Column:
    """Column of token ids for the whole text in column ``text``; NULL or empty: none."""

    @F.arrow_udf("array<int>")
    def encoded(texts: pa.Array) -> pa.Array:
        return _as_lists(encode_texts(texts, path))

    return encoded(F.col(text))


def bpe_decode(ids: str, path: str) -> Column:
    """Column of the text that ids in column ``ids`` stand for; NULL or none: empty."""

    @F.arrow_udf("string")
    def decoded(lists: pa.Array) -> pa.Array:
        empty = pa.scalar([], lists.type)
        return decode_ids(pa.concat_arrays([lists.fill_null(empty)]), path).cast(pa.string())

    return decoded(F.col(ids))


def bpe_codec(text: str, path: str) -> Column:
    """Struct of the ids of the whole text in column ``text`` and the text they decode to."""

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            ids = _as_lists(encode_texts(texts, path))
            yield pa.StructArray.from_arrays([ids, decode_ids(ids, path).cast(pa.string())], ["ids", "decoded"])
        encoder(path).forget()

    return coded(F.col(text))


def bpe_digests(text: str, path: str) -> Column:
    """Struct of the token count and digests of ids and decoded text.

    Ids are encoded and decoded in the task and only their digests leave it.
    """

    @F.arrow_udf("struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>")
    def digests(texts: pa.Array) -> pa.Array:
        packed = encode_texts(texts, path)
        decoded = decode_ids(_as_lists(packed), path).cast(pa.large_binary())
        return pa.StructArray.from_arrays(
            [
                pa.array([len(p) // 4 for p in packed], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed], pa.string()),
                pa.array([hashlib.sha256(d.as_buffer()).hexdigest() for d in decoded], pa.string()),
            ],
            ["n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return digests(F.col(text))
