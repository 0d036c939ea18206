"""Token counts by merging many words at once.

The words of a batch lie in one ragged array of symbols. In each round every word's
lowest-ranked pair is found and merged wherever it occurs in that word, all words in step;
words with nothing left to merge are set aside. What is counted is the surviving symbols.

A round looks at all symbols of the words that are left, and a word has as many rounds as ranks
that it merges: fine for words, not for one of a million letters. Words from ``LONG_WORD`` bytes
on keep the places of each rank instead, so that a round touches the places it merges and their
neighbours; merges, and counts, are the same.
"""

from __future__ import annotations

import heapq
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from farebox.llm.word_vocab import WordVocabulary, chunks, vocabulary

KEPT_CHUNKS = 500_000
LONGEST_KEPT = 48
NO_MERGE = np.int64(1 << 40)
LONG_WORD = 2000


def _every_second(picked: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Of places in order, in each run of which every place follows on the one before, the first,
    third and so on: in a run like aaa the pairs overlap."""
    at = np.arange(len(picked))
    run_start = np.maximum.accumulate(np.where(follows, 0, at))
    return picked[(at - run_start) % 2 == 0]


class MergeCounter:
    """Counts tokens with one vocabulary; remembers the counts of chunks."""

    def __init__(self, vocab: WordVocabulary):
        self.vocab = vocab
        keys = (vocab.merges[:, 0] << 20) | vocab.merges[:, 1]
        order = np.argsort(keys)
        self._keys = keys[order]
        self._ranks = order.astype(np.int64)
        self._made = vocab.merges[:, 2]
        self._kept: dict[str, int] = {}

    def _pair_ranks(self, symbols: np.ndarray) -> np.ndarray:
        """The rank of each neighbouring pair, and no merge for the last symbol."""
        ranks = np.full(len(symbols), NO_MERGE)
        ranks[:-1] = self._ranks_of(symbols[:-1], symbols[1:])
        return ranks

    def _ranks_of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The rank of each pair; a second symbol of -1, the end, merges with nothing."""
        keys = (first << 20) | second
        place = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[place] == keys, self._ranks[place], NO_MERGE)

    def count_long(self, word: bytes) -> int:
        """Tokens of one word, whose symbols are a chain: merging takes places out of it."""
        data = np.frombuffer(word, dtype=np.uint8)
        n = len(data)
        symbols = np.append(self.vocab.inner[data], -1)
        symbols[n - 1] = self.vocab.final[data[-1]]
        ranks = np.append(self._pair_ranks(symbols[:n]), NO_MERGE)
        onward, back = np.arange(1, n + 2), np.arange(-1, n)
        places: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def found(at: np.ndarray) -> None:
            """Note the places whose pair can be merged, by rank."""
            at = at[ranks[at] != NO_MERGE]
            at = at[np.argsort(ranks[at], kind="stable")]
            kinds, first = np.unique(ranks[at], return_index=True)
            for rank, held in zip(kinds.tolist(), np.split(at, first[1:]), strict=False):
                if rank not in places:
                    places[rank] = []
                    heapq.heappush(waiting, rank)
                places[rank].append(held)

        found(np.arange(n))
        left = n
        while waiting:
            rank = heapq.heappop(waiting)
            held = np.unique(np.concatenate(places.pop(rank)))
            held = held[ranks[held] == rank]
            if not len(held):
                continue
            follows = np.append(False, onward[held[:-1]] == held[1:])
            picked = _every_second(held, follows)
            gone = onward[picked]
            symbols[picked] = self._made[rank]
            onward[picked] = onward[gone]
            back[onward[gone]] = picked
            ranks[gone] = NO_MERGE
            left -= len(gone)
            before = back[picked]
            touched = np.unique(np.concatenate((picked, before[before >= 0])))
            ranks[touched] = self._ranks_of(symbols[touched], symbols[onward[touched]])
            found(touched)
        return left

    def count_words(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word."""
        counts = np.zeros(len(words), dtype=np.int64)
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        for place in np.flatnonzero(lengths >= LONG_WORD):
            counts[place] = self.count_long(words[place])
        short = lengths < LONG_WORD
        left = np.flatnonzero((lengths > 0) & short)
        sizes = lengths[left]
        data = np.frombuffer(b"".join(w for w, kept in zip(words, short, strict=True) if kept), dtype=np.uint8)
        symbols = self.vocab.inner[data]
        last = np.cumsum(sizes) - 1
        symbols[last] = self.vocab.final[data[last]]
        while len(left):
            firsts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            ranks = self._pair_ranks(symbols)
            ranks[firsts + sizes - 1] = NO_MERGE
            lowest = np.minimum.reduceat(ranks, firsts)
            done = lowest == NO_MERGE
            counts[left[done]] = sizes[done]
            of_word = np.repeat(np.arange(len(sizes)), sizes)
            picked = np.flatnonzero((ranks == lowest[of_word]) & ~done[of_word])
            picked = _every_second(picked, np.append(False, np.diff(picked) == 1)[: len(picked)])
            symbols[picked] = self._made[ranks[picked]]
            stay = ~done[of_word]
            stay[picked + 1] = False
            sizes = sizes - np.bincount(of_word[picked], minlength=len(sizes))
            symbols, sizes, left = symbols[stay], sizes[~done], left[~done]
        return counts

    def count_texts(self, texts: list[str]) -> list[int]:
        kept = self._kept
        parts = [chunks(text) for text in texts]
        new = list(set().union(*parts) - kept.keys())
        if new:
            words, owner, special = [], [], np.zeros(len(new), dtype=np.int64)
            for place, chunk in enumerate(new):
                for word in self.vocab.words(chunk):
                    if isinstance(word, int):
                        special[place] += 1
                    else:
                        words.append(word)
                        owner.append(place)
            counted = special
            if words:
                found = self.count_words(words)
                counted = special + np.bincount(owner, found, minlength=len(new)).astype(np.int64)
            kept.update(zip(new, counted.tolist(), strict=True))
        totals = [sum(map(kept.__getitem__, part)) for part in parts]
        if len(kept) > KEPT_CHUNKS:
            kept.clear()
        for chunk in new:
            if len(chunk) > LONGEST_KEPT:
                kept.pop(chunk, None)
        return totals


@cache
def counter(path: str) -> MergeCounter:
    return MergeCounter(vocabulary(path))


def token_count(text: str, path: str) -> Column:
    """Tokens of the whole text in column ``text``, special strings as the library's default
    takes them; NULL or empty: 0."""

    @F.arrow_udf("bigint")
    def counted(texts: pa.Array) -> pa.Array:
        return pa.array(counter(path).count_texts([t or "" for t in texts.to_pylist()]), pa.int64())

    return counted(F.col(text))
