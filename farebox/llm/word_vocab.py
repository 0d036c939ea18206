"""A word-end BPE vocabulary file: its symbols, merges, and how it parts a text into words.

Texts are cut at white space first. Nothing in the file's normaliser or pattern reaches
across white space, so a chunk can be worked out once and looked up afterwards.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import cache

import numpy as np
import regex

# Fixed value: Unicode's White_Space characters, which the file's pattern calls \s.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[^{WHITE_SPACE}]+")
# str.split() also parts at these four.
_SPLIT_DIFFERS = re.compile("[\x1c-\x1f]")


@cache
def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class WordVocabulary:
    """Token ids, merges in rank order, and the words of a text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        model = described["model"]
        ids: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        characters = byte_characters()
        self.suffix = suffix
        self.ids = ids
        self.inner = np.array([ids[c] for c in characters], dtype=np.int64)
        self.final = np.array([ids[c + suffix] for c in characters], dtype=np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        #: left id, right id and merged id of each merge, by rank
        self.merges = np.array([(ids[a], ids[b], ids[a + b]) for a, b in pairs], dtype=np.int64)
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.strings = [""] * (max([*ids.values(), *self.special.values()]) + 1)
        for token, place in [*ids.items(), *self.special.items()]:
            self.strings[place] = token
        split = described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._words = regex.compile(split)
        self._special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")

    def words(self, chunk: str) -> list[bytes | int]:
        """A chunk's words as UTF-8; special tokens in it come as their ids."""
        if chunk.isascii():
            # Most chunks are a word, or a word and a point or comma.
            if chunk.isalpha():
                return [chunk.lower().encode()]
            if chunk[-1] in ".," and chunk[:-1].isalpha():
                return [chunk[:-1].lower().encode(), chunk[-1].encode()]
        found: list[bytes | int] = []
        for part in self._special.split(chunk) if "<" in chunk else (chunk,):
            if part in self.special:
                found.append(self.special[part])
            elif part:
                plain = part if part.isascii() else unicodedata.normalize("NFC", part)
                # One character at a time, a final sigma has no form of its own.
                lower = plain.replace("Σ", "σ").lower()
                found += [word.encode() for word in self._words.findall(lower)]
        return found


def chunks(text: str) -> list[str]:
    """The stretches between white space."""
    return _CHUNK.findall(text) if _SPLIT_DIFFERS.search(text) else text.split()


@cache
def vocabulary(path: str) -> WordVocabulary:
    """Read once per worker."""
    return WordVocabulary(path)
