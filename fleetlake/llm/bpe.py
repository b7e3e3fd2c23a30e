"""The merge table of a byte-pair vocabulary file with word ends."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass
from functools import lru_cache

from fleetlake.llm.words import byte_characters


@dataclass(frozen=True)
class Merges:
    """Base symbols by byte, merges by rank, and the strings that stand for an id as they are."""

    inner: list[int]  # the id of each byte inside a word
    last: list[int]  # the id of each byte at the end of a word
    pairs: dict[tuple[int, int], tuple[int, int]]  # (left id, right id) -> (rank, merged id)
    labels: dict[int, str]  # id -> the vocabulary's string
    special: dict[str, int]

    def symbols(self, word: str) -> list[int]:
        """The base symbols of one word."""
        raw = word.encode()
        ids = [self.inner[b] for b in raw[:-1]]
        ids.append(self.last[raw[-1]])
        return ids

    def special_pattern(self) -> re.Pattern | None:
        """Matches the special strings, which a text's other parts are split at."""
        words = sorted(self.special, key=len, reverse=True)
        return re.compile("(" + "|".join(map(re.escape, words)) + ")") if words else None


@lru_cache(maxsize=2)
def load(path: str) -> Merges:
    """Read a vocabulary file once per process.

    Its merges must be made of symbols that are there before them, each giving a
    new symbol: only then does merging by lowest rank equal applying one merge
    after the other.
    """
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    model = found["model"]
    vocabulary, end = model["vocab"], model["end_of_word_suffix"] or ""
    characters = byte_characters()
    inner = [vocabulary[c] for c in characters]
    last = [vocabulary[c + end] for c in characters]
    known, pairs = {*inner, *last}, {}
    for rank, (left, right) in enumerate(model["merges"]):
        made = vocabulary[left + right]
        if vocabulary[left] not in known or vocabulary[right] not in known or made in known:
            raise ValueError(f"merge {rank} of {path} is out of order: {left} {right}")
        known.add(made)
        pairs[vocabulary[left], vocabulary[right]] = rank, made
    special = {t["content"]: t["id"] for t in found["added_tokens"] if t["special"]}
    labels = {i: s for s, i in vocabulary.items()} | {i: s for s, i in special.items()}
    return Merges(inner, last, pairs, labels, special)
