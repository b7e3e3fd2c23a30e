"""Minimal perfect hashing: n different numbers to the places 0..n-1, in a few bits each.

Level by level, numbers are hashed to as many bits as there are numbers left (and
some more); those that are alone on their bit stay there, the others go on to
the next level. A number's place is the number of set bits before its own.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

ROOM = 1.5  # bits per number on each level
_LEVELS = 64  # far more than are ever needed; then numbers would have equal hashes on all levels


def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    x = keys + np.uint64((2 * level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


@dataclass
class PerfectHash:
    """The levels' bits, and the set bits before each level and each of its bytes."""

    sizes: list[int]
    bits: list[np.ndarray]  # packed

    def __post_init__(self):
        self.flags = [
            np.unpackbits(b, count=n, bitorder="little")
            for b, n in zip(self.bits, self.sizes, strict=True)
        ]
        self.ranks, before = [], 0
        for flags in self.flags:
            self.ranks.append(before + np.cumsum(flags, dtype=np.int64) - 1)
            before += int(flags.sum())
        self.count = before

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Of different numbers (uint64)."""
        sizes, bits, left = [], [], keys
        while len(left):
            if len(sizes) == _LEVELS:
                raise ValueError("numbers must be different")
            size = int(ROOM * len(left)) + 1
            place = _place(left, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            bits.append(np.packbits(alone, bitorder="little"))
            left = left[~alone[place]]
        return cls(sizes, bits)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each number; of one that was not given, any place or -1."""
        found = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            place = _place(keys[open_], level, size)
            here = self.flags[level][place] > 0
            found[open_[here]] = self.ranks[level][place[here]]
            open_ = open_[~here]
        return found

    def to_bytes(self) -> bytes:
        head = np.array([len(self.sizes), *self.sizes], np.int64).tobytes()
        return head + b"".join(b.tobytes() for b in self.bits)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        levels = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, levels, 8).tolist()
        bits, at = [], 8 * (levels + 1)
        for size in sizes:
            n = -(-size // 8)
            bits.append(np.frombuffer(data, np.uint8, n, at))
            at += n
        return cls(sizes, bits)


@dataclass
class CountTable:
    """Counts by key: a perfect hash, the keys at their places to be verified, and the counts there."""

    index: PerfectHash
    keys: np.ndarray
    counts: np.ndarray

    @classmethod
    def empty(cls, keys: np.ndarray) -> CountTable:
        """All counts zero, of different keys."""
        index = PerfectHash.build(keys)
        at = np.empty_like(keys)
        at[index.places(keys)] = keys
        return cls(index, at, np.zeros(len(keys), np.int64))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Verified places; a key that is not there is an error."""
        found = self.index.places(keys)
        if len(keys) and ((found < 0).any() or (self.keys[found] != keys).any()):
            raise KeyError("a key is not in the table")
        return found
