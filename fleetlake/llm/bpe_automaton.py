"""Byte-pair encoding as paths of a deterministic automaton over the vocabulary.

The automaton accepts exactly the token sequences that merging gives. It starts
as one state that every base symbol loops on. Each merge (u, v) -> w, in order
of rank, is one gadget: the state that u leads to is copied without its v arc,
u now leads to the copy, and every state with a u arc gets a w arc to where the
v arc led. So a symbol leads to one state from wherever it is read, and a word
has one accepted path. Arcs are labelled with symbols: the labels of a path are
the ids, and decoding emits the vocabulary's strings of the labels.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.bpe import Merges, load
from fleetlake.llm.words import Memo, lower_words, rows_in_pieces

_NEVER = 1 << 62
_END = -1
_first, _second = itemgetter(0), itemgetter(1)


class Automaton:
    """The automaton in compact form, with tables that transitions are read from.

    A state is a symbol and a time (rank): where the symbol led at that time.
    Copies differ from their original by one banned arc, so states keep only
    that; ``_has_arc`` follows copies and gadgets back to the base symbols. What
    it finds goes to a table of arcs, which is what encoding reads.
    """

    def __init__(self, merges: Merges, arcs: int = 1_000_000):
        self.merges = merges
        self.created: dict[int, int] = {}  # symbol -> time of its gadget, 0 for base symbols
        self.parts: dict[int, tuple[int, int]] = {}
        self.banned: dict[tuple[int, int], int] = {}  # (u, v) -> time from which v can't follow u
        self.arcs, self.limit = {}, arcs
        self.tree: dict[int, dict] = {}  # by base symbols, with the symbol that ends at a node
        spelled: dict[int, list[int]] = {}
        for symbol in (*merges.inner, *merges.last):
            self.created[symbol] = 0
            spelled[symbol] = [symbol]
            self._spell(symbol, spelled[symbol])
        for (u, v), (rank, w) in merges.pairs.items():
            self._gadget(u, v, w, rank + 1, spelled)

    def _gadget(self, u: int, v: int, w: int, time: int, spelled: dict) -> None:
        self.created[w], self.parts[w] = time, (u, v)
        if u in spelled and v in spelled and self._has_arc(u, time, v):
            self.banned[u, v] = time
            spelled[w] = spelled[u] + spelled[v]
            self._spell(w, spelled[w])

    def _spell(self, symbol: int, base: list[int]) -> None:
        node = self.tree
        for b in base:
            node = node.setdefault(b, {})
        node[_END] = symbol

    def _has_arc(self, u: int, time: int, x: int) -> bool:
        """Whether the state that u led to before that time's gadget has an arc for x."""
        while True:
            if self.banned.get((u, x), _NEVER) < time:
                return False
            made, came = self.created[u], self.created[x]
            if made > came:  # u's state began as the one that its right part led to
                u, time = self.parts[u][1], made
            elif came:  # a gadget gave the arc to states with an arc for its left part
                time, x = min(time, came + 1), self.parts[x][0]
            else:
                return True

    def arc(self, state: int, label: int) -> bool:
        """Whether the state that a symbol leads to has an arc, for the table."""
        if len(self.arcs) >= self.limit:
            self.arcs.clear()
        found = self.arcs[state, label] = self._has_arc(state, _NEVER, label)
        return found

    def encode(self, word: str) -> list[int]:
        """The labels of the word's accepted path.

        Every beginning of a word has one accepted path too, so each place is
        reached by one label at most and is left at most once. The longest arcs
        are tried first, as they mostly lead to the end.
        """
        base = self.merges.symbols(word)
        n = len(base)
        label, came_from = [-1] * (n + 1), [0] * (n + 1)
        arcs, tree = self.arcs, self.tree
        to_try = []
        i = 0
        while True:
            node = tree
            for j in range(i, n):
                node = node.get(base[j])
                if node is None:
                    break
                if _END in node and label[j + 1] < 0:
                    to_try.append((i, j + 1, node[_END]))
            while True:
                i, j, symbol = to_try.pop()
                if label[j] >= 0:
                    continue
                if i:
                    ok = arcs.get((label[i], symbol))
                    if ok is None:
                        ok = self.arc(label[i], symbol)
                    if not ok:
                        continue
                label[j], came_from[j] = symbol, i
                break
            if j == n:
                break
            i = j
        path = []
        while n:
            path.append(label[n])
            n = came_from[n]
        return path[::-1]


def decode(merges: Merges, ids: list[int]) -> str:
    """The labels' strings, as a vocabulary without a decoder joins them."""
    return " ".join(map(merges.labels.__getitem__, ids))


@lru_cache(maxsize=2)
def coder(path: str):
    """A function from a text to its ids (packed, 4 bytes each) and its decoded text."""
    merges = load(path)
    automaton = Automaton(merges)

    def make(word: str) -> tuple[bytes, str]:
        ids = automaton.encode(word)
        return struct.pack(f"<{len(ids)}I", *ids), decode(merges, ids)

    memo = Memo(make, limit=300_000)
    split, special = lower_words(path), merges.special_pattern()

    def words(text: str) -> list[tuple[bytes, str]]:
        return list(map(memo.__getitem__, split(text)))

    def code(text: str) -> tuple[bytes, str]:
        if special is None or "<" not in text or not special.search(text):
            found = words(text)
        else:
            found = []
            for k, part in enumerate(special.split(text)):
                if k % 2:
                    found.append((struct.pack("<I", merges.special[part]), part))
                else:
                    found += words(part)
        return b"".join(map(_first, found)), " ".join(map(_second, found))

    return code


def bpe_round(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Encode and decode: key, ids (little-endian, 4 bytes each) and the decoded text.

    A null text counts as empty and gives no ids. Null keys, repeated rows and
    other columns make no difference; an empty table gives an empty one. Rows
    stay where they are read.
    """
    return _coded(
        docs,
        path,
        key,
        text,
        {
            "ids": (pa.binary(), "binary", lambda ids, decoded: ids),
            "decoded": (pa.string(), "string", lambda ids, decoded: decoded),
        },
    )


def bpe_digests(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """As ``bpe_round``, with n_tokens and SHA-256 digests (hex) instead of ids and text."""
    return _coded(
        docs,
        path,
        key,
        text,
        {
            "n_tokens": (pa.int64(), "long", lambda ids, decoded: len(ids) // 4),
            "ids_sha256": (pa.string(), "string", lambda ids, decoded: sha256(ids).hexdigest()),
            "decoded_sha256": (
                pa.string(),
                "string",
                lambda ids, decoded: sha256(decoded.encode()).hexdigest(),
            ),
        },
    )


def _coded(docs: DataFrame, path: str, key: str, text: str, columns: dict) -> DataFrame:
    slim = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = coder(path)
        for batch in rows_in_pieces(batches):
            made = [[] for _ in columns]
            for t in batch.column("text").to_pylist():
                coded = code(t)
                for values, (_, _, derive) in zip(made, columns.values(), strict=True):
                    values.append(derive(*coded))
            arrays = [
                pa.array(values, kind)
                for values, (kind, _, _) in zip(made, columns.values(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *arrays], ["key", *columns])

    kind = slim.schema["key"].dataType.simpleString()
    schema = ", ".join([f"key {kind}", *(f"{c} {t}" for c, (_, t, _) in columns.items())])
    return slim.mapInArrow(run, schema).withColumnRenamed("key", key)
