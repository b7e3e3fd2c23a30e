"""Alignment of two tokenizers' tokens, with how many documents link each pair of ids.

Both vocabularies cut a text into bytes' ranges. Where ranges of both end, a
group ends; tokens of both whose ranges overlap are linked. No token goes on
across a space that follows another character than white space, so texts are
cut there and different pieces are aligned once in a chunk of rows.

A first pass over the documents encodes them and gives the pairs of ids of each chunk of
rows, with the number of documents. They are dealt to slices by the first id; the pairs
of a slice have a minimal perfect hash, under which the chunks' counts are dense
vectors that are summed as a tree. A second pass aligns the documents again,
from the ids that the first one stored, and looks the counts up. Chunks ask slices for the counts of their pairs only, so
nothing is broadcast, however many pairs there are.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetlake.llm.perfect_hash import CountTable, PerfectHash
from fleetlake.llm.tables import partitions, stored
from fleetlake.llm.words import BYTE_WORDS, Agreement, byte_characters, rows_in_pieces

CHUNK = 8 << 20  # bytes of text whose pairs are looked up together
KEPT = 500_000  # pieces of texts that a worker remembers
BLOCK = 1 << 14  # pieces encoded, or written as text, in one go: long texts take the libraries much memory
SLICES = 1024
BRANCHES = 16  # parts of a slice that are summed on their own first
_cut = regex.compile(r"(?<=\S)(?= )").split


class _Numbers(dict):
    """Pieces numbered as they come."""

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        return number


@dataclass
class Tokens:
    """Both kinds of ids of pieces of texts, one piece after another.

    A piece has tokens of both kinds, or none if they don't give back its bytes.
    """

    first: np.ndarray
    n_first: np.ndarray
    second: np.ndarray
    n_second: np.ndarray

    @classmethod
    def of(cls, pairs: list[tuple[list[int], list[int]]]) -> Tokens:
        return cls(
            np.array([i for a, _ in pairs for i in a], np.int64),
            np.array([len(a) for a, _ in pairs], np.int64),
            np.array([i for _, b in pairs for i in b], np.int64),
            np.array([len(b) for _, b in pairs], np.int64),
        )

    def then(self, *others: Tokens) -> Tokens:
        arrays = (t.arrays() for t in (self, *others))
        return Tokens(*(np.concatenate(x) for x in zip(*arrays, strict=True)))

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.first, self.n_first, self.second, self.n_second

    def take(self, at: np.ndarray) -> Tokens:
        found = []
        for ids, n in ((self.first, self.n_first), (self.second, self.n_second)):
            found += [ids[ragged((np.cumsum(n) - n)[at], n[at])], n[at]]
        return Tokens(*found)


@dataclass
class Pieces:
    """What pieces of texts become, a row each."""

    numbers: np.ndarray  # tokens of both kinds, groups, linked pairs
    starts: np.ndarray  # of the linked pairs' places, and their end
    pairs: np.ndarray  # first id << 32 | second id, one for each linked occurrence
    groups: list[str]  # if asked for


def align(
    tokens: Tokens, first_sizes: np.ndarray, second_sizes: np.ndarray, with_groups: bool = False
) -> Pieces:
    """Groups and links of all pieces at once, by the places of their bytes in a row."""
    sizes_a, sizes_b = first_sizes[tokens.first], second_sizes[tokens.second]
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    both = np.intersect1d(ends_a, ends_b, assume_unique=True)
    low = np.searchsorted(ends_b, ends_a - sizes_a, side="right")
    high = np.searchsorted(ends_b - sizes_b, ends_a, side="left")
    met = high - low
    pairs = np.repeat(tokens.first, met) << 32 | tokens.second[ragged(low, met)]
    upto_a, upto_b = np.cumsum(tokens.n_first), np.cumsum(tokens.n_second)
    end = np.concatenate([[0], ends_a])[upto_a]
    upto = np.searchsorted(both, end, side="right")
    starts = np.concatenate([[0], np.cumsum(met)])[np.concatenate([[0], upto_a])]
    numbers = np.diff(np.stack((upto_a, upto_b, upto, starts[1:]), axis=1), axis=0, prepend=0)
    groups: list[str] = []
    if with_groups:
        # ids as text, group by group, each followed by its sign
        side = np.concatenate((np.zeros(len(ends_a), np.int64), np.ones(len(ends_b), np.int64)))
        part = 2 * np.searchsorted(both, np.concatenate((ends_a, ends_b))) + side
        order = np.argsort(part, kind="stable")
        last = np.append(np.diff(part[order]) != 0, True)[: len(part)]
        sign = np.where(last, np.where(side[order] == 0, "|", ";"), ",")
        ids = np.concatenate((tokens.first, tokens.second))[order]
        cuts = [0, *(upto_a + upto_b).tolist()]
        for k in range(0, len(cuts) - 1, BLOCK):
            some = cuts[k : k + BLOCK + 1]
            begin, end = some[0], some[-1]
            signs = zip(ids[begin:end].tolist(), sign[begin:end].tolist(), strict=True)
            signed = [f"{i}{s}" for i, s in signs]
            ranges = zip(some, some[1:], strict=False)
            groups += ["".join(signed[a - begin : b - begin])[:-1] for a, b in ranges]
    return Pieces(numbers, starts, pairs.astype(np.uint64), groups)


class Aligner:
    """The two vocabularies, and pieces of texts aligned by both."""

    def __init__(self, first_path: str, second_path: str):
        self.library = Tokenizer.from_file(first_path)
        self.library.encode_special_tokens = True  # their strings are plain text
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        words = {bytes(byte_of[c] for c in t): i for t, i in self._words(first_path)}
        self.encoding = tiktoken.Encoding(
            "own", pat_str=BYTE_WORDS, mergeable_ranks=words, special_tokens={}
        )
        self.agree = Agreement(lambda t: self.encoding.encode_ordinary(t), self._by_library)
        self.first_bytes = {i: w for w, i in words.items()}
        self.second = sentencepiece.SentencePieceProcessor(model_file=second_path)
        names = [self.second.id_to_piece(i) for i in range(self.second.get_piece_size())]
        self.second_bytes = [
            bytes([int(n[3:5], 16)]) if self.second.is_byte(i) else n.replace("▁", " ").encode()
            for i, n in enumerate(names)
        ]
        self.space = self.second.piece_to_id("▁")
        self.first_sizes = np.zeros(max(self.first_bytes) + 1, np.int64)
        for i, w in self.first_bytes.items():
            self.first_sizes[i] = len(w)
        self.second_sizes = np.array([len(w) for w in self.second_bytes])
        self.known: dict[str, int] = {}
        self.kept = Tokens.of([])

    @staticmethod
    def _words(path: str) -> list[tuple[str, int]]:
        """The vocabulary without its special strings; ids must follow the order of merges."""
        with open(path, encoding="utf-8") as file:
            found = json.load(file)
        special = {t["content"] for t in found["added_tokens"]}
        vocabulary = found["model"]["vocab"]
        for number, (left, right) in enumerate(found["model"]["merges"]):
            if vocabulary[left + right] != 256 + number:
                raise ValueError(f"ids of {path} aren't in the order of its merges")
        return [(t, i) for t, i in vocabulary.items() if t not in special]

    def _by_library(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def _one(self, piece: str) -> tuple[list[int], list[int]]:
        """Tokens of a piece on its own, by the libraries; none if they don't give back its bytes."""
        first = self._by_library(piece)
        # the second library puts a space before a text by itself, but not before an empty one
        second = self.second.encode(piece[1:]) if len(piece) > 1 else [self.space]
        a = b"".join([self.first_bytes.get(i, b"") for i in first])
        b = b"".join([self.second_bytes[i] for i in second])
        return (first, second) if a == b == piece.encode() else ([], [])

    def _together(self, pieces: list[str]) -> Tokens:
        """Pieces that begin with a space and end with a letter or sign, as one long text.

        No token of either kind crosses from one piece to the next, so the text's
        tokens are theirs.
        """
        if not pieces:
            return Tokens.of([])
        text = "".join(pieces)
        data = text.encode()
        first, second = self.encoding.encode_ordinary(text), self.second.encode(text[1:])
        if not (
            b"".join(map(self.first_bytes.__getitem__, first)) == data
            and b"".join(map(self.second_bytes.__getitem__, second)) == data
        ):
            return Tokens.of([self._one(p) for p in pieces])  # one of them is not given back
        first, second = np.array(first, np.int64), np.array(second, np.int64)
        ends = np.cumsum([len(p) if p.isascii() else len(p.encode()) for p in pieces])
        upto_a = np.searchsorted(np.cumsum(self.first_sizes[first]), ends) + 1
        upto_b = np.searchsorted(np.cumsum(self.second_sizes[second]), ends) + 1
        return Tokens(first, np.diff(upto_a, prepend=0), second, np.diff(upto_b, prepend=0))

    def tokens(self, pieces: list[str]) -> Tokens:
        """Of different pieces, in their order; those of earlier chunks are known.

        At most KEPT pieces are kept, and the given ones: beyond it, earlier ones are forgotten.
        """
        if len(self.known) > KEPT:
            self.forget()
        new = [p for p in pieces if p not in self.known]
        plain = [not p[-1].isspace() and "▁" not in p and self.agree(p) for p in new]
        some = [p for p, x in zip(new, plain, strict=True) if x]
        rest = [p for p, x in zip(new, plain, strict=True) if not x]
        for piece in (*some, *rest):
            self.known[piece] = len(self.known)
        made = [self._together(some[k : k + BLOCK]) for k in range(0, len(some), BLOCK)]
        self.kept = self.kept.then(*made, Tokens.of([self._one(p) for p in rest]))
        at = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        return self.kept.take(at)

    def forget(self) -> None:
        self.known, self.kept = {}, Tokens.of([])

    def align(self, tokens: Tokens, with_groups: bool = False) -> Pieces:
        return align(tokens, self.first_sizes, self.second_sizes, with_groups)


def pieces_of(text: str) -> list[str]:
    """A text with a space before it, cut before spaces that follow no white space."""
    cut = text.split(" ")
    for word in cut[:-1]:
        if not word or word[-1].isspace():  # white space in a row stays in one piece
            return _cut(f" {text}")
    return [f" {word}" for word in cut] if cut[-1] else _cut(f" {text}")


@lru_cache(maxsize=2)
def _aligner(first_path: str, second_path: str) -> Aligner:
    return Aligner(first_path, second_path)


def aligned_pairs(found: Pieces, slices: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs by slice, their slices, and the place there of each linked occurrence."""
    keys, place = np.unique(found.pairs, return_inverse=True)
    slice_ = slice_of(keys, slices)
    order = np.argsort(slice_, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return keys[order], slice_[order], rank[place]


def documents_per_pair(found: Pieces, laid: np.ndarray, n: int, rows: list) -> np.ndarray:
    """How many rows (pieces' numbers, None for no tokens) hold each of n pairs linked."""
    counts = np.zeros(n, np.int64)
    sizes, some_fail = np.diff(found.starts), not found.numbers[:, 0].all()
    for ids in rows:
        if ids is None or some_fail and not found.numbers[ids, 0].all():
            continue
        some = np.unique(ids)
        counts[np.unique(laid[ragged(found.starts[some], sizes[some])])] += 1
    return counts


def digest_rows(
    found: Pieces, laid: np.ndarray, counts: np.ndarray, best: np.ndarray, rows: list
) -> Iterator[tuple]:
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups' digest) of each row."""
    of_links = np.stack((best[laid].astype(np.int64), counts[laid]))
    total = np.concatenate((np.zeros((2, 1), np.int64), np.cumsum(of_links, axis=1)), axis=1)
    sums = total[:, found.starts[1:]] - total[:, found.starts[:-1]]
    whole = np.concatenate((found.numbers, sums.T), axis=1)
    some_fail = not found.numbers[:, 0].all()
    for ids in rows:
        if ids is None or some_fail and not found.numbers[ids, 0].all():
            yield (0, 0, 0, 0, 0, 0, "")
        else:
            text = ";".join([found.groups[i] for i in ids.tolist()])
            yield (*whole[ids].sum(axis=0).tolist(), hashlib.sha256(text.encode()).hexdigest())


def packed(numbers: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the largest one needs, and how many before them."""
    kind = np.min_scalar_type(int(numbers.max(initial=0)))
    return bytes([kind.itemsize]) + numbers.astype(kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1).astype(np.int64)


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


def slice_of(keys: np.ndarray, slices: int) -> np.ndarray:
    """By the first id alone, so that all pairs of one id share a slice."""
    x = (keys >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) % np.uint64(slices)).astype(np.int64)


_DATA = ("d1", "d2", "d3", "d4")
_ANSWER, _TOKENS, _ROW, _PAIRS = range(4)  # kinds of rows of the passes' tables


def _batch(chunk: int, kind: int, places: list[int], keys: pa.Array, data: list) -> pa.RecordBatch:
    n = len(places)
    empty = [pa.nulls(n, pa.binary())] * (len(_DATA) - len(data))
    columns = [
        pa.array([chunk] * n, pa.int64()),
        pa.array([kind] * n, pa.int32()),
        pa.array(places, pa.int32()),
        keys,
        *(pa.array(d, pa.binary()) for d in data),
        *empty,
    ]
    return pa.RecordBatch.from_arrays(columns, ["chunk", "kind", "place", "key", *_DATA])


def _schema(key: str) -> str:
    return f"chunk long, kind int, place int, key {key}, d1 binary, d2 binary, d3 binary, d4 binary"


def _first_pass(
    rows: DataFrame, make: Callable[[], Aligner], chunk_bytes: int, slices: int
) -> DataFrame:
    """Three kinds of rows for each chunk: its texts as numbers of pieces, the pieces' tokens, and
    by slice its pairs with the number of texts that hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, chunk = make(), TaskContext.get().partitionId() << 32
        number, texts, size = _Numbers(), [], 0

        def flush(kind: pa.DataType) -> Iterator[pa.RecordBatch]:
            tokens = aligner.tokens(list(number))
            whole = [[packed(x)] for x in tokens.arrays()]
            yield _batch(chunk, _TOKENS, [0], pa.nulls(1, kind), whole)
            found = aligner.align(tokens)
            pairs, slice_, laid = aligned_pairs(found, slices)
            counts = documents_per_pair(found, laid, len(pairs), texts)
            if not len(pairs):
                return
            cuts = np.flatnonzero(np.diff(slice_, prepend=-1)).tolist()
            ranges = list(zip(cuts, [*cuts[1:], len(pairs)], strict=True))
            parts = [[x[a:b].tobytes() for a, b in ranges] for x in (pairs, counts)]
            yield _batch(chunk, _PAIRS, slice_[cuts].tolist(), pa.nulls(len(cuts), kind), parts)

        for batch in rows_in_pieces(batches):
            first = len(texts)
            for text in batch.column("text").to_pylist():
                size += len(text or "")
                pieces = pieces_of(text) if text else None
                texts.append(
                    None
                    if pieces is None
                    else np.fromiter(map(number.__getitem__, pieces), np.int64, len(pieces))
                )
            new = [None if t is None else packed(t) for t in texts[first:]]
            places = list(range(first, len(texts)))
            yield _batch(chunk, _ROW, places, batch.column("key"), [new])
            if size >= chunk_bytes:
                yield from flush(batch.column("key").type)
                chunk, number, texts, size = chunk + 1, _Numbers(), [], 0
        if texts:
            yield from flush(batch.column("key").type)

    return rows.mapInArrow(run, _schema(rows.schema["key"].dataType.simpleString()))


def _arrays(data: bytes, kind=np.uint64) -> np.ndarray:
    return np.frombuffer(data, kind)


def _merge(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    different, place = np.unique(keys, return_inverse=True)
    total = np.zeros(len(different), np.int64)
    np.add.at(total, place, counts)
    return different, total


def _branches(parts: DataFrame, branches: int) -> DataFrame:
    """(slice, branch, keys, counts): chunks' pairs of a slice, merged branch by branch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size, most = None, [], 0, 0

        def emit() -> pa.RecordBatch:
            keys, counts = _merge(*(np.concatenate(x) for x in zip(*held, strict=True)))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([now[0]], pa.int32()),
                    pa.array([now[1]], pa.int32()),
                    pa.array([keys.tobytes()], pa.binary()),
                    pa.array([counts.tobytes()], pa.binary()),
                ],
                ["slice", "branch", "keys", "counts"],
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("slice", "branch", "keys", "counts"))
            for slice_, branch, keys, counts in zip(*columns, strict=True):
                if now != (slice_, branch):
                    if held:
                        yield emit()
                    now, held, size, most = (slice_, branch), [], 0, 1 << 16
                held.append((_arrays(keys), _arrays(counts, np.int64)))
                size += len(held[-1][0])
                if size > most:  # what is held stays within a few times the different pairs
                    held = [_merge(*(np.concatenate(x) for x in zip(*held, strict=True)))]
                    size = len(held[0][0])
                    most = max(most, 4 * size)
        if held:
            yield emit()

    dealt = (
        parts.withColumn("branch", F.pmod(F.xxhash64("chunk"), F.lit(branches)).cast("int"))
        .repartition(partitions(parts.sparkSession), "slice", "branch")
        .sortWithinPartitions("slice", "branch")
    )
    return dealt.mapInArrow(run, "slice int, branch int, keys binary, counts binary")


def _tables(branches: DataFrame) -> DataFrame:
    """(slice, hash, keys, counts, best): each slice's perfect hash and dense vectors by place.

    ``best`` marks pairs whose count is the highest of their first id. A slice's
    branches, of which there are a fixed number, are held together: their keys make the
    hash, and then each one's counts are added as a dense vector.
    """

    def emit(slice_: int, held: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        table = CountTable.empty(np.unique(np.concatenate([k for k, _ in held])))
        for keys, counts in held:
            dense = np.zeros(len(table.keys), np.int64)
            dense[table.places(keys)] = counts
            table.counts += dense
        first = table.keys >> np.uint64(32)
        ids, place = np.unique(first, return_inverse=True)
        highest = np.zeros(len(ids), np.int64)
        np.maximum.at(highest, place, table.counts)
        best = (table.counts == highest[place]).astype(np.uint8)
        data = (table.index.to_bytes(), table.keys.tobytes(), table.counts.tobytes(), best.tobytes())
        return pa.RecordBatch.from_arrays(
            [pa.array([slice_], pa.int32()), *(pa.array([d], pa.binary()) for d in data)],
            ["slice", "hash", "keys", "counts", "best"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("slice", "keys", "counts"))
            for slice_, keys, counts in zip(*columns, strict=True):
                if slice_ != now and held:
                    yield emit(now, held)
                    held = []
                now = slice_
                held.append((_arrays(keys), _arrays(counts, np.int64)))
        if held:
            yield emit(now, held)

    dealt = branches.repartition(partitions(branches.sparkSession), "slice")
    schema = "slice int, hash binary, keys binary, counts binary, best binary"
    return dealt.sortWithinPartitions("slice", "branch").mapInArrow(run, schema)


def _answers(parts: DataFrame, tables: DataFrame, branches: int) -> DataFrame:
    """(chunk, place, d1, d2): slices, counts and marks of every chunk's pairs, in their order.

    A slice's table is given to each of its branches, and meets the chunks there.
    """
    branch = F.pmod(F.xxhash64("chunk"), F.lit(branches)).cast("int")
    none = F.lit(None)
    asked = parts.select(
        "slice",
        branch.alias("branch"),
        "chunk",
        "keys",
        *(none.cast("binary").alias(c) for c in ("hash", "counts", "best")),
    )
    given = tables.select(
        "slice",
        F.explode(F.sequence(F.lit(0), F.lit(branches - 1))).alias("branch"),
        none.cast("long").alias("chunk"),
        "keys",
        "hash",
        "counts",
        "best",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, best = None, None
        for batch in rows_in_pieces(batches, 4096):
            found: list[tuple] = []
            columns = (
                batch.column(c).to_pylist()
                for c in ("slice", "chunk", "keys", "hash", "counts", "best")
            )
            for slice_, chunk, keys, hash_, counts, marks in zip(*columns, strict=True):
                if chunk is None:
                    index = PerfectHash.from_bytes(hash_)
                    table = CountTable(index, _arrays(keys), _arrays(counts, np.int64))
                    best = _arrays(marks, np.uint8)
                    continue
                place = table.places(_arrays(keys))
                found.append((chunk, slice_, table.counts[place].tobytes(), best[place].tobytes()))
            if found:
                kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True)],
                    ["chunk", "place", "d1", "d2"],
                )

    dealt = (
        asked.unionByName(given)
        .repartition(partitions(parts.sparkSession), "slice", "branch")
        .sortWithinPartitions("slice", "branch", F.col("chunk").asc_nulls_first())
    )
    return dealt.mapInArrow(run, "chunk long, place int, d1 binary, d2 binary")


_DIGEST = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")


def alignment(
    docs: DataFrame,
    first_path: str,
    second_path: str,
    key: str = "doc_id",
    text: str = "text",
    chunk_bytes: int = CHUNK,
    slices: int = SLICES,
    branches: int = BRANCHES,
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    A pair's count is the number of rows that hold it linked; links whose count is
    the highest of their first id are best, ties included. Texts that are null or
    empty, or that tokens don't give back, have zeros and an empty digest. Equal rows and null
    keys are rows of their own; an empty table gives an empty one; other columns are
    not looked at. A task holds the pieces of one chunk, or of one longer text; a slice's pairs are bounded
    by the vocabularies (50 257 x 32 000 pairs in 1024 slices: 13 MB of counts).
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def make() -> Aligner:
        return _aligner(first_path, second_path)

    first = stored(_first_pass(rows, make, chunk_bytes, slices))
    named = [F.col("place").alias("slice"), F.col("d1").alias("keys"), F.col("d2").alias("counts")]
    parts = first.where(F.col("kind") == _PAIRS).select("chunk", *named)
    tables = stored(_tables(stored(_branches(parts, branches))))
    answers = _answers(parts.drop("counts"), tables, branches)
    kind = rows.schema["key"].dataType.simpleString()
    none = F.lit(None)
    answers = answers.select(
        "chunk",
        F.lit(_ANSWER).alias("kind"),
        "place",
        none.cast(kind).alias("key"),
        "d1",
        "d2",
        *(none.cast("binary").alias(d) for d in _DATA[2:]),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, now = make(), None
        aligner.forget()  # the worker may come from the first pass, and here no text is encoded
        counts, best, tokens, keys, texts = [], [], None, [], []

        def emit() -> Iterator[pa.RecordBatch]:
            found = aligner.align(tokens, with_groups=True)
            laid = aligned_pairs(found, slices)[2]
            whole = np.concatenate([np.zeros(0, np.int64), *counts])
            marks = np.concatenate([np.zeros(0, np.uint8), *best])
            *numbers, digests = zip(*digest_rows(found, laid, whole, marks, texts), strict=True)
            names = ["key", *_DIGEST, "groups_sha256"]
            columns = [pa.concat_arrays(keys), *(pa.array(n, pa.int64()) for n in numbers)]
            made = pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.string())], names)
            yield from rows_in_pieces([made], 10_000)

        for batch in rows_in_pieces(batches):
            # a chunk's counts by slice, then its pieces, then its texts
            columns = (batch.column(c).to_pylist() for c in ("chunk", "kind", *_DATA))
            for i, (chunk, kind_, d1, d2, d3, d4) in enumerate(zip(*columns, strict=True)):
                if chunk != now:
                    if texts:
                        yield from emit()
                    now, counts, best, tokens, keys, texts = chunk, [], [], None, [], []
                if kind_ == _ANSWER:
                    counts.append(_arrays(d1, np.int64))
                    best.append(_arrays(d2, np.uint8))
                elif kind_ == _TOKENS:
                    tokens = Tokens(*map(unpacked, (d1, d2, d3, d4)))
                else:
                    keys.append(batch.column("key").slice(i, 1))
                    texts.append(None if d1 is None else unpacked(d1))
        if texts:
            yield from emit()

    schema = f"key {kind}, {', '.join(f'{c} long' for c in _DIGEST)}, groups_sha256 string"
    return (
        answers.unionByName(first.where(F.col("kind") != _PAIRS))
        .repartition(partitions(docs.sparkSession), "chunk")
        .sortWithinPartitions("chunk", "kind", "place")
        .mapInArrow(run, schema)
        .withColumnRenamed("key", key)
    )
