"""Packing of token sequences by cutting-stock column generation.

A document is cut into whole sequences and a tail. The tails' lengths are a
histogram of at most ``size`` - 1 numbers, however large the corpus: a linear
program over patterns of lengths says how often to use each pattern. Tails are
ranked within their length, and ranks are dealt to the rounded patterns' places.
Tails without a place are a stream, which fills the patterns' gaps and is cut at every ``size``.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetlake.llm.tables import partitions, stored
from fleetlake.llm.words import BYTE_WORDS, Agreement, byte_characters, rows_in_pieces

LAYOUT = (
    "length int, low long, high long, each long, sequence long, offset long, place long"
)


PRICED = 32  # patterns that a pricing step offers at most; later steps offer the others


@lru_cache(maxsize=2)
def tokenizer(path: str):
    """A function from a text to its ids, for a byte-level vocabulary file; once per process.

    The ids are those of the file's own library, special strings inside texts
    included. Merges are applied by rank, which is the order of the ids.
    """
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    special = {t["content"]: t["id"] for t in found["added_tokens"]}
    vocabulary = found["model"]["vocab"]
    for number, (left, right) in enumerate(found["model"]["merges"]):
        if vocabulary[left + right] != 256 + number:
            raise ValueError(f"ids of {path} aren't in the order of its merges")
    ranks = {
        bytes(map(byte_of.__getitem__, s)): i for s, i in vocabulary.items() if s not in special
    }
    encoding = tiktoken.Encoding(
        "own", pat_str=BYTE_WORDS, mergeable_ranks=ranks, special_tokens=special
    )
    library = Tokenizer.from_file(path)

    def own(text: str) -> np.ndarray:
        return encoding.encode_to_numpy(text, allowed_special="all")

    def by_library(text: str) -> np.ndarray:
        return np.array(library.encode(text, add_special_tokens=False).ids, np.uint32)

    agree = Agreement(lambda text: own(text).tolist(), lambda text: by_library(text).tolist())
    return lambda text: own(text) if agree(text) else by_library(text)


def tokenized(
    docs: DataFrame, path: str, size: int, end: int = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: key, tokens with the end id, CRCs of its whole sequences, and its tail's ids."""
    slim = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)
        for batch in rows_in_pieces(batches):
            totals, crcs, tails = [], [], []
            for t in batch.column("text").to_pylist():
                ids = np.append(encode(t), np.uint32(end)).astype("<u4", copy=False)
                whole = len(ids) // size * size
                raw = ids.data.cast("B")
                totals.append(len(ids))
                crcs.append([crc32(raw[4 * i : 4 * (i + size)]) for i in range(0, whole, size)])
                tails.append(bytes(raw[4 * whole :]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(totals, pa.int64()),
                    pa.array(crcs, pa.list_(pa.int64())),
                    pa.array([crc32(t) for t in tails], pa.int64()),
                    pa.array(tails, pa.binary()),
                ],
                ["key", "tokens", "crcs", "tail_crc", "tail"],
            )

    kind = slim.schema["key"].dataType.simpleString()
    columns = f"key {kind}, tokens long, crcs array<long>, tail_crc long, tail binary"
    return slim.mapInArrow(run, columns).withColumn("row", F.monotonically_increasing_id())


def best_values(
    lengths: np.ndarray, worth: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the most worth in each room, and its last length."""
    best, last = np.zeros(size + 1), np.full(size + 1, -1)
    upto = np.searchsorted(lengths, np.arange(size + 1), side="right")
    for c in range(1, size + 1):
        best[c] = best[c - 1]
        if k := upto[c]:
            gain = best[c - lengths[:k]] + worth[:k]
            at = int(gain.argmax())
            if gain[at] > best[c]:
                best[c], last[c] = gain[at], at
    return best, last


def pattern_of(lengths: np.ndarray, last: np.ndarray, room: int) -> np.ndarray:
    """How often each length is in the knapsack's best filling of a room."""
    pattern = np.zeros(len(lengths), np.int64)
    while room > 0:
        if last[room] < 0:
            room -= 1
        else:
            pattern[last[room]] += 1
            room -= int(lengths[last[room]])
    return pattern


def first_patterns(
    lengths: np.ndarray, demand: np.ndarray, size: int
) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """A first-fit packing: one pattern (column) a length, how often each is used, their order.

    The longest length that is left comes first, then what fits beside it; the pattern is
    used until one of its lengths, its column, is used up and in no later pattern. So the
    columns are triangular in that order, and a basis.
    """
    m = len(lengths)
    patterns, use = np.zeros((m, m), np.int64), np.zeros(m)
    left = demand.astype(float)
    unused, values, order = list(range(m)), lengths.tolist(), []
    while unused:
        room, pattern, at = size, {}, len(unused) - 1
        while at >= 0:
            i = unused[at]
            n = min(room // values[at], max(1, int(left[i])))
            if n:
                pattern[i] = n
                room -= n * values[at]
            at = min(at, bisect_right(values, room)) - 1
        out = min(pattern, key=lambda i: left[i] / pattern[i])
        use[out] = left[out] / pattern[out]
        for i, n in pattern.items():
            patterns[i, out] = n
            left[i] = max(left[i] - use[out] * n, 0.0)
        left[out] = 0
        order.append(out)
        at = unused.index(out)
        del unused[at], values[at]
    return patterns, use, order


def _triangular_inverse(patterns: np.ndarray, order: list[int]) -> np.ndarray:
    """The inverse of first-fit patterns, by substitution in their order.

    Library inversion is not used: its threads have stood still in a driver beside a JVM.
    """
    inverse = np.zeros(patterns.shape)
    for i in order:
        others = np.flatnonzero(patterns[i])
        others = others[others != i]
        row = -(patterns[i, others, None] * inverse[others]).sum(axis=0)
        row[i] += 1
        inverse[i] = row / patterns[i, i]
    inverse[np.abs(inverse) < 1e-30] = 0  # next to nothing, but slow to compute with
    return inverse


def solve(
    lengths: np.ndarray, demand: np.ndarray, size: int, tolerance: float, slack: float
) -> tuple[np.ndarray, np.ndarray, float]:
    """Patterns (columns), how often to use them, and a proven lower bound of the sequences.

    Column generation for the fewest sequences that hold the demand. It starts from a
    first-fit packing. The knapsack prices the best pattern around every length by the
    simplex multipliers, and those that are worth more than one sequence may enter the basis.
    It ends when the sequences are within ``tolerance`` or ``slack`` sequences of the bound
    (tokens over size, or what a pricing step proves), when no pattern is worth more
    than one, which is the optimum, or when 20 pricing steps together gain less than a tenth of
    what it may end from the bound (the last, slow steps to an optimum above the bound). The demand is raised by up to 1e-5 of itself, unevenly,
    so that no two lengths run out at once and each step gains something.
    """
    m = len(lengths)
    raised = demand * (1 + 1e-5 * np.random.default_rng(0).random(m))
    patterns, use, order = first_patterns(lengths, raised, size)
    inverse = _triangular_inverse(patterns, order)
    multipliers = inverse.sum(axis=0)
    floor, totals = float(lengths @ raised) / size, []
    while (total := float(use.sum())) > floor + (allowed := max(floor * tolerance, slack)):
        totals.append(total)
        if len(totals) > 20 and totals[-21] - total <= max(allowed / 10, 1e-9 * total):
            break
        best, last = best_values(lengths, multipliers, size)
        floor = max(floor, float(multipliers @ raised) / best[size])
        if best[size] <= 1 + 1e-7:
            break
        around = multipliers + best[size - lengths]
        pool = []
        for i in np.argsort(-around)[:PRICED].tolist():
            if around[i] > 1 + 1e-7:
                pool.append(pattern_of(lengths, last, size - int(lengths[i])))
                pool[-1][i] += 1
        columns = np.array(pool).T
        for _ in range(2 * len(pool)):
            worth = multipliers @ columns
            at = int(worth.argmax())
            step = inverse @ columns[:, at]
            positive = step > 1e-7 * max(1.0, np.abs(step).max())
            if worth[at] <= 1 + 1e-7 or not positive.any():
                break
            ratios = np.full(m, np.inf)
            ratios[positive] = use[positive] / step[positive]
            # of rows that run out together the largest step, for the inverse's sake
            near = np.flatnonzero(positive & (use - ratios.min() * step <= 1e-9))
            out = int(near[step[near].argmax()])
            amount = ratios[out]
            use -= amount * step
            use[out] = amount
            np.maximum(use, 0, out=use)
            row = inverse[out] / step[out]
            inverse -= np.outer(step, row)
            inverse[out] = row
            multipliers = multipliers - (step.sum() - 1) * row
            patterns[:, out] = columns[:, at]
    return patterns, use, floor


@dataclass(frozen=True)
class Layout:
    """Where the ranks of each length go: rows of LAYOUT, and the stream's length and start."""

    rows: list[tuple]
    stream: int  # tokens that go through the stream
    first: int  # the stream's first whole sequence
    gaps: list[tuple[int, int, int]]  # (start in the stream, tokens, first sequence) of gaps
    gap_tokens: int  # what the stream puts into gaps, before its whole sequences


def _rounded(
    patterns: np.ndarray, use: np.ndarray, left: np.ndarray
) -> list[tuple[np.ndarray, int]]:
    """Patterns and whole numbers of uses, taken off what is left of the lengths.

    Numbers are rounded down, then patterns are used once more, by falling
    fractions, while enough is left of all their lengths.
    """
    found = []
    often = [(p, int(use[p] + 1e-3)) for p in np.argsort(-use)]
    again = [(p, 1) for p in np.argsort(-(use % 1))]
    for p, most in often + again:
        has = np.flatnonzero(patterns[:, p])
        times = int(min(most, (left[has] // patterns[has, p]).min()))
        if times > 0:
            left -= times * patterns[:, p]
            found.append((patterns[:, p], times))
    return found


def lay_out(counts: dict[int, int], size: int, tolerance: float, slack: float = 3) -> Layout:
    """Rounded patterns, and what they leave over, as ranges of ranks by length.

    The program's patterns are rounded; what that leaves is packed first-fit into
    patterns, too. Their gaps are filled from the stream of tails without a place. If that has
    too few tokens, patterns with the fewest tails are given up: each takes a gap away and
    gives tails to the stream, one sequence of tokens in all, so as few as can be are given up.
    The number of ranges is bounded by the patterns' places, not by the corpus.
    """
    rows: list[tuple] = []
    sequence = counts.get(size, 0)
    if sequence:
        rows.append((size, 0, sequence, 1, 0, 0, -1))
    lengths = np.array(sorted(n for n in counts if 0 < n < size), np.int64)
    left = np.array([counts[n] for n in lengths.tolist()], np.int64)
    dealt = np.zeros(len(lengths), np.int64)
    used: list[tuple[np.ndarray, int]] = []
    if len(lengths):
        patterns, use, _ = solve(lengths, left.astype(float), size, tolerance, slack)
        more = _rounded(patterns, use, left)
        while more:
            used += more
            rest = np.flatnonzero(left)
            patterns = np.zeros((len(lengths), len(rest)), np.int64)
            patterns[rest], use, _ = first_patterns(lengths[rest], left[rest], size)
            more = _rounded(patterns, use, left)
    # the fullest first; those with the fewest tails are given up
    used.sort(key=lambda u: (-u[0].sum(), -(lengths @ u[0])))
    open_tokens = sum(times * (size - int(lengths @ pattern)) for pattern, times in used)
    give_up = max(0, -(-(open_tokens - int(lengths @ left)) // size))
    while give_up:
        pattern, times = used.pop()
        n = min(times, give_up)
        left += n * pattern
        give_up -= n
        if times > n:
            used.append((pattern, times - n))
    gaps, gap_tokens = [], 0
    for pattern, times in used:
        offset = 0
        for i in np.flatnonzero(pattern):
            n, each = int(lengths[i]), int(pattern[i])
            low, high = int(dealt[i]), int(dealt[i]) + times * each
            rows.append((n, low, high, each, sequence, offset, -1))
            offset += n * each
            dealt[i] = high
        if offset < size:
            gaps.append((gap_tokens, size - offset, sequence))
            gap_tokens += times * (size - offset)
        sequence += times
    place = 0
    for n, low, rest in zip(lengths.tolist(), dealt.tolist(), left.tolist(), strict=True):
        if rest:
            rows.append((n, low, low + rest, 1, -1, -1, place))
            place += n * rest
    return Layout(rows, place, sequence, gaps, gap_tokens)


def stream_cuts(start: int, length: int, layout: Layout, size: int) -> list[tuple[int, ...]]:
    """(start in the item, length, sequence, offset) of an item's pieces in the stream.

    The stream fills the gaps of patterns, then it is cut at every ``size``; what
    remains at its end is cut at falling powers of two, which need no padding.
    """
    pieces, done = [], 0
    streamed = layout.stream - layout.gap_tokens
    whole = streamed // size
    while done < length:
        at = start + done
        if at < layout.gap_tokens:
            before, gap, sequence = layout.gaps[bisect_right(layout.gaps, (at, size)) - 1]
            number, offset = divmod(at - before, gap)
            n = min(gap - offset, length - done)
            pieces.append((done, n, sequence + number, size - gap + offset))
            done += n
            continue
        number, offset = divmod(at - layout.gap_tokens, size)
        room = size - offset
        if number == whole:
            rest, number = streamed % size, whole
            part = 1 << (rest.bit_length() - 1)
            while offset >= part:
                offset, rest, number = offset - part, rest - part, number + 1
                part = 1 << (rest.bit_length() - 1)
            room = part - offset
        n = min(room, length - done)
        pieces.append((done, n, layout.first + number, offset))
        done += n
    return pieces


def _ranked(pieces: DataFrame) -> DataFrame:
    """The rank of every piece within its length, from 0, without a task for a whole length.

    Pieces of a length are numbered within slices by hash, from the count of
    the slices before; a length that many pieces share has many slices.
    """
    slices = 4 * partitions(pieces.sparkSession)
    slice_ = F.pmod(F.xxhash64("row", "start"), F.lit(slices)).cast("int")
    dealt = pieces.withColumn("slice", slice_)
    of_length = Window.partitionBy("length").orderBy("slice")
    before = of_length.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("length", "slice")
        .agg(F.count("*").alias("n"))
        .select("length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    )
    within = Window.partitionBy("length", "slice").orderBy("row", "start")
    return (
        dealt.withColumn("number", F.row_number().over(within))
        .join(offsets, ["length", "slice"])
        .withColumn("rank", F.col("before") + F.col("number") - 1)
        .drop("slice", "before", "number")
    )


def pack(
    docs: DataFrame,
    path: str,
    size: int = 1024,
    end: int = 0,
    tolerance: float = 0.0003,
    slack: float = 3,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every text (null: empty) gives its ids and the end id, so an empty text has
    one token. Each row is a document of its own, repeated and null keys
    included. Every sequence holds ``size`` tokens, but for at most ten at the
    end that hold a power of two; so nothing is padded. An empty table gives an
    empty one; other columns are not looked at.
    """
    spark = docs.sparkSession
    rows = stored(tokenized(docs, path, size, end, key, text))
    whole = rows.select("row", "key", "tokens", F.posexplode("crcs").alias("number", "crc")).select(
        "row",
        "key",
        "tokens",
        (F.col("number").cast("long") * size).alias("start"),
        F.lit(size).alias("length"),
        "crc",
    )
    tails = rows.where(F.length("tail") > 0).select(
        "row",
        "key",
        "tokens",
        (F.size("crcs").cast("long") * size).alias("start"),
        (F.length("tail") / 4).cast("int").alias("length"),
        F.col("tail_crc").alias("crc"),
    )
    pieces = whole.unionByName(tails)
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    layout = lay_out(counts, size, tolerance, slack)
    # at most a row for each place of a pattern and one for each length: bounded by size
    ranges = spark.createDataFrame(layout.rows, LAYOUT).withColumnRenamed("length", "_length")
    in_range = (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    dealt = stored(
        _ranked(pieces)
        .join(F.broadcast(ranges), (F.col("length") == F.col("_length")) & in_range)
        .withColumn("rank", F.col("rank") - F.col("low"))
        .drop("_length", "low", "high")
    )
    in_patterns = dealt.where("sequence >= 0").select(
        "key",
        "start",
        F.col("length").cast("long").alias("length"),
        "crc",
        "tokens",
        F.expr("sequence + rank div each").alias("sequence_id"),
        (F.col("offset") + F.pmod("rank", "each") * F.col("length")).alias("offset"),
    )
    streamed = (
        dealt.where("sequence < 0")
        .select(
            "row",
            "key",
            "start",
            "tokens",
            (F.col("place") + F.col("rank") * F.col("length")).alias("place"),
        )
        .join(rows.select("row", "tail"), "row")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in_pieces(batches):
            taken, values = [], []
            starts, places = batch.column("start").to_pylist(), batch.column("place").to_pylist()
            for i, tail in enumerate(batch.column("tail").to_pylist()):
                for at, n, sequence, offset in stream_cuts(places[i], len(tail) // 4, layout, size):
                    taken.append(i)
                    crc = crc32(tail[4 * at : 4 * (at + n)])
                    values.append((starts[i] + at, n, crc, sequence, offset))
            columns = list(zip(*values, strict=True)) or [()] * 5
            start, n, crc, sequence, offset = (pa.array(c, pa.int64()) for c in columns)
            at = pa.array(taken, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key").take(at),
                    start,
                    n,
                    crc,
                    batch.column("tokens").take(at),
                    sequence,
                    offset,
                ],
                ["key", "start", "length", "crc", "tokens", "sequence_id", "offset"],
            )

    pieces_cut = streamed.mapInArrow(cut, in_patterns.schema)
    return in_patterns.unionByName(pieces_cut).select(
        F.col("key").alias(key),
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        F.col("tokens").alias("doc_tokens"),
        "sequence_id",
        "offset",
    )
