"""Exact removal of repeated byte strings, by suffix arrays over candidate regions.

Every string of ``window`` bytes has an anchor: the place of the least hash of
``gram`` bytes in it, the leftmost of equal ones. Equal strings have equal
anchors, so only strings whose anchors' grams are equal need to be compared. An
anchor's strings start next to each other and make up one region of a text.

Equal regions repeat each other. What differs meets in groups by gram: a suffix
array over 16-byte symbols, cut in step with the anchors, orders the suffixes at
every sixteenth byte. The order at the other bytes follows from it by the bytes
before, and in that order equal strings are neighbours.

Strings of ``reach`` bytes, longer ones, are found along with those of ``window``
bytes: equal ones begin with equal strings of ``window`` bytes, so they meet in the
same groups. Regions then go on for as many bytes as their longer strings have.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from fleetlake.llm.suffix_array import suffix_array
from fleetlake.llm.tables import partitions, spread_join, stored, whole_groups
from fleetlake.llm.words import rows_in_pieces

WINDOW, GRAM = 400, 150
SYMBOL = 16
# Different regions of one gram that are compared in one group; more are split.
GROUP = 1024
_SEGMENT = 1 << 20  # strings of a text that are looked at in one go


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number per byte; the powers of an odd base, and of its inverse modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    values = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))
    factors = []
    for b in (base, pow(base, -1, 1 << 64)):
        line = np.full(n, b, np.uint64)
        line[0] = 1
        factors.append(np.multiply.accumulate(line))
    return values, *factors


def anchors(text: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(first start, number of starts, anchor's place, hash of its gram) of each region.

    The regions' starts are all starts of strings of ``window`` bytes, in order.
    """
    starts = len(text) - window + 1
    values, power, inverse = _powers(_SEGMENT + 2 * window)
    sums = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(values[text] * power[: len(text)], out=sums[1:])
    grams = len(text) - gram + 1
    least = _mix((sums[gram:] - sums[:-gram]) * inverse[:grams])
    place = np.arange(grams, dtype=np.int32)
    # least hash and its leftmost place among 1, 2, 4, ... grams, then among a string's
    among, width = window - gram + 1, 1
    hashes = least
    while width < among:
        step = min(width, among - width)
        lower = least[step:] < least[:-step]
        place = np.where(lower, place[step:], place[:-step])
        least = np.minimum(least[step:], least[:-step])
        width += step
    first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
    count = np.diff(np.append(first, starts))
    at = place[first]
    return first, count, at, hashes[at]


_REGION = "g long, r long, u1 long, u2 int, n long, base int, starts int, at int, less int"


def regions(rows: DataFrame, window: int, gram: int, reach: int) -> DataFrame:
    """All regions of rows (u1, u2, n, text as bytes): grams, digests and places.

    n is the number of equal rows that a row stands for. g is the gram's hash and r the region's; base is the first start, ``at`` the
    anchor's distance from it. A region's bytes are those of its strings of ``reach``
    bytes; ``less`` is the number of bytes that its text is too short for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in_pieces(batches, 128):
            parts: list[list[np.ndarray]] = [[] for _ in range(7)]
            for i, text in enumerate(batch.column("text")):
                raw = text.as_buffer()
                whole = np.frombuffer(raw, np.uint8)
                for k in range(0, len(whole) - window + 1, _SEGMENT):
                    part = whole[k : k + _SEGMENT + reach - 1]
                    first, count, at, hashes = anchors(part[: _SEGMENT + window - 1], window, gram)
                    ends = first + count + reach - 1
                    digests = [
                        xxh3_64_intdigest(part[a:b])
                        for a, b in zip(first.tolist(), ends.tolist(), strict=True)
                    ]
                    # as many bytes may be of more starts where a text ends
                    r = np.array(digests, np.uint64) ^ _mix(count.astype(np.uint64))
                    less = np.maximum(ends - len(part), 0)
                    found = hashes, r, first + k, count, at - first, less
                    for values, one in zip(parts, (*found, np.full(len(first), i)), strict=True):
                        values.append(one)
            if not parts[0]:
                continue
            g, r, base, starts, at, less, row = (np.concatenate(p) for p in parts)
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(g.view(np.int64)),
                    pa.array(r.view(np.int64)),
                    batch.column("u1").take(row),
                    batch.column("u2").take(row),
                    batch.column("n").take(row),
                    *(pa.array(x.astype(np.int32)) for x in (base, starts, at, less)),
                ],
                ["g", "r", "u1", "u2", "n", "base", "starts", "at", "less"],
            )

    return rows.select("u1", "u2", "n", "text").mapInArrow(run, _REGION)


def equal_neighbours(
    texts: list[bytes], at: np.ndarray, starts: np.ndarray, lengths: tuple[int, ...]
) -> list[np.ndarray]:
    """For each length of strings: whether the string at each start occurs more than once.

    All starts have strings of the first length, but may be too near a text's end for others.

    Texts are joined so that anchors fall on symbols; a suffix array orders what
    starts at symbols. What starts t bytes before one is ordered by those bytes
    and then by the symbol's suffix. Neighbours are compared byte by byte.
    """
    front = (-at) % SYMBOL
    sizes = np.array([len(t) for t in texts])
    padded = -(-(front + sizes) // SYMBOL) * SYMBOL
    offset = np.concatenate(([0], np.cumsum(padded)[:-1]))
    joined = np.zeros(int(padded.sum()) + 2 * SYMBOL, np.uint8)
    for t, o in zip(texts, (offset + front).tolist(), strict=True):
        joined[o : o + len(t)] = np.frombuffer(t, np.uint8)
    n = int(padded.sum())
    high, low = np.ascontiguousarray(joined[:n]).view(">u8").reshape(-1, 2).astype(np.uint64).T
    order = np.lexsort((low, high))
    new = (high[order][1:] != high[order][:-1]) | (low[order][1:] != low[order][:-1])
    symbols = np.empty(len(order), np.int64)
    symbols[order] = np.concatenate(([0], np.cumsum(new)))
    rank = np.empty(len(symbols) + 2, np.int64)
    rank[suffix_array(symbols)] = np.arange(len(symbols))
    rank[len(symbols) :] = -1

    word = np.zeros(n + SYMBOL, np.uint64)  # the eight bytes from each place on
    for j in range(8):
        word = word << np.uint64(8) | joined[j : j + n + SYMBOL]
    inside = np.arange(int(starts.sum())) - np.repeat(np.cumsum(starts) - starts, starts)
    places = np.repeat(offset + front, starts) + inside
    rest = np.repeat(sizes, starts) - inside
    twice = [np.zeros(len(places), bool) for _ in lengths]
    for t in range(SYMBOL):
        some = np.flatnonzero((-places) % SYMBOL == t)
        here = places[some]
        # the t bytes before the symbol, as two numbers
        first = word[here] >> np.uint64(8 * (8 - t)) if 0 < t < 8 else word[here] * np.uint64(t > 0)
        second = (
            word[here + 8] >> np.uint64(8 * (16 - t)) if t > 8 else np.zeros(len(here), np.uint64)
        )
        ordered = some[np.lexsort((rank[(here + t) // SYMBOL], second, first))]
        for length, marks in zip(lengths, twice, strict=True):
            ordered = ordered[rest[ordered] >= length]
            a, b = places[ordered[:-1]], places[ordered[1:]]
            alive = np.arange(len(a))
            for j in [*range(length - 8, 0, -8), 0]:
                if not len(alive):
                    break
                alive = alive[word[a[alive] + j] == word[b[alive] + j]]
            marks[ordered[alive]] = True
            marks[ordered[alive + 1]] = True
    return twice


_RANGE = "u1 long, u2 int, low int, high int, far int"


def _compare(window: int, reach: int, most_bytes: int = 2_000_000):
    """Repeated strings of single regions, by groups: (u1, u2, low, high, far) as byte places."""
    lengths = (window, reach) if reach > window else (window,)

    def of(table: pa.Table) -> Iterator[list[np.ndarray]]:
        columns = {c: table.column(c).to_numpy() for c in ("u1", "u2", "base", "at", "n")}
        texts = table.column("bytes").to_pylist()
        starts = table.column("starts").to_numpy().astype(np.int64)
        found = equal_neighbours(texts, columns["at"].astype(np.int64), starts, lengths)
        region = np.repeat(np.arange(len(texts)), starts)
        inside = np.arange(len(region)) - np.repeat(np.cumsum(starts) - starts, starts)
        for length, twice in zip(lengths, found, strict=True):
            some = np.flatnonzero(twice & (columns["n"][region] == 1))
            if not len(some):
                continue
            run = np.concatenate(([True], (np.diff(some) != 1) | (np.diff(region[some]) != 0)))
            begin = some[run]
            last = some[np.concatenate((run[1:], [True]))]
            of_region = region[begin]
            low = columns["base"][of_region] + inside[begin]
            high = columns["base"][of_region] + inside[last] + length
            far = high if length == reach else np.zeros_like(high)
            yield [columns["u1"][of_region], columns["u2"][of_region], low, high, far]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in whole_groups(batches, "g"):
            groups = chunk.column("g").to_numpy()
            firsts = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
            sizes = np.cumsum(np.array([len(b) for b in chunk.column("bytes").to_pylist()]))
            # cut between groups, so that a suffix array has about so many bytes
            portion = sizes[firsts] // most_bytes
            cuts = [*firsts[np.concatenate(([True], portion[1:] != portion[:-1]))], len(groups)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                for u1, u2, *places in of(chunk.slice(a, b - a)):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(u1),
                            pa.array(u2),
                            *(pa.array(x.astype(np.int32)) for x in places),
                        ],
                        ["u1", "u2", "low", "high", "far"],
                    )

    return run


def _split(rows: DataFrame, window: int, reach: int) -> DataFrame:
    """Regions of large groups in two halves, by the distance of the string's start to the anchor.

    A half's key is of all bytes that its strings have in common, which are
    more than before, so that groups fall apart. Strings of ``window`` and of
    ``reach`` bytes part at the first cut (w is 0 before it), as those share more.
    """
    both, only = f"array({window}, {reach})", f"array({window})"
    some = f"IF(octet_length(bytes) >= {reach}, {both}, {only})" if reach > window else only
    rows = rows.withColumn("length", F.explode(F.expr(f"IF(w > 0, array(w), {some})")))
    short = f"substring(bytes, 1, starts + {window - 1})"
    cut_short = F.expr(f"IF(w = 0 AND length = {window}, {short}, bytes)")
    rows = rows.withColumn("bytes", cut_short)
    rows = rows.drop("w").withColumnRenamed("length", "w")
    middle = F.expr("int((x + y) / 2)")
    halves = F.array(
        F.struct(F.col("x").alias("x"), middle.alias("y")),
        F.struct((middle + 1).alias("x"), F.col("y").alias("y")),
    )
    cut = (
        rows.withColumn("starts", F.expr("octet_length(bytes) - w + 1"))
        .withColumn("half", F.explode(halves))
        .select("*", F.col("half.x").alias("_x"), F.col("half.y").alias("_y"))
        .withColumn("far", F.least("at", "_y"))
        .withColumn("near", F.greatest(F.expr("at - starts + 1"), F.col("_x")))
        .where("near <= far")
    )
    part = F.expr("substring(bytes, at - far + 1, far - near + w)")
    common = F.expr("substring(bytes, at - _x + 1, w - (_y - _x))")
    return cut.select(
        F.xxhash64("g", "w", "_x", "_y", common).alias("g"),
        F.xxhash64(part, "far").alias("r"),
        "u1",
        "u2",
        F.expr("base + at - far").alias("base"),
        F.expr("far - near + 1").alias("starts"),
        F.col("far").alias("at"),
        F.col("_x").alias("x"),
        F.col("_y").alias("y"),
        "w",
        "n",
        part.alias("bytes"),
    )


def _once_each(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Different regions of each gram, with how many there are; where one of them begins."""
    return rows.groupBy("g", "r").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("weight"),
        F.min(F.struct("u1", "u2", "base")).alias("one"),
        *(F.first(c).alias(c) for c in columns),
    ).select("g", "r", "n", "weight", "one.*", *columns)


def _kinds(different: DataFrame) -> DataFrame:
    """Grams of several different regions, of which one or more occur once."""
    return (
        different.groupBy("g")
        .agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
        .where("kinds > 1 AND least = 1")
        .select("g", "kinds")
    )


def _whole(window: int, reach: int) -> list[Column | str]:
    """The range of a region all of whose strings are repeated."""
    high = F.expr(f"base + starts + {window - 1}")
    far = F.expr(f"IF(starts > less, base + starts + {reach - 1} - less, 0)")
    return ["u1", "u2", F.col("base").alias("low"), high.alias("high"), far.alias("far")]


def repeats(
    texts: DataFrame, window: int = WINDOW, gram: int = GRAM, reach: int | None = None
) -> DataFrame:
    """(u1, u2, low, high, far): byte ranges made up of strings that also start elsewhere.

    From low to high these are strings of ``window`` bytes, from low to far strings of
    ``reach`` bytes (``window`` if not given; far is 0 where there are none).

    ``texts`` has u1, u2 (together the row's name, of one row only), n (the number
    of equal rows that the row stands for) and text as bytes. Ranges of a row may
    overlap. Equal regions are aggregated before they meet, so copies
    cost no comparison. Groups of over GROUP different regions are split by what
    else their strings have in common, level by level, until they are smaller.
    """
    reach = reach or window
    whole_range = _whole(window, reach)
    parts = partitions(texts.sparkSession)
    found = stored(regions(texts, window, gram, reach))
    grams = stored(
        found.groupBy("g")
        .agg(
            F.count("*").alias("weight"),
            F.sum("n").alias("n"),
            (F.min("r") != F.max("r")).alias("mixed"),
        )
        .where("n > 1")
        .drop("n")
    )
    shared = stored(spread_join(found, grams, ["g"], "weight"))
    ranges = [shared.where("NOT mixed").select(*whole_range)]

    mixed = shared.where("mixed").drop("mixed")
    different = stored(_once_each(mixed, ["starts", "at"]))
    several = different.where("n > 1").select("g", "r", "weight")
    ranges.append(spread_join(mixed, several, ["g", "r"], "weight").select(*whole_range))
    kinds = stored(_kinds(different))
    wanted = spread_join(different.drop("weight"), kinds, ["g"], "kinds")
    names = texts.select("u1", "u2", "text")
    cut = F.expr(f"substring(text, base + 1, starts + {reach - 1})")
    place = ["u1", "u2", "base", "starts", "at"]
    fixed = {"x": 0, "y": window - gram, "w": 0}
    columns = ["g", "r", *place, *(F.lit(v).alias(c) for c, v in fixed.items()), "n"]
    cut_out = names.join(wanted.hint("shuffle_hash"), ["u1", "u2"])
    rows = stored(cut_out.select(*columns, cut.alias("bytes")))
    while True:
        kinds = stored(_kinds(rows).withColumn("weight", F.col("kinds")))
        grouped = spread_join(rows, kinds, ["g"], "weight")
        small = grouped.where(F.col("kinds") <= GROUP).drop("kinds")
        dealt = small.repartition(parts, "g").sortWithinPartitions("g")
        ranges.append(dealt.mapInArrow(_compare(window, reach), _RANGE))
        if kinds.where(F.col("kinds") > GROUP).isEmpty():
            break
        large = grouped.where(F.col("kinds") > GROUP).drop("kinds")
        halves = stored(_split(large, window, reach))
        different = stored(_once_each(halves, ["starts", "at", "x", "y", "w", "bytes"]))
        several = different.where("n > 1").select("g", "r", "weight")
        ends = spread_join(halves.where("n = 1"), several, ["g", "r"], "weight")
        high = F.expr("base + octet_length(bytes)")
        far = F.expr(f"IF(octet_length(bytes) >= {reach}, base + octet_length(bytes), 0)")
        low = F.col("base").alias("low")
        ranges.append(ends.select("u1", "u2", low, high.alias("high"), far.alias("far")))
        rows = different.drop("weight")
    whole = ranges[0]
    for more in ranges[1:]:
        whole = whole.unionByName(more)
    return whole


def merged(lows: list[int], highs: list[int]) -> list[tuple[int, int]]:
    """Ranges that overlap or touch, as one each."""
    runs: list[tuple[int, int]] = []
    for low, high in sorted(zip(lows, highs, strict=True)):
        if runs and low <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(high, runs[-1][1])
        else:
            runs.append((low, high))
    return runs


def without(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(high for _, high in runs)]
    return b"".join(text[a:b] for a, b in zip(ends, [*(low for low, _ in runs), len(text)]))


def _copied(rows: DataFrame, window: int) -> DataFrame:
    """(u1, u2, n): names that several rows share, and their number."""
    long = rows.where(F.octet_length("text") >= window)
    return long.groupBy("u1", "u2").agg(F.count("*").alias("n")).where("n > 1")


def _one_each(rows: DataFrame, copied: DataFrame, window: int) -> DataFrame:
    """(u1, u2, n, text): one row of each name with as many bytes as a string, and its number.

    Only rows of copied names are shuffled, after each task has kept one of each.
    """
    long = rows.select("u1", "u2", "text").where(F.octet_length("text") >= window)
    single = long.join(copied, ["u1", "u2"], "left_anti").withColumn("n", F.lit(1).cast("long"))
    firsts = (
        long.join(copied, ["u1", "u2"])
        .groupBy("u1", "u2")
        .agg(F.first("n").alias("n"), F.first("text").alias("text"))
    )
    return single.unionByName(stored(firsts))


def _with_ranges(
    docs: DataFrame, key: str, text: str, window: int, gram: int, reach: int | None = None
) -> DataFrame:
    """All columns of ``docs`` in a struct, its text as bytes, and its ranges (null: none).

    Rows are named by two hashes of key and text; equal rows share a name, and
    with it their ranges, which are found once. A name that many rows share is
    broadcast, so that no task holds all of its rows.
    """
    if window % 8 or not 0 < gram < window:
        raise ValueError(f"window {window} must be a multiple of 8 and longer than gram {gram}")
    if reach is not None and (reach % 8 or reach < window):
        raise ValueError(f"reach {reach} must be a multiple of 8 and at least window {window}")
    rows = docs.select(
        F.struct("*").alias("row"),
        F.xxhash64(key, text).alias("u1"),
        F.hash(text, key).alias("u2"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    copied = stored(_copied(rows, window))
    found = stored(repeats(_one_each(rows, copied, window), window, gram, reach))
    ranges = found.groupBy("u1", "u2").agg(
        F.collect_set(F.struct("low", "high", "far")).alias("ranges")
    )
    counted = ranges.join(copied, ["u1", "u2"], "left").withColumn(
        "n", F.coalesce("n", F.lit(1))
    )
    # ranges go into each task's hash table, texts are not sorted
    return spread_join(rows, stored(counted), ["u1", "u2"], "n", "left", "shuffle_hash")


def suffix_dedup(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    key: str = "doc_id",
    text: str = "text",
    passages: int | None = None,
    words: int = 50,
) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of every row.

    A byte is removed if it is covered by a string of ``window`` bytes that also
    starts anywhere else, in the same row or another one; overlapping strings
    count, and all are judged on the input. A null text counts as empty. Equal
    rows and rows of one key are rows of their own. An empty table gives an
    empty one; other columns are not looked at. ``window`` is a multiple of 8
    and longer than ``gram``; others are refused.

    With ``passages``, the length of shorter strings (longer than ``gram``, a multiple of
    8), n_passages and passage_bytes follow: the number and bytes of maximal runs of such
    strings that also start elsewhere, of those with ``words`` words or more, parts of
    words at their ends included. These runs are not removed.
    """
    shorter = passages or window
    joined = _with_ranges(docs.select(key, text), key, text, shorter, gram, window)
    slim = joined.select(
        F.col(f"row.{key}").alias("key"), "text", "ranges.low", "ranges.high", "ranges.far"
    )
    more = ["n_passages", "passage_bytes"] if passages else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in_pieces(batches):
            sizes, removed, spans, digests, found = [], [], [], [], []
            columns = (batch.column(c).to_pylist() for c in ("text", "low", "high", "far"))
            for value, low, high, far in zip(*columns, strict=True):
                whole = [(a, b) for a, b in zip(low or [], far or [], strict=True) if b]
                runs = merged(*zip(*whole, strict=True)) if whole else []
                sizes.append(len(value))
                removed.append(sum(b - a for a, b in runs))
                spans.append(len(runs))
                digests.append(sha256(without(value, runs)).hexdigest())
                found.append(long_enough(value, merged(low, high), words) if more and low else [])
            numbers = (pa.array(x, pa.int64()) for x in (sizes, removed, spans))
            counts = [len(x) for x in found], [sum(b - a for a, b in x) for x in found]
            further = [pa.array(x, pa.int64()) for x in counts[: len(more)]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), *numbers, pa.array(digests, pa.string()), *further],
                ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", *more],
            )

    kind = slim.schema["key"].dataType.simpleString()
    schema = f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += "".join(f", {c} long" for c in more)
    return slim.mapInArrow(run, schema).withColumnRenamed("key", key)


def long_enough(text: bytes, runs: list[tuple[int, int]], words: int) -> list[tuple[int, int]]:
    """The ranges with ``words`` words or more, parts of words at their ends included."""
    return [(a, b) for a, b in runs if not words or len(text[a:b].split()) >= words]


def keep_unique(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    key: str = "doc_id",
    text: str = "text",
    words: int = 0,
) -> DataFrame:
    """The rows of ``docs`` with repeated strings removed from their texts; see ``suffix_dedup``.

    Of the repeated runs, those of fewer than ``words`` words stay. Where a range cuts a character in two, what is left of it goes too. Rows
    whose text is nothing but repeats stay, with an empty text; nulls stay null.
    """

    @F.pandas_udf("string")
    def clean(texts: pd.Series, lows: pd.Series, highs: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None
                if t is None
                else without(t, long_enough(t, merged(list(low), list(high)), words)).decode(
                    errors="ignore"
                )
                for t, low, high in zip(texts, lows, highs, strict=True)
            ],
            dtype="object",
        )

    joined = _with_ranges(docs, key, text, window, gram)
    has = F.col("ranges").isNotNull()
    # a function in Python sees every row, so texts that stay are not given to it
    cleaned = clean(F.when(has, F.col("text")), F.col("ranges.low"), F.col("ranges.high"))
    changed = F.when(has, cleaned).otherwise(F.col(f"row.{text}"))
    return joined.select(
        *(changed.alias(c) if c == text else F.col(f"row.{c}") for c in docs.columns)
    )
