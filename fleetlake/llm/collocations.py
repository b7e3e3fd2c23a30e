"""Phrases of two and three words that hold together, by best-first branch and bound.

Phrases grow word by word; no extension is more frequent than its prefix. A word
that is rare can begin no candidate, and any phrase that begins with a word of n
occurrences and a pair of m scores at most 1000000 * m / n, as the cut behind
the first word shows. So three-word phrases are counted from the best prefixes
on, until the survivors known to reach the limit are as many as are asked for.

Tasks count phrases in pieces of the corpus as integers, and shuffle one row per
different phrase of a piece. Which prefixes are grown is told to them by a
bitmap of hashes, of a fixed size whatever the data: other phrases that fall on
its bits are counted in vain, and none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from fleetlake.llm.tables import partitions, spread_join, stored
from fleetlake.llm.words import rows_in_pieces

MOST = 2000  # phrases per language
LEAST = 10  # occurrences of a candidate
SHARE = 50  # percent of a candidate's occurrences that a longer one must have to take its place
SCALE = 1_000_000
BITS = 25  # places of a bitmap, as a power of two
_TOKENS = 1_500_000  # words that a task counts at once; with a block's more, below 2**21
_BLOCK = 1 << 20  # bytes that are split at once

_END = b"."
_SIGNS = bytes.maketrans(
    bytes(range(ord("A"), ord("Z") + 1)) + b",;:!?\n\x0b\x0c\r\t",
    bytes(range(ord("a"), ord("z") + 1)) + _END * 9 + b" ",
)


class _Numbers(dict):
    """Words numbered as they come; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_END: 0})

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _blocks(text: bytes) -> Iterator[list[bytes]]:
    """The lower-cased words of a text and the ends of its pieces, a block at a time."""
    text = text.translate(_SIGNS).replace(_END, b" . ")
    start = 0
    while start < len(text):
        cut = text.find(b" ", start + _BLOCK) if len(text) - start > _BLOCK else -1
        cut = len(text) if cut < 0 else cut
        yield text[start:cut].split()
        start = cut


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _hash_words(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxh3_64_intdigest(lang.encode())
    return np.array([xxh3_64_intdigest(w, seed) for w in words], np.uint64)


def _hash_pairs(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _spread(first * np.uint64(0x9E3779B97F4A7C15) + _spread(second))


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap(phrases: DataFrame, bits: int = BITS) -> np.ndarray:
    """The hashes of (lang, phrase) rows of one or two words, as a bitmap of 2**bits places.

    What the driver fetches is the bitmap itself, at most 2**bits / 64 words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in_pieces(batches, 4096):
            places = []
            langs, texts = batch.column("lang").to_pylist(), batch.column("phrase").to_pylist()
            for lang in set(langs):
                split = [t.encode().split(b" ") for g, t in zip(langs, texts, strict=True) if g == lang]
                sides = [_hash_words(lang, list(side)) for side in zip(*split, strict=True)]
                hashes = sides[0] if len(sides) == 1 else _hash_pairs(*sides)
                places.append(hashes & np.uint64((1 << bits) - 1))
            place = np.concatenate(places).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(place)], ["place"])

    places = phrases.select("lang", "phrase").mapInArrow(run, "place long")
    words = (
        places.groupBy(F.expr("place div 64").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, int(place % 64))")).alias("marks"))
        .toArrow()
    )
    found = np.zeros(1 << (bits - 6), np.uint64)
    found[words.column("word").to_numpy()] = words.column("marks").to_numpy().view(np.uint64)
    return found


def _of_words(ids: np.ndarray, words: pa.Array, _lang: str, _names, _maps):
    """Every different word and its count, and without a word the number of all."""
    counts = np.bincount(ids, minlength=len(words))
    counts[0] = 0
    some = np.flatnonzero(counts)
    total = pa.array([None], pa.binary())
    phrases = pa.concat_arrays([words.take(pa.array(some)), total])
    return phrases, np.append(counts[some], counts.sum())


def _of_pairs(ids: np.ndarray, words: pa.Array, lang: str, names: list[bytes], maps):
    """Pairs of words that are both in the bitmap of words."""
    known = _has(maps[0], _hash_words(lang, names))
    known[0] = False
    both = known[ids]
    at = np.flatnonzero(both[:-1] & both[1:])
    codes, counts = np.unique(ids[at] * len(names) + ids[at + 1], return_counts=True)
    return _joined(words, codes // len(names), codes % len(names)), counts


def _of_triples(ids: np.ndarray, words: pa.Array, lang: str, names: list[bytes], maps):
    """Three words whose first two are in the first bitmap, or the last two in the second."""
    hashes = _hash_words(lang, names)[ids]
    pairs = _hash_pairs(hashes[:-1], hashes[1:])
    inside = ids != 0
    whole = inside[:-2] & inside[1:-1] & inside[2:]
    at = np.flatnonzero(whole & (_has(maps[0], pairs[:-1]) | _has(maps[1], pairs[1:])))
    size = len(names)
    codes, counts = np.unique(
        (ids[at] * size + ids[at + 1]) * size + ids[at + 2], return_counts=True
    )
    return _joined(words, codes // size**2, codes // size % size, codes % size), counts


def _joined(words: pa.Array, *sides: np.ndarray) -> pa.Array:
    return pc.binary_join_element_wise(*(words.take(pa.array(s)) for s in sides), pa.scalar(b" ", pa.binary()))


_LEVELS = (_of_words, _of_pairs, _of_triples)


def _counts(texts: DataFrame, length: int, maps: list[np.ndarray], least: int) -> DataFrame:
    """(lang, phrase, n): phrases of one length with ``least`` or more occurrences.

    Of one word, also each language's number of all words (phrase is null).
    """
    count = _LEVELS[length - 1]
    shared = texts.sparkSession.sparkContext.broadcast(maps)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, kept, size = _Numbers(), {}, 0

        def flush() -> Iterator[pa.RecordBatch]:
            names = list(numbers)
            words = pa.array(names, pa.binary())
            for lang, parts in kept.items():
                ids = np.concatenate(parts)
                phrases, n = count(ids, words, lang, names, shared.value)
                langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(n), np.int64)))
                columns = [langs, phrases.cast(pa.string()), pa.array(n.astype(np.int64))]
                yield from pa.Table.from_arrays(columns, ["lang", "phrase", "n"]).to_batches(50_000)

        for batch in rows_in_pieces(batches):
            langs = batch.column("lang").to_pylist()
            by_lang: dict[str, list[bytes]] = {}
            for lang, text in zip(langs, batch.column("text").to_pylist(), strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, some in by_lang.items():
                for words in _blocks(b".".join(some) + b"."):
                    if not words:
                        continue
                    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                    kept.setdefault(lang, []).append(ids)
                    size += len(ids)
                    if size >= _TOKENS:
                        yield from flush()
                        # a phrase may go on across the cut, so its last words are counted on
                        tail = _tail(kept[lang], list(numbers), length)
                        numbers, kept, size = _Numbers(), {}, 0
                        if tail:
                            again = np.array([numbers[w] for w in tail], np.int64)
                            kept[lang] = [again]
        if size:
            yield from flush()

    found = texts.mapInArrow(run, "lang string, phrase string, n long")
    summed = found.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
    return summed.where((F.col("n") >= least) | F.col("phrase").isNull())


def _tail(parts: list[np.ndarray], names: list[bytes], length: int) -> list[bytes]:
    """The last words of what was counted, one fewer than a phrase has, within their piece."""
    last = np.concatenate(parts[-2:])[-(length - 1) :].tolist() if length > 1 else []
    return [names[i] for i in last]


def _score(a: str, left: str, right: str) -> Column:
    """floor(scale * a * a / (left * right)), exact up to 10**15 occurrences."""
    wide = "cast({} as decimal(38,0))"
    above = f"{wide.format(SCALE)} * {wide.format(a)} * {wide.format(a)}"
    return F.expr(f"({above}) div ({wide.format(left)} * {wide.format(right)})")


def _word(place: int) -> Column:
    return F.split_part(F.col("phrase"), F.lit(" "), F.lit(place))


def _scored_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score, bound) of pairs; bound is of what begins with them."""
    table = words.where("phrase IS NOT NULL")
    for place, name in ((1, "l"), (2, "r")):
        side = table.select("lang", F.col("phrase").alias("word"), F.col("n").alias(name))
        pairs = stored(_by_word(pairs, side, place))
    return pairs.select(
        "*", _score("a", "l", "r").alias("score"), F.expr(f"(a * {SCALE}) div l").alias("bound")
    )


def _by_word(pairs: DataFrame, side: DataFrame, place: int) -> DataFrame:
    named = pairs.withColumn("word", _word(place))
    weights = named.groupBy("lang", "word").agg(F.count("*").alias("weight"))
    table = stored(side.join(weights, ["lang", "word"]))
    return spread_join(named, table, ["lang", "word"], "weight").drop("word")


def _best(rows: DataFrame, most: int) -> DataFrame:
    """Each language's first rows by score, occurrences and phrase, with their rank.

    The first ones of slices come first, so that no task sorts a whole language.
    """
    order = [F.desc("score"), F.desc("a"), "phrase"]
    slices = 4 * partitions(rows.sparkSession)
    dealt = rows.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    some = dealt.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "slice").orderBy(*order))
    ).where(F.col("rank") <= most)
    ranked = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return some.drop("slice").withColumn("rank", ranked).where(F.col("rank") <= most)


def _triples(texts: DataFrame, pairs: DataFrame, least: int, bits: int) -> DataFrame:
    """(lang, phrase, a, l, r, score, head, tail) of phrases that begin with a pair whose bound
    reaches its language's limit, or end with a pair whose score does."""
    maps = [bitmap(pairs.where("bound >= floor"), bits), bitmap(pairs.where("score >= floor"), bits)]
    counted = stored(
        _counts(texts, 3, maps, least)
        .withColumnRenamed("n", "a")
        .withColumn("head", F.substring_index("phrase", " ", 2))
        .withColumn("tail", F.substring_index("phrase", " ", -2))
    )
    # of a phrase with enough occurrences, both pairs have enough, too
    for name, columns in (("head", {"a": "p", "l": "f"}), ("tail", {"a": "q", "r": "g"})):
        kept = [F.col(a).alias(b) for a, b in columns.items()]
        weights = counted.groupBy("lang", name).agg(F.count("*").alias("weight"))
        side = pairs.select("lang", F.col("phrase").alias(name), *kept)
        table = stored(side.join(weights, ["lang", name]))
        counted = stored(spread_join(counted, table, ["lang", name], "weight"))
    cuts = counted.select("*", _score("a", "f", "q").alias("one"), _score("a", "p", "g").alias("two"))
    first = F.col("one") <= F.col("two")
    return cuts.select(
        "lang",
        "phrase",
        "a",
        F.when(first, F.col("f")).otherwise(F.col("p")).alias("l"),
        F.when(first, F.col("q")).otherwise(F.col("g")).alias("r"),
        F.least("one", "two").alias("score"),
        "head",
        "tail",
    )


def collocations(
    docs: DataFrame,
    most: int = MOST,
    least: int = LEAST,
    share: int = SHARE,
    text: str = "text",
    lang: str = "lang",
    bits: int = BITS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``most`` best phrases.

    A language is settled when the limit that its phrases were grown to has ``most``
    survivors or is 0; else the limit is lowered to the score of a pair four times
    as far down. A null language is ``und``, a null text is empty. Repeated rows
    count as often as they are there; ties go by occurrences, then by phrase
    in byte order. An empty table, or one without candidates, gives no rows; other
    columns are not looked at. Counts of pieces of texts are kept in a task for at most
    1.5 million words at a time, so texts may have any length.
    """
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    words = stored(_counts(texts, 1, [], least))
    frequent = bitmap(words.where("phrase IS NOT NULL"), bits)
    pairs = stored(_counts(texts, 2, [frequent], least).withColumnRenamed("n", "a"))
    pairs = stored(_scored_pairs(pairs, words))
    numbers = words.where("phrase IS NULL").select("lang", "n")

    depth = 2 * most
    settled: list[DataFrame] = []
    open_ = sorted(row["lang"] for row in pairs.select("lang").distinct().collect())
    while open_:
        left = pairs.where(F.col("lang").isin(open_))
        limits = _best(left, depth).groupBy("lang").agg(
            F.when(F.count("*") < depth, 0).otherwise(F.min("score")).alias("floor")
        )
        limits = stored(limits)  # a row per language
        with_limits = stored(left.join(limits, "lang"))
        triples = stored(_triples(texts.where(F.col("lang").isin(open_)), with_limits, least, bits))
        longest = (
            triples.select("lang", F.col("head").alias("phrase"), "a")
            .unionByName(triples.select("lang", F.col("tail").alias("phrase"), "a"))
            .groupBy("lang", "phrase")
            .agg(F.max("a").alias("longer"))
        )
        columns = ["lang", "phrase", "a", "l", "r", "score"]
        short = with_limits.where("score >= floor").select(*columns)
        short = short.join(longest, ["lang", "phrase"], "left").where(
            f"longer IS NULL OR 100 * longer < {share} * a"
        )
        long = triples.join(limits, "lang").where("score >= floor")
        survivors = stored(short.select(*columns).unionByName(long.select(*columns)))
        known = survivors.groupBy("lang").agg(F.count("*").alias("known"))
        rows = limits.join(known, "lang", "left").collect()  # a row per language
        done = [r["lang"] for r in rows if r["floor"] == 0 or (r["known"] or 0) >= most]
        settled.append(survivors.where(F.col("lang").isin(done)))
        open_ = sorted(set(open_) - set(done))
        depth *= 4
    if not settled:
        empty = pairs.select("lang", "phrase", "a", "l", "r", "score").limit(0)
        settled.append(empty)
    whole = settled[0]
    for more in settled[1:]:
        whole = whole.unionByName(more)
    return (
        _best(whole, most)
        .join(numbers, "lang")
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
