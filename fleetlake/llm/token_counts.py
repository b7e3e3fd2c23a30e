"""Token counts by byte-pair merging over a heap and a linked list, without making ids."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.bpe import Merges, load
from fleetlake.llm.words import Memo, lower_words, rows_in_pieces


def count_word(merges: Merges, word: str) -> int:
    """Initial symbols less merges.

    The heap holds (rank, place) of adjacent pairs; the list is ``after`` and
    ``before``. An entry whose pair has changed meanwhile is passed over.
    """
    ids = merges.symbols(word)
    n = len(ids)
    if n == 1:
        return 1
    pairs = merges.pairs
    heap = [
        (found[0], i)
        for i, found in enumerate(map(pairs.get, zip(ids, ids[1:], strict=False)))
        if found
    ]
    heapify(heap)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    left = n
    while heap:
        rank, i = heappop(heap)
        j = after[i]
        if j >= n or ids[i] < 0:
            continue
        found = pairs.get((ids[i], ids[j]))
        if found is None or found[0] != rank:
            continue
        ids[i], ids[j] = found[1], -1
        left -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if nxt := pairs.get((ids[i], ids[k])):
                heappush(heap, (nxt[0], i))
        h = before[i]
        if h >= 0 and (prev := pairs.get((ids[h], ids[i]))):
            heappush(heap, (prev[0], h))
    return left


@lru_cache(maxsize=2)
def counter(path: str):
    """A function from a text to its number of tokens; one memo per process."""
    merges = load(path)
    memo = Memo(lambda word: count_word(merges, word))
    split, special = lower_words(path), merges.special_pattern()

    def count(text: str) -> int:
        if special is None or "<" not in text or not special.search(text):
            return sum(map(memo.__getitem__, split(text)))
        parts = special.split(text)  # every second part is a special string
        return len(parts) // 2 + sum(
            sum(map(memo.__getitem__, split(part))) for part in parts[::2]
        )

    return count


def token_counts(
    docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: key, n_bytes, n_tokens and whether it has over ``limit`` tokens.

    A null text counts as empty: 0 bytes, 0 tokens. Null keys, repeated rows and
    other columns make no difference; an empty table gives an empty one. The
    work is done where the rows are read: nothing is shuffled.
    """
    slim = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        for batch in rows_in_pieces(batches):
            texts = batch.column("text").to_pylist()
            counts = pa.array([count(t) for t in texts], pa.int64())
            sizes = pc.binary_length(batch.column("text")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), sizes, counts], ["key", "n_bytes", "n_tokens"]
            )

    kind = slim.schema["key"].dataType.simpleString()
    counted = slim.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("key").alias(key),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
