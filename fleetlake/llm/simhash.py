"""SimHash fingerprints, and near-duplicates by an index of positional bytes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_digest

from fleetlake.llm.components import components
from fleetlake.llm.tables import Forest, pairs_at, partitions, spread_join, stored, whole_groups
from fleetlake.llm.words import rows_in_pieces

BITS, BYTES = 64, 8
SEED = 42
# Rows of one posting list that are compared in one go; longer lists are cut into blocks.
BLOCK = 1024


def fingerprint(text: bytes, width: int) -> bytes:
    """The eight bytes of a text: a bit is set if over half the shingles' hashes have it."""
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII white-space bytes
    if not words:
        return bytes(BYTES)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    width = min(width, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist())
    hashes = b"".join([xxh64_digest(joined[a:b], SEED) for a, b in spans])
    # in slices, so that a very long text doesn't need 64 bytes for each of its shingles
    each = np.frombuffer(hashes, np.uint8).reshape(-1, BYTES)
    ones = np.zeros(BITS, np.int64)
    for k in range(0, len(each), 65536):
        ones += np.unpackbits(each[k : k + 65536], axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(each)).tobytes()


def fingerprints(docs: DataFrame, width: int, text: str = "text") -> DataFrame:
    """The other columns of ``docs`` and fp: the fingerprint as a signed 64-bit number.

    A null text counts as empty.
    """
    others = [c for c in docs.columns if c != text]
    slim = docs.select(*others, F.coalesce(F.col(text), F.lit("")).cast("binary").alias(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_in_pieces(batches):
            made = b"".join([fingerprint(t, width) for t in batch.column(text).to_pylist()])
            numbers = np.frombuffer(made, ">i8").astype(np.int64)
            columns = [batch.column(c) for c in others]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(numbers)], [*others, "fp"])

    return slim.mapInArrow(run, slim.select(*others, F.lit(0).cast("long").alias("fp")).schema)


def _lists(most: int) -> list[tuple[int, ...]]:
    """Groups of byte positions of which every near pair shares one.

    Fingerprints within ``most`` bits share BYTES - most positional bytes at
    least. The positions are cut into runs; whatever positions remain, so many
    of them are in one run as pigeons in holes, and its groups of that size are
    taken. For 3 bits: two runs of four, and the four triples of each.
    """
    shared = BYTES - most
    if shared < 1:
        raise ValueError(f"no positional byte is sure to be shared within {most} bits")
    best: list[tuple[int, ...]] = []
    for runs in range(1, BYTES + 1):
        cuts = [BYTES * i // runs for i in range(runs + 1)]
        size = -(-shared // runs)
        groups = [
            g
            for a, b in zip(cuts, cuts[1:], strict=False)
            for g in combinations(range(a, b), min(size, b - a))
        ]
        # longest lists' keys first, then fewer of them
        if not best or (min(size, 3), -len(groups)) > (min(len(best[0]), 3), -len(best)):
            best = groups
    return best


def _list_key(number: int, group: tuple[int, ...]) -> Column:
    """The key of a posting list: its number and the bytes at its positions."""
    key = F.lit(number).cast("long")
    for position in group:
        byte = F.shiftrightunsigned("fp", BITS - 8 * (position + 1)).bitwiseAND(F.lit(255))
        key = F.shiftleft(key, 8).bitwiseOR(byte.cast("long"))
    return key


def _near(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Count filter, then check: enough equal positional bytes, few differing bits."""
    differ = a ^ b
    tally = (differ.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
    near = tally >= BYTES - most
    near[near] = np.bitwise_count(differ[near]) <= most
    return near


def _link_lists(most: int):
    """Links within each group of rows, as a forest: at most one per fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "list"):
            keys = table.column("list").to_numpy()
            fps = table.column("fp").to_numpy().view(np.uint64)
            forest, lag = Forest(len(keys)), 0
            alive = np.arange(len(keys))
            while len(alive):
                lag += 1
                alive = pairs_at(keys, lag, alive)
                near = alive[_near(fps[alive], fps[alive + lag], most)]
                forest.link(near, near + lag)
            node, to = forest.links()
            signed = fps.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed[node]), pa.array(signed[to])], ["node", "to"]
            )

    return run


def _links(postings: DataFrame, columns: list[str], most: int) -> DataFrame:
    parts = partitions(postings.sparkSession)
    one = F.xxhash64(*columns).alias("list")
    sorted_ = postings.select(one, "fp").repartition(parts, "list").sortWithinPartitions("list")
    return sorted_.mapInArrow(_link_lists(most), "node long, to long")


def links(classes: DataFrame, most: int) -> DataFrame:
    """(node, to): links between different fingerprints (column fp) that connect what is near.

    Every pair within ``most`` bits is compared and counted as linked; what is
    returned is a forest per posting list with the same components. A list of
    over BLOCK fingerprints is cut into blocks by hash, and every two blocks are
    a group of their own, so no task holds a whole long list.
    """
    lists = [_list_key(i, g) for i, g in enumerate(_lists(most))]
    postings = classes.select("fp", F.explode(F.array(*lists)).alias("list"))
    sizes = stored(postings.groupBy("list").count().where(F.col("count") > BLOCK))
    short = _links(postings.join(sizes, "list", "left_anti"), ["list"], most)
    blocks = F.ceil(F.col("count") / (BLOCK // 2)).cast("int")
    long = postings.join(sizes, "list").select(
        "fp",
        "list",
        blocks.alias("blocks"),
        F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block"),
    )
    paired = long.select(
        "fp", "list", "block", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other")
    ).select(
        "fp",
        "list",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
    )
    return short.unionByName(_links(paired, ["list", "low", "high"], most))


def _firsts(rows: DataFrame, most: int) -> DataFrame:
    """(fp, n, first): per fingerprint, its rows and the least ``order`` that links can reach.

    Equal fingerprints are one class, which is compared once.
    """
    classes = stored(
        rows.groupBy("fp").agg(F.min("order").alias("first"), F.count("*").alias("n"))
    )
    reach = stored(components(stored(links(classes, most))))
    named = reach.join(classes.select(F.col("fp").alias("node"), "first"), "node")
    lowest = named.groupBy("component").agg(F.min("first").alias("lowest"))
    of_class = reach.join(lowest, "component").select(F.col("node").alias("fp"), "lowest")
    return stored(
        classes.join(of_class, "fp", "left").select(
            "fp", "n", F.coalesce("lowest", "first").alias("first")
        )
    )


def simhash_components(
    docs: DataFrame, width: int = 3, most: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, fingerprint, component_id) of every row.

    Fingerprints link at ``most`` or fewer differing bits; the component is the
    smallest key reachable by links. Texts without words (null and empty too)
    have fingerprint zero and link like any other. A null key never is a
    component's name unless all its keys are null. An empty table gives an empty
    one; other columns of ``docs`` are not looked at.
    """
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = stored(fingerprints(slim, width))
    order = F.struct(F.col("key").isNull().alias("none"), "key").alias("order")
    firsts = _firsts(rows.select("fp", order), most)
    answers = firsts.select("fp", "n", F.col("first.key").alias("component_id"))
    return spread_join(rows, answers, ["fp"], "n").select(
        F.col("key").alias(key),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_first(
    docs: DataFrame, width: int = 3, most: int = 3, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row of ``docs`` (all columns) of each component: that with the smallest key.

    Null keys come last; of rows with one key, one is taken by the hash of its
    text, and of rows that are equal in both, any one.
    """
    named = docs.select(
        F.struct("*").alias("row"),
        F.xxhash64(key, text).alias("u1"),
        F.hash(text, key).alias("u2"),
        F.col(key).alias("key"),
        F.col(text).alias("text"),
    )
    rows = stored(fingerprints(named.select("u1", "u2", "key", "text"), width))
    order = F.struct(F.col("key").isNull().alias("none"), "key", "u1", "u2").alias("order")
    firsts = _firsts(rows.select("fp", order), most)
    chosen = stored(firsts.select("first.u1", "first.u2").distinct())
    kept = named.join(chosen.hint("shuffle_hash"), ["u1", "u2"], "left_semi")
    again = rows.groupBy("u1", "u2").count().where("count > 1")
    if not again.isEmpty():
        kept = kept.dropDuplicates(["u1", "u2"])
    return kept.select("row.*")
