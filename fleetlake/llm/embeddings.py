"""Near-duplicate vectors: binary codes by iterative quantisation, Hamming tables, exact cosines.

A rotation of the principal axes is learned so that signs lose little of the
vectors. The bits of a code are cut into substrings, one table each; vectors
meet in a table if their substrings differ by a few bits. Who meets is compared
by the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import acos, ceil, comb, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.components import components
from fleetlake.llm.tables import Forest, partitions, spread_join, stored, whole_groups

BITS = 64
SAMPLE = 8192  # vectors that the rotations are learned on, at most
LIST = 32  # vectors of the largest label that a list holds on average, by choice of the tables
BLOCK = 1024  # rows of a list that are compared in one go; longer lists are cut into blocks
RECALL = 0.95  # expected for a pair that is just similar enough, if bits differ independently


@dataclass(frozen=True)
class Tables:
    """Substrings of ``width`` bits, searched within ``radius`` bits."""

    width: int
    radius: int

    @property
    def count(self) -> int:
        return BITS // self.width

    def probes(self) -> list[int]:
        """What a substring is changed by, to search around it."""
        return [
            sum(1 << i for i in flipped)
            for r in range(self.radius + 1)
            for flipped in combinations(range(self.width), r)
        ]


def plan(most: int, cosine: float) -> Tables:
    """Tables for labels of up to ``most`` vectors: longer substrings for more, then a radius.

    A bit of the code differs with probability angle / pi.
    """
    width = min(16, max(8, ceil(log2(max(2, most / LIST)))))
    flip = acos(max(-1.0, min(1.0, cosine))) / pi
    for radius in range(width + 1):
        meet = sum(
            comb(width, k) * flip**k * (1 - flip) ** (width - k) for k in range(radius + 1)
        )
        if 1 - (1 - meet) ** (BITS // width) >= RECALL:
            break
    return Tables(width, radius)


def quantiser(sample: np.ndarray, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """A centre and a matrix whose products' signs are the code.

    Principal axes are rotated so that they are as near as can be to their signs:
    signs and rotation are fitted to each other in turns. Vectors of fewer than
    64 numbers get several rotations from different starts.
    """
    dim = sample.shape[1]
    centre = sample.mean(axis=0)
    moved = sample - centre
    _, axes = np.linalg.eigh(moved.T @ moved)
    axes = axes[:, ::-1][:, :BITS]
    shrunk = moved @ axes
    rng = np.random.default_rng(0)
    parts = []
    for _ in range(ceil(BITS / min(dim, BITS))):
        rotation, _ = np.linalg.qr(rng.standard_normal((axes.shape[1], axes.shape[1])))
        for _ in range(steps):
            signs = np.where(shrunk @ rotation >= 0, 1.0, -1.0)
            u, _, v = np.linalg.svd(signs.T @ shrunk)
            rotation = (u @ v).T
        parts.append(axes @ rotation)
    return centre, np.hstack(parts)[:, :BITS]


def _unit(vectors: np.ndarray) -> np.ndarray:
    # first by the largest number, so that squares neither overflow nor vanish
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _learn(classes: DataFrame, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """A quantiser for each length of vectors in a bounded sample by hash."""
    chosen = classes.select("vector").orderBy(F.xxhash64("vector")).limit(sample).toArrow()
    column = chosen.column("vector").combine_chunks()
    lengths = np.array([len(v) for v in column], np.int64)
    return {
        int(n): quantiser(_unit(_matrix(column.take(pa.array(np.flatnonzero(lengths == n))))))
        for n in np.unique(lengths)
    }


def _coded(classes: DataFrame, learned: dict) -> DataFrame:
    """Classes with the unit vector and the code; lengths not in the sample have code zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
        for batch in batches:
            lengths = np.array([len(v) for v in batch.column("vector")])
            for n in np.unique(lengths):
                part = batch.take(pa.array(np.flatnonzero(lengths == n)))
                unit = _unit(_matrix(part.column("vector")).astype(np.float64))
                code = np.zeros(len(unit), np.uint64)
                if int(n) in learned:
                    centre, matrix = learned[int(n)]
                    code = ((unit - centre) @ matrix >= 0) @ weights
                flat = pa.array(unit.ravel())
                ends = pa.array(np.arange(0, unit.size + 1, n, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("class"),
                        part.column("label"),
                        part.column("n"),
                        pa.array(code.view(np.int64)),
                        pa.ListArray.from_arrays(ends, flat),
                    ],
                    ["class", "label", "n", "code", "unit"],
                )

    kind = classes.schema["label"].dataType.simpleString()
    return classes.select("class", "label", "n", "vector").mapInArrow(
        run, f"class long, label {kind}, n long, code long, unit array<double>"
    )


def _compare(cosine: float, tables: Tables):
    """Links of probing rows to indexed ones in each group: counts, and a forest of links."""
    mask = np.uint64((1 << tables.width) - 1)

    def met_before(differ: np.ndarray, table: int) -> np.ndarray:
        """Whether a pair has met in an earlier table."""
        met = np.zeros(differ.shape, bool)
        for t in range(table):
            part = (differ >> np.uint64(t * tables.width)) & mask
            met |= np.bitwise_count(part) <= tables.radius
        return met

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in whole_groups(batches, "group"):
            groups = chunk.column("group").to_numpy()
            names, weight = chunk.column("class").to_numpy(), chunk.column("n").to_numpy()
            codes = chunk.column("code").to_numpy().view(np.uint64)
            number = chunk.column("number").to_numpy()
            probing = chunk.column("probing").to_numpy(zero_copy_only=False)
            indexed = chunk.column("indexed").to_numpy(zero_copy_only=False)
            unit = chunk.column("unit").combine_chunks()
            forest, links = Forest(len(names)), np.zeros(len(names), np.int64)
            starts = np.flatnonzero(np.concatenate(([True], groups[1:] != groups[:-1])))
            for a, b in zip(starts, [*starts[1:], len(groups)], strict=True):
                if b - a < 2:
                    continue
                vectors = _matrix(unit.slice(a, b - a))
                rows = a + np.flatnonzero(probing[a:b])
                columns = a + np.flatnonzero(indexed[a:b])
                if not len(columns):
                    continue
                for k in range(0, len(rows), BLOCK):
                    some = rows[k : k + BLOCK]
                    alike = vectors[some - a] @ vectors[columns - a].T >= cosine
                    i, j = np.nonzero(alike)
                    i, j = some[i], columns[j]
                    new = (names[i] != names[j]) & ~met_before(codes[i] ^ codes[j], number[a])
                    i, j = i[new], j[new]
                    more = np.bincount(i, weights=weight[j], minlength=len(links))
                    links += more.astype(np.int64)
                    forest.link(i, j)
            node, to = forest.links()
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((names[node], names[some]))),
                    pa.array([*names[to].tolist(), *[None] * len(some)], pa.int64()),
                    pa.array([*[None] * len(node), *links[some].tolist()], pa.int64()),
                ],
                ["node", "to", "links"],
            )

    return run


def _met(coded: DataFrame, tables: Tables, cosine: float) -> DataFrame:
    """(node, to, links): per group, a forest of links, and the links of each class.

    A list is a label, a length, a table and a substring. Every class is indexed
    in its own list of each table and probes the lists around it. A list of over
    BLOCK rows is cut into blocks by hash, and each block of probing rows meets
    each block of indexed rows in a group of its own.
    """
    width = tables.width
    listed = coded.select(
        "*",
        F.posexplode(
            F.array(
                *(
                    F.shiftrightunsigned("code", t * width).bitwiseAND(F.lit((1 << width) - 1))
                    for t in range(tables.count)
                )
            )
        ).alias("number", "own"),
    ).withColumn("probe", F.explode(F.lit(tables.probes())))
    named = listed.withColumn(
        "list",
        F.xxhash64("label", F.size("unit"), "number", F.col("own").bitwiseXOR(F.col("probe"))),
    ).withColumn("indexed", F.col("probe") == 0)
    long = stored(named.groupBy("list").count().where(F.col("count") > BLOCK))
    columns = ["list", "number", "class", "n", "code", "unit", "indexed"]
    short = named.select(*columns).join(long, "list", "left_anti").select(
        F.col("list").alias("group"), *columns[1:], F.lit(True).alias("probing")
    )
    cut = (
        named.select(*columns)
        .join(long, "list")
        .withColumn("blocks", F.ceil(F.col("count") / (BLOCK // 2)).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    )
    probing = cut.select(
        F.xxhash64("list", "block", "other").alias("group"),
        *columns[1:-1],
        F.lit(False).alias("indexed"),
        F.lit(True).alias("probing"),
    )
    indexed = cut.where("indexed").select(
        F.xxhash64("list", "other", "block").alias("group"),
        *columns[1:],
        F.lit(False).alias("probing"),
    )
    parts = partitions(coded.sparkSession)

    def compare(rows: DataFrame) -> DataFrame:
        dealt = rows.repartition(parts, "group").sortWithinPartitions("group")
        return dealt.mapInArrow(_compare(cosine, tables), "node long, to long, links long")

    return compare(short).unionByName(compare(probing.unionByName(indexed)))


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.93,
    sample: int = SAMPLE,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """(key, n_links, component_id, kept) of every row.

    Rows link if their labels are equal and the cosine of their vectors, in
    double precision, is ``cosine`` or more; a pair that meets in no table is
    missed. Equal vectors of a label are one class: they are compared once,
    and link each other too. Rows without a label, and vectors that are null,
    empty, zero or hold null or non-finite numbers, link with nothing, and so do
    vectors of different lengths. The component is the smallest key reachable
    by links (null if all are null), and ``kept`` says whether it is the row's
    own. An empty table gives an empty one; other columns are not looked at.
    """
    numbers = F.col(vector).cast("array<double>")
    sound = (
        F.col(label).isNotNull()
        & numbers.isNotNull()
        & ~F.exists(
            numbers,
            lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
        )
        & F.exists(numbers, lambda x: x != 0)
    )
    # names have two independent hashes, as 64 bits alone could clash in very large tables
    rows = vectors.select(
        F.col(key).alias("key"),
        F.col(label).alias("label"),
        numbers.alias("vector"),
        F.coalesce(sound, F.lit(False)).alias("sound"),
        F.xxhash64(label, vector).alias("h1"),
        F.hash(vector, label).alias("h2"),
    )
    named = stored(rows.where("sound").select("key", "h1", "h2"))
    classes = stored(
        rows.where("sound")
        .groupBy("h1", "h2")
        .agg(
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
            F.min("key").alias("first"),
            F.count("*").alias("n"),
        )
        .withColumn("class", F.monotonically_increasing_id())
    )
    most = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    coded = stored(_coded(classes, _learn(classes, sample)))
    met = stored(_met(coded, plan(most, cosine), cosine))
    counts = met.where("to IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    reach = stored(components(met.where("to IS NOT NULL").select("node", "to")))
    lowest = (
        reach.join(classes.select(F.col("class").alias("node"), "first"), "node")
        .groupBy("component")
        .agg(F.min("first").alias("lowest"))
    )
    of_class = reach.join(lowest, "component").select(F.col("node").alias("class"), "lowest")
    answers = stored(
        classes.join(counts.withColumnRenamed("node", "class"), "class", "left")
        .join(of_class, "class", "left")
        .select(
            "h1",
            "h2",
            "n",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("lowest", "first").alias("component_id"),
        )
    )
    alone = rows.where(~F.col("sound")).select(
        "key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id")
    )
    found = spread_join(named, answers, ["h1", "h2"], "n").select("key", "n_links", "component_id")
    return found.unionByName(alone).select(
        F.col("key").alias(key),
        "n_links",
        "component_id",
        F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("kept"),
    )
