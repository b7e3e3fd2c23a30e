"""Shards of bounded size by extendible hashing, with DataFrame functions only.

A directory maps prefixes of a hash's bits to shards. A shard over the byte
limit is split on the next bit, and only such a shard: shards have prefixes of
different lengths, and every hash has exactly one shard.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.tables import stored

HASH_BITS = 60  # the first of an MD5 digest, at most 15 hex digits
SLACK_BITS = 4  # cells are so many bits finer than equal shards at the limit
STEP_BITS = 8  # further bits at once, for cells that are still over the limit


def hashed(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_md5, copy, n_bytes, hash) of every row.

    The hash is of the key, the text and the number of the copy, so that rows
    with one key, or even equal rows, part at some bit. An empty key is marked, as
    a null one has the same name. Equal rows are counted
    before they are numbered: no task numbers all copies of a row it has to hold.
    """
    name = F.coalesce(F.col(key).cast("string"), F.lit(""))
    value = F.coalesce(F.col(text), F.lit(""))
    slim = docs.select(
        F.col(key).alias("key"),
        name.alias("name"),
        F.md5(value.cast("binary")).alias("text_md5"),
        F.octet_length(value).cast("long").alias("n_bytes"),
    )
    copies = slim.groupBy("key", "name", "text_md5", "n_bytes").count()
    # all other names end with a number, and nulls are skipped
    mark = F.when(F.col("key").isNotNull() & (F.col("name") == ""), F.lit("empty"))
    digest = F.md5(F.concat_ws(":", "name", "text_md5", "copy", mark).cast("binary"))
    bits = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    return copies.withColumn("copy", F.explode(F.expr("sequence(1L, count)"))).select(
        "key",
        "text_md5",
        "copy",
        "n_bytes",
        F.shiftright(bits, 60 - HASH_BITS).alias("hash"),
    )


def _leaves(rows: DataFrame, limit: int, low: int, high: int) -> DataFrame:
    """For each cell of ``high`` bits: its shard's depth and sizes, null if it needs more bits.

    A cell's shard is the shortest of its prefixes, from ``low`` bits on, whose
    rows are within the limit (or one row, which can't be split). Rows that differ in
    no bit stay together.
    """
    cells = rows.groupBy(F.shiftright("hash", HASH_BITS - high).alias("cell")).agg(
        F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows")
    )
    above = cells.select("*", F.explode(F.lit(list(range(low, high + 1)))).alias("depth"))
    prefix = F.expr(f"shiftright(cell, {high} - depth)").alias("prefix")
    nodes = (
        above.groupBy("depth", prefix)
        .agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
        .where(
            (F.col("shard_bytes") <= limit)
            | (F.col("shard_rows") == 1)
            | (F.col("depth") == HASH_BITS)
        )
    )
    found = (
        above.select("cell", "depth", prefix)
        .join(nodes, ["depth", "prefix"])
        .groupBy("cell")
        .agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("shard"))
    )
    return cells.select("cell").join(found, "cell", "left")


def shards(
    docs: DataFrame, limit: int, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, text_md5, copy, n_bytes, depth, prefix, shard_bytes, shard_rows) of every row.

    A shard is a depth and the hash prefix of that many bits. Every shard's texts
    have ``limit`` bytes or fewer in UTF-8, unless it is a single longer text
    (null counts as empty), or rows whose hashes are equal in all bits: these are
    a shard of that depth, whose bytes show it. Repeated rows and keys, null keys and one key on most
    rows make no difference: hashes differ by text and copy. An empty table
    gives an empty one. The first round looks at as many bits as equal shards
    would need and four more; further rounds look at the rows of larger cells only.
    """
    rows = stored(hashed(docs, key, text))
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    low, high = 0, min(HASH_BITS, max(0, ceil(log2(max(1, total / limit)))) + SLACK_BITS)
    done, open_rows = None, rows
    while True:
        leaves = stored(_leaves(open_rows, limit, low, high))
        in_cells = open_rows.withColumn("cell", F.shiftright("hash", HASH_BITS - high))
        dealt = in_cells.join(leaves, "cell")
        part = dealt.where("shard IS NOT NULL").select(*rows.columns, "shard.*")
        done = part if done is None else done.unionByName(part)
        if leaves.where("shard IS NULL").isEmpty():
            break
        open_rows = stored(dealt.where("shard IS NULL").select(*rows.columns))
        low, high = high + 1, min(HASH_BITS, high + STEP_BITS)
    return done.drop("hash").withColumnRenamed("key", key)


def write_shards(
    docs: DataFrame, path: str, limit: int, key: str = "doc_id", text: str = "text"
) -> None:
    """Write the key and text of every row, one directory per shard, as Parquet."""
    value = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(
        F.col(key).alias("_key"), value.alias(text), F.md5(value.cast("binary")).alias("_md5")
    ).dropDuplicates(["_key", "_md5"])
    placed = shards(docs, limit, key, text).join(
        texts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("text_md5") == F.col("_md5"))
    )
    named = placed.select(
        key, text, F.concat_ws("-", "depth", F.lower(F.hex("prefix"))).alias("shard")
    )
    named.repartition("shard").write.partitionBy("shard").parquet(path)
