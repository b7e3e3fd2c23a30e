"""Left lookups of a large table in a keyed table, whatever the key distribution."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup row is a key and a few short columns, so this many rows stay well
# under 200 MB per executor.
BROADCAST_ROWS = 1_000_000
HOT_SHARE = 0.002

# Takes a table and gives back its rows, stored or as they are.
Keep = Callable[[DataFrame], DataFrame]


def as_it_is(df: DataFrame) -> DataFrame:
    return df


def row_counts(tables: Mapping[str, DataFrame]) -> dict[str, int]:
    """Rows of each table, counted by one job; the result has one row per table."""
    counted = None
    for name, df in tables.items():
        part = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        counted = part if counted is None else counted.unionByName(part)
    return {row["name"]: row["n"] for row in counted.collect()}


def hot_keys(df: DataFrame, columns: list[str]) -> dict[str, list]:
    """Every key that holds at least 0.2 % of the rows, per column (and maybe some others).

    ``freqItems`` misses no such key, and its result is bounded by the share: at
    most about 500 values per column. Adaptive execution splits what smaller
    keys may still make uneven.
    """
    found = df.stat.freqItems(columns, HOT_SHARE).first()
    return {c: [k for k in found[f"{c}_freqItems"] if k is not None] for c in columns}


def spread_lookup(
    df: DataFrame, lookup: DataFrame, fk: str, pk: str, row_id: str, hot: list
) -> DataFrame:
    """Inner join in which rows with a hot key go to all tasks instead of one; keeps ``fk``."""
    is_hot = F.col(fk).isin(hot), F.col(pk).isin(hot)
    return _spread(df, lookup, F.col(fk) == F.col(pk), is_hot, [row_id]).drop(pk)


def _spread(
    df: DataFrame, lookup: DataFrame, matched: Column, is_hot: tuple[Column, Column], by: list[str]
) -> DataFrame:
    """Rows with a hot key are cut into slices by the hash of some columns, four per task, so
    that the hash of key and slice fills the tasks evenly. The lookup rows of the hot keys are
    repeated for every slice; as there are at most about 500 hot keys, this stays small.
    """
    slices = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    any_slice = F.pmod(F.xxhash64(*by), F.lit(slices)).cast("int")
    left = df.withColumn("_slice", F.when(is_hot[0], any_slice).otherwise(F.lit(0)))

    copies = F.when(is_hot[1], F.sequence(F.lit(0), F.lit(slices - 1)))
    right = lookup.withColumn("_lookup_slice", F.explode(F.coalesce(copies, F.array(F.lit(0)))))
    in_slice = F.col("_slice") == F.col("_lookup_slice")
    return left.join(right, matched & in_slice).drop("_slice", "_lookup_slice")


def lookup_all(
    df: DataFrame,
    lookups: list[tuple[str, DataFrame]],
    row_id: str,
    broadcast_rows: int = BROADCAST_ROWS,
    by_id: DataFrame | None = None,
    keep: Keep = as_it_is,
) -> DataFrame:
    """Left join each ``(fk, lookup)``; the first column of a lookup is its unique key.

    A lookup is broadcast if its counted size allows it. The keys of all others are
    shuffled at once, as (row, lookup, key), to where their lookup rows are; what is found is
    gathered to one row per id, joined back by it and compared by key. So the rows
    are those of a left join for either size: ids that repeat or are null neither add rows
    nor lose a key. Rows with an id, which should mostly be unique, are shuffled once by
    it, however many large lookups there are; rows without one go by their keys, of which each
    combination is looked up once.

    ``by_id`` is a table with at most one row per ``row_id``, which is left joined, too, where the
    rows lie by their id; its columns come last. ``keep`` may store what large lookups find.
    """
    rows = row_counts({str(i): table for i, (_, table) in enumerate(lookups)})
    large = [pair for i, pair in enumerate(lookups) if rows[str(i)] > broadcast_rows]
    more = [] if by_id is None else [f for f in by_id.schema if f.name != row_id]
    result = df
    if not large and more:
        result = result.join(by_id, row_id, "left")
    if large:
        fks = list(dict.fromkeys(fk for fk, _ in large))
        hot = hot_keys(df, fks)
        nameless = df.where(F.col(row_id).isNull())
        named = df.where(F.col(row_id).isNotNull())
        result = _lookup_large(named, F.col(row_id), large, hot, keep)
        by_keys = _lookup_large(nameless, F.xxhash64(*fks), large, hot, keep, repeats=True)
        if more:  # no row without an id meets another by it
            result = result.join(by_id, row_id, "left")
            by_keys = by_keys.withColumns({f.name: F.lit(None).cast(f.dataType) for f in more})
        result = result.unionByName(by_keys)
    for i, (fk, table) in enumerate(lookups):
        if rows[str(i)] <= broadcast_rows:
            key = f"_key_{i}"
            renamed = table.withColumnRenamed(table.columns[0], key)
            result = result.join(F.broadcast(renamed), F.col(fk) == F.col(key), "left").drop(key)
    found = [c for _, t in lookups for c in t.columns[1:]]
    return result.select(*df.columns, *found, *(f.name for f in more))


def _lookup_large(
    df: DataFrame,
    name: Column,
    lookups: list[tuple[str, DataFrame]],
    hot: Mapping[str, list],
    keep: Keep = as_it_is,
    repeats: bool = False,
) -> DataFrame:
    """Lookups whose keys and columns have equal types share one shuffle of the keys.

    ``name`` tells rows apart, together with the hash of their keys; of rows that agree in both, a
    key is still compared before its find is taken. ``repeats`` says that many rows may.
    """
    kinds = dict(df.dtypes)
    alike: dict[tuple, list[tuple[str, DataFrame]]] = {}
    for fk, table in lookups:
        alike.setdefault((kinds[fk], *(kind for _, kind in table.dtypes[1:])), []).append((fk, table))
    combination = F.xxhash64(*hot)
    result = df
    for (kind, *_), group in alike.items():
        wanted = [F.struct(F.lit(i).alias("_i"), F.col(fk).alias("_k")) for i, (fk, _) in enumerate(group)]
        keys = df.select(
            name.alias("_row"), combination.alias("_fks"), F.inline(F.array(*wanted))
        ).where("_k IS NOT NULL")
        keys = keys.distinct() if repeats else keys
        tables = None
        for i, (_, table) in enumerate(group):
            key, *columns = table.columns
            part = table.select(
                F.lit(i).alias("_j"),
                F.col(key).try_cast(kind).alias("_key"),
                *(F.col(c).alias(f"_{n}") for n, c in enumerate(columns)),
            )
            tables = part if tables is None else tables.unionByName(part)

        def is_hot(number: str, key: str, group=group) -> Column:
            each = ((F.col(number) == i) & F.col(key).isin(hot[fk]) for i, (fk, _) in enumerate(group))
            return reduce(lambda a, b: a | b, each)

        matched = (F.col("_i") == F.col("_j")) & (F.col("_k") == F.col("_key"))
        met = _spread(
            keys, tables, matched, (is_hot("_i", "_k"), is_hot("_j", "_key")), ["_row", "_fks"]
        )
        found = [
            F.first(F.when(F.col("_i") == i, F.col(c)), ignorenulls=True).alias(f"_find_{i}{c}")
            for i, (_, table) in enumerate(group)
            for c in ("_k", *(f"_{n}" for n in range(len(table.columns) - 1)))
        ]
        # put where the join wants them; little is left to combine before
        gathered = keep(met.repartition("_row").groupBy("_row", "_fks").agg(*found))
        # not a join key, so that rows stay where their id has put them
        same = F.when(combination == F.col("_fks"), True).otherwise(False)
        result = result.join(gathered, (name == F.col("_row")) & same, "left")
        for i, (fk, table) in enumerate(group):
            is_own = F.col(fk) == F.col(f"_find_{i}_k")
            finds = {c: F.when(is_own, F.col(f"_find_{i}_{n}")) for n, c in enumerate(table.columns[1:])}
            result = result.withColumns(finds)
        helpers = [c for c in result.columns if c.startswith("_find_")]
        result = result.drop("_row", "_fks", *helpers)
    return result
