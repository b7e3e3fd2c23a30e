"""Keys, references, profiles and anomaly counts as reports.

Keys are counted before they are compared, so a key that fills a third of a
table is one row by the time it is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _key_counts(df: DataFrame, table: str, key: str) -> DataFrame:
    return (
        df.groupBy(F.col(key).cast("bigint").alias("key"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(table).alias("table_name"), "key", "n")
    )


def primary_key_violations(tables: Tables, keys: Mapping[str, str]) -> DataFrame:
    """One row per key value that is null or held by several rows."""
    counts = _union([_key_counts(tables[t], t, k) for t, k in keys.items() if t in tables])
    rule = F.when(F.col("key").isNull(), "null_key").when(F.col("n") > 1, "duplicate_key")
    return (
        counts.withColumn("rule", rule)
        .where(F.col("rule").isNotNull())
        .select("table_name", "rule", "key", "n")
    )


def _references(tables: Tables, foreign_keys: list) -> DataFrame:
    """Child rows per (constraint, parent, key); each child table is read once."""
    parts = []
    for child in dict.fromkeys(c for _, c, _, _ in foreign_keys):
        references = F.array(
            *(
                F.struct(
                    F.lit(name).alias("rule"),
                    F.lit(parent).alias("parent"),
                    F.col(column).cast("bigint").alias("key"),
                )
                for name, table, column, parent in foreign_keys
                if table == child
            )
        )
        parts.append(
            tables[child]
            .select(F.lit(child).alias("table_name"), F.inline(references))
            .groupBy("table_name", "rule", "parent", "key")
            .agg(F.count("*").alias("n"))
        )
    return _union(parts)


def _parents(tables: Tables, foreign_keys: list, keys: Mapping[str, str]) -> DataFrame:
    return _union(
        [
            tables[parent].select(
                F.lit(parent).alias("parent"), F.col(keys[parent]).cast("bigint").alias("key")
            )
            for parent in dict.fromkeys(p for _, _, _, p in foreign_keys)
        ]
    )


def foreign_key_violations(
    tables: Tables, foreign_keys: list, keys: Mapping[str, str]
) -> DataFrame:
    """One row per referenced key that its parent lacks; a null reference is allowed."""
    references = _references(tables, foreign_keys).where(F.col("key").isNotNull())
    return references.join(
        _parents(tables, foreign_keys, keys), ["parent", "key"], "left_anti"
    ).select("table_name", "rule", "key", "n")


def integrity_report(
    tables: Tables, keys: Mapping[str, str], foreign_keys: list
) -> DataFrame:
    """All violations; an empty report lets a layer be published."""
    return primary_key_violations(tables, keys).unionByName(
        foreign_key_violations(tables, foreign_keys, keys)
    )


def constraint_summary(
    tables: Tables, keys: Mapping[str, str], foreign_keys: list
) -> DataFrame:
    """Per constraint: the keys checked and how many of them break it."""
    unique = _union([_key_counts(tables[t], t, k) for t, k in keys.items()])
    bad_key = F.col("key").isNull() | (F.col("n") > 1)
    primary = unique.groupBy("table_name").agg(
        F.count("*").alias("checked"), F.count(F.when(bad_key, 1)).alias("violations")
    )
    parents = _parents(tables, foreign_keys, keys).distinct().withColumn("_known", F.lit(True))
    orphan = F.col("key").isNotNull() & F.col("_known").isNull()
    foreign = (
        _references(tables, foreign_keys)
        .join(parents, ["parent", "key"], "left")
        .groupBy("table_name", "rule")
        .agg(F.count("key").alias("checked"), F.count(F.when(orphan, 1)).alias("violations"))
    )
    return primary.select(
        "table_name", F.lit("primary_key").alias("rule"), "checked", "violations"
    ).unionByName(foreign)


def key_profile(tables: Tables, keys: Mapping[str, str]) -> DataFrame:
    """Rows and distinct keys of each table."""
    return _union(
        [
            tables[t].agg(
                F.lit(t).alias("table_name"),
                F.count("*").alias("row_count"),
                F.count_distinct(k).alias("unique_keys"),
            )
            for t, k in keys.items()
            if t in tables
        ]
    )


def row_count_report(tables: Tables) -> DataFrame:
    """Rows of each table, and their total."""
    counts = _union(
        [
            df.agg(F.lit(t).alias("table_name"), F.count("*").alias("row_count"))
            for t, df in tables.items()
        ]
    )
    table = F.when(F.grouping("table_name") == 1, "total").otherwise(F.col("table_name"))
    return (
        counts.rollup("table_name")
        .agg(F.sum("row_count").alias("row_count"), table.alias("name"))
        .select(F.col("name").alias("table_name"), "row_count")
    )


def count_matching(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that match each rule, all from one scan."""
    counted = df.agg(*(F.count(F.when(rule, 1)).alias(name) for name, rule in rules.items()))
    pairs = F.array(
        *(F.struct(F.lit(n).alias("anomaly"), F.col(n).alias("row_count")) for n in rules)
    )
    return counted.select(F.lit(table).alias("table_name"), F.inline(pairs))
