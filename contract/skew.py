"""Larger and skewed copies of the driver's tables, for measuring.

    python -m contract.skew FROM_DIR TO_DIR [TIMES]

Writes every table of the rental model TIMES over (10 by default), with keys moved
so that copies stay apart. A third of the lines then belong to one order and a third
of the orders to one customer: one rental has a third of the payments, and one
customer a third of the rentals.
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that tell a table's copies apart, and those that point to them.
KEYS = {
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey"],
    "events": ["event_id"],
    "customer": [],
    "supplier": [],
    "part": [],
    "nation": [],
    "region": [],
}
HOT = {"orders": ("o_custkey", "o_orderkey"), "lineitem": ("l_orderkey", "l_extendedprice")}


def copies(df: DataFrame, keys: list[str], times: int) -> DataFrame:
    """The rows ``times`` over; keys of the copies are above those of the original."""
    if not keys:
        return df
    step = df.agg(*(F.max(k).alias(k) for k in keys)).first()
    numbered = df.withColumn("_copy", F.explode(F.lit(list(range(times)))))
    moved = {k: F.col(k) + F.col("_copy") * (step[k] + 1) for k in keys}
    return numbered.withColumns(moved).drop("_copy")


def skewed(df: DataFrame, table: str) -> DataFrame:
    """A third of the rows get the key of one of them."""
    if table not in HOT:
        return df
    key, by = HOT[table]
    one = df.agg(F.min(key)).first()[0]
    third = F.pmod(F.xxhash64(key, by), F.lit(3)) == 0
    return df.withColumn(key, F.when(third, F.lit(one)).otherwise(F.col(key)))


def write(spark: SparkSession, source: str, target: str, times: int = 10) -> None:
    for table, keys in KEYS.items():
        df = spark.read.parquet(f"{source}/{table}.parquet")
        made = skewed(copies(df, keys, times), table)
        made.write.mode("errorifexists").parquet(f"{target}/{table}.parquet")


if __name__ == "__main__":
    session = SparkSession.builder.appName("skewed tables").getOrCreate()
    write(session, sys.argv[1], sys.argv[2], int(sys.argv[3]) if len(sys.argv) > 3 else 10)
