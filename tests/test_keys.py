"""Surrogate keys and insert-if-absent."""

import random

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.keys import insert_if_absent, key_registry, surrogate_key, with_key


def numbered(df, **options):
    rows = surrogate_key(df, "id", "k", **options).collect()
    return {r["id"]: r["k"] for r in rows}


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "id bigint")


def test_order_of_ids(spark):
    assert numbered(ids(spark, [40, 7, 4096, 4097])) == {7: 1, 40: 2, 4096: 3, 4097: 4}


@pytest.mark.parametrize("buckets", [2, 7, 64])
def test_uneven_ids(spark, buckets):
    rng = random.Random(buckets)
    values = list({rng.choice([rng.randrange(50), 10**6 + rng.randrange(900), rng.getrandbits(62), -rng.getrandbits(40)]) for _ in range(3000)})
    expected = {v: i + 1 for i, v in enumerate(sorted(values))}
    assert numbered(ids(spark, values), buckets=buckets) == expected


def test_no_rows(spark):
    assert numbered(ids(spark, [])) == {}
    assert numbered(ids(spark, [5])) == {5: 1}


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "id bigint, x string")
    keyed = surrogate_key(df, "id", "k")
    assert keyed.columns == ["k", "id", "x"]
    assert sorted(tuple(r) for r in keyed.collect()) == [(1, 1, "a"), (2, 2, "b")]


def test_no_task_numbers_the_whole_table(spark, shuffled_joins):
    """Clustered and far-out ids still give buckets of about equal size."""
    values = list(range(5000)) + [2**60 + i for i in range(10)]
    keyed = surrogate_key(ids(spark, values), "id", "k")
    sizes = [r["count"] for r in keyed.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == len(values) and max(sizes) < 0.4 * len(values)
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    row_number = next(line for line in plan.splitlines() if "row_number()" in line)
    assert "_bucket" in row_number


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([(1, "old"), (2, "old")], "id int, x string")
    new = spark.createDataFrame([(2, "new"), (3, "b"), (3, "a"), (4, "c")], "id int, x string")
    merged = insert_if_absent(existing, new, "id")
    assert sorted(tuple(r) for r in merged.collect()) == [(1, "old"), (2, "old"), (3, "a"), (4, "c")]


def test_registered_keys_stay(spark):
    def table(ids):
        return spark.createDataFrame([(i, f"n{i}") for i in ids], "id long, name string")

    first = key_registry(None, table([5, 3, 3, None, 9]), "id", "k").cache()
    assert {r["id"]: r["k"] for r in first.collect()} == {3: 1, 5: 2, 9: 3}
    second = key_registry(first, table([4, 9, 1, None]), "id", "k").cache()
    keys = {r["id"]: r["k"] for r in second.collect()}
    assert keys == {3: 1, 5: 2, 9: 3, 1: 4, 4: 5}
    third = key_registry(second, table([3, 2]), "id", "k")
    assert {r["id"]: r["k"] for r in third.collect()} == keys | {2: 6}
    got = with_key(table([9, None, 2, 9]), third, "id", "k")
    assert got.columns == ["k", "id", "name"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == [
        "(3, 9, 'n9')", "(3, 9, 'n9')", "(6, 2, 'n2')", "(None, None, 'nNone')",
    ]
    empty = key_registry(None, table([]), "id", "k").cache()
    assert empty.collect() == [] and key_registry(empty, table([7]), "id", "k").first()["k"] == 1
