"""Lookups by broadcast and by spread shuffle."""

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.joins import hot_keys, lookup_all, row_counts, spread_lookup
from fleetlake.sources.layers import kept_in


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows on key 7, a third on null, the rest even; key 999 has no match."""
    key = (
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 3 == 1, F.lit(None))
        .when(F.col("id") % 50 == 2, 999)
        .otherwise(F.col("id") % 200)
        .cast("bigint")
    )
    return spark.range(9000).select(F.col("id").alias("row_id"), key.alias("fk"))


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(200).select(F.col("id").alias("pk"), (F.col("id") * 10).alias("found"))


def test_row_counts(spark, skewed, lookup):
    assert row_counts({"a": skewed, "b": lookup}) == {"a": 9000, "b": 200}


def test_hot_keys(skewed):
    hot = hot_keys(skewed, ["fk"])["fk"]
    assert 7 in hot and None not in hot and len(hot) <= 500


def test_both_ways_agree(skewed, lookup, shuffled_joins):
    def result(limit):
        joined = lookup_all(skewed, [("fk", lookup)], "row_id", broadcast_rows=limit)
        assert joined.columns == ["row_id", "fk", "found"]
        return sorted(tuple(r) for r in joined.select("row_id", F.coalesce("found", F.lit(-1))).collect())

    small, large = result(1000), result(10)
    assert small == large and len(small) == 9000


def test_hot_keys_reach_all_tasks(skewed, lookup, shuffled_joins):
    found = spread_lookup(
        skewed.where("fk IS NOT NULL"), lookup, "fk", "pk", "row_id", hot_keys(skewed, ["fk"])["fk"]
    )
    hot = found.where("found = 70")
    sizes = [r["count"] for r in hot.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) > 3000 and len(sizes) == 8 and max(sizes) < 750


def test_wide_rows_are_shuffled_once(spark, skewed, lookup, shuffled_joins):
    """Two large lookups: keys are shuffled for each, the other columns only by row id."""
    wide = skewed.withColumns({"fk2": F.col("fk"), "wide": F.repeat(F.lit("x"), 3)})
    second = lookup.select("pk", F.col("found").alias("found2"))
    joined = lookup_all(wide, [("fk", lookup), ("fk2", second)], "row_id", broadcast_rows=10)
    assert joined.columns == ["row_id", "fk", "fk2", "wide", "found", "found2"]
    assert joined.count() == 9000
    assert joined.where("found IS DISTINCT FROM found2").count() == 0
    plan = joined._jdf.queryExecution().executedPlan().toString().splitlines()
    shuffles = [line for line in plan if "Exchange hashpartitioning" in line]
    assert len([line for line in shuffles if "hashpartitioning(row_id" in line]) == 1


def test_large_lookups_give_what_small_ones_give(spark, shuffled_joins):
    """Repeated and null ids, null and hot keys."""
    rows = [(None if i % 7 == 0 else i % 40, None if i % 5 == 0 else (1 if i % 3 else i % 30)) for i in range(900)]
    df = spark.createDataFrame(rows, "row_id long, fk long")
    lookup = spark.range(1, 25).selectExpr("id AS key", "id * 10 AS found")
    second = spark.range(1, 9).selectExpr("id AS key", "id * 100 AS other")
    lookups = [("fk", lookup)]
    small = sorted(map(repr, lookup_all(df, lookups, "row_id").collect()))
    large = sorted(map(repr, lookup_all(df, lookups, "row_id", broadcast_rows=0).collect()))
    assert small == large and len(large) == 900
    both = [("fk", lookup), ("row_id", second)]
    small = sorted(map(repr, lookup_all(df, both, "row_id").collect()))
    assert small == sorted(map(repr, lookup_all(df, both, "row_id", broadcast_rows=10).collect()))
    assert small == sorted(map(repr, lookup_all(df, both, "row_id", broadcast_rows=0).collect()))


def test_large_lookups_share_one_shuffle_of_keys(spark, skewed, shuffled_joins):
    """Six lookups of one type: one exchange of keys, whatever their number; another type has its own."""
    fks = {f"fk{i}": F.col("fk") + i for i in range(6)}
    wide = skewed.withColumns(fks)
    tables = [(f"fk{i}", spark.range(200).selectExpr("id AS pk", f"id * 10 AS found{i}")) for i in range(6)]
    named = spark.range(200).selectExpr("id AS pk", "concat('n', id) AS name", "id AS again")

    def keys_shuffled(lookups):
        joined = lookup_all(wide, lookups, "row_id", broadcast_rows=10)
        plan = joined._jdf.queryExecution().executedPlan().toString().splitlines()
        return len([x for x in plan if "Exchange hashpartitioning(_i" in x or "Exchange hashpartitioning(_k" in x])

    assert keys_shuffled(tables) == keys_shuffled(tables[:2]) > 0
    lookups = [*tables, ("fk", named)]
    small = sorted(map(repr, lookup_all(wide, lookups, "row_id").collect()))
    assert small == sorted(map(repr, lookup_all(wide, lookups, "row_id", broadcast_rows=10).collect()))


def test_rows_without_ids_on_one_key(spark, shuffled_joins):
    """Half of the rows have neither an id nor another key than the others."""
    df = spark.range(4000).selectExpr(
        "CASE WHEN id % 2 = 0 THEN id END AS row_id", "CASE WHEN id % 2 = 0 THEN id % 9 ELSE 3 END AS fk",
        "CASE WHEN id % 5 > 0 THEN 4 END AS fk2", "id AS n",
    )
    lookups = [(fk, spark.range(8).selectExpr("id AS pk", f"id * 10 AS {fk}_found")) for fk in ("fk", "fk2")]
    small = sorted(map(repr, lookup_all(df, lookups, "row_id").collect()))
    assert small == sorted(map(repr, lookup_all(df, lookups, "row_id", broadcast_rows=0).collect()))


def test_a_table_by_id_is_joined_where_the_rows_lie(spark, skewed, lookup, shuffled_joins, tmp_path):
    """Repeated and null ids; the rows are shuffled once by id, and ``keep`` stores what is found."""
    df = skewed.withColumn("row_id", F.when(F.col("row_id") % 7 > 0, F.col("row_id") % 4000))
    totals = spark.range(0, 5000, 2).selectExpr("id AS row_id", "id * 3 AS total")
    totals = totals.unionByName(spark.sql("SELECT CAST(null AS bigint) AS row_id, 5L AS total"))
    expected = lookup_all(df, [("fk", lookup)], "row_id").join(totals, "row_id", "left")
    expected = sorted(map(repr, expected.select("row_id", "fk", "found", "total").collect()))
    for limit in (1_000_000, 10):
        joined = lookup_all(df, [("fk", lookup)], "row_id", limit, totals, kept_in(str(tmp_path)))
        assert joined.columns == ["row_id", "fk", "found", "total"]
        plan = joined._jdf.queryExecution().executedPlan().toString().splitlines()
        # of the rows and of the table
        assert len([line for line in plan if "Exchange hashpartitioning(row_id" in line]) == 2
        assert sorted(map(repr, joined.collect())) == expected
    assert len(list(tmp_path.iterdir())) == 2  # of rows with an id and of those without
