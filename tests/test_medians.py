"""The distributed median against the plain definition."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.medians import fill_with_median, medians
from tests.conftest import final_plan


def median_of(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return medians(df, {"v": F.col("v")}).collect()[0]["v"]


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0, 10.0, None],
        [5.0],
        [0.0, 0.0, 0.0, 7.0],
        [-3.0, -1.0, 2.0],
        [-5.0, 5.0],
        [1e-300, 1e300, 12.0],
        [500.0] * 40 + [1.0, 2.0, 600.0],
        [100.0, 100.2, 100.4, 100.6],
        [0.01, 20000.0],
    ],
)
def test_small_columns(spark, values):
    assert median_of(spark, values) == statistics.median(v for v in values if v is not None)


def test_no_values(spark):
    assert median_of(spark, [None, None]) is None
    assert median_of(spark, []) is None


@pytest.mark.parametrize("seed", range(3))
def test_random_columns(spark, seed):
    rng = random.Random(seed)
    values = [round(rng.lognormvariate(4, 2) * rng.choice([1, 1, -1]), 2) for _ in range(4001 + seed)]
    assert median_of(spark, values) == statistics.median(values)


def test_one_pass_for_several_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 8.0), (9.0, 4.0)], "a double, b double")
    row = medians(df, {"a": F.col("a"), "b": F.col("b")}).collect()[0]
    assert (row["a"], row["b"]) == (2.0, 6.0)


def test_fill_needs_no_cross_join(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 20000.0), (3, None)], "id int, v double")
    filled = fill_with_median(df, ["v"])
    assert {r["id"]: r["v"] for r in filled.collect()} == {1: 5.0, 2: 20000.0, 3: 10002.5}
    plan = final_plan(filled)
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_one_slice_of_many_values(spark, shuffled_joins):
    """A column within 0.2 % of its size: no task orders more than a small part of its values."""
    df = spark.range(200_001).select((1000 + F.col("id") / 100_000).alias("v"))
    found = medians(df, {"v": F.col("v")})
    assert found.first()["v"] == 1000 + 100_000 / 100_000
    df = df.where("v < 1002")
    assert medians(df, {"v": F.col("v")}).first()["v"] == pytest.approx(1000.999995, abs=1e-12)
