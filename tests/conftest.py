import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("fleetlake tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def evaluate(spark):
    """Evaluate a rule on typed rows and return its values in row order."""

    def run(schema, rows, rule):
        numbered = [(i, *row) for i, row in enumerate(rows)]
        df = spark.createDataFrame(numbered, f"row_no int, {schema}")
        found = df.select("row_no", rule.alias("value")).collect()
        return [r["value"] for r in sorted(found, key=lambda r: r["row_no"])]

    return run


@pytest.fixture
def shuffled_joins(spark):
    """No broadcast, and no merging of small partitions: what a cluster does with large tables."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def final_plan(df) -> str:
    """The physical plan that ran, after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
