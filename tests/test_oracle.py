"""Every registered query against its SQL oracle on the smallest tables."""

import importlib
import os

import pytest

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

entry = importlib.import_module("__spark_entry__")
registry = importlib.import_module("contract.registry")
QUERIES = {key: query for key, query in entry.queries().items() if key in registry.QUERIES}
ORACLES = {key: sql for key, sql in entry.oracle_sql().items() if key in registry.QUERIES}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, duck, key):
    df = QUERIES[key](spark, SF_DIR)
    expected = duck.execute(ORACLES[key])
    names = [d[0] for d in expected.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, df.collect()) == canonical(names, expected.fetchall())
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "InPandas"):
        assert node not in plan


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["month", "total_revenue"] and df.count() > 0


def test_fact_invariants(spark):
    """No rental is lost or repeated, and the reports add up to the fact."""
    fact = QUERIES["fact_rentals"](spark, SF_DIR)
    rentals = spark.read.parquet(f"{SF_DIR}/orders.parquet").count()
    assert fact.count() == fact.select("rental_id").distinct().count() == rentals
    months = QUERIES["report_rentals_by_month"](spark, SF_DIR).agg({"rentals_count": "sum"})
    assert months.first()[0] == rentals
    total = fact.agg({"total_cost": "sum"}).first()[0]
    revenue = QUERIES["report_revenue_by_month"](spark, SF_DIR)
    assert revenue.agg({"total_revenue": "sum"}).first()[0] == total
    by_year = {}
    for row in revenue.where("year(month) BETWEEN 2023 AND 2025").collect():
        by_year[(row["month"].month, row["month"].year)] = row["total_revenue"]
    for row in QUERIES["report_month_year_pivot"](spark, SF_DIR).collect():
        for year in (2023, 2024, 2025):
            assert row[f"revenue_{year}"] == by_year.get((row["month_number"], year))
