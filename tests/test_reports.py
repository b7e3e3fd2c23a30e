"""The reports on a small hand-made star."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fleetlake.plans import reports
from fleetlake.sources.layers import write_table

D = date
RENTALS = [
    # car, client, employee, tariff, day, cost, paid
    (1, 1, 1, 1, D(2023, 1, 5), "100.00", "50"),
    (1, 2, 2, 1, D(2023, 1, 31), "0.01", "0"),
    (2, 3, 3, 2, D(2024, 1, 1), "200.00", "10"),
    (2, 1, 1, None, D(2025, 12, 31), "0.02", "0"),
    (None, 1, 1, 2, D(2026, 1, 1), "7.00", "7"),
    (3, None, None, 1, None, None, "0"),
]


@pytest.fixture(scope="module")
def star(spark):
    fact = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(RENTALS)],
        "rental_id bigint, car_key bigint, client_key bigint, employee_key bigint, tariff_key bigint, "
        "rental_date date, cost string, paid string",
    ).select(
        "rental_id", "car_key", "client_key", "employee_key", "tariff_key", "rental_date",
        F.col("cost").cast("decimal(10,2)").alias("total_cost"),
        F.col("paid").cast("decimal(18,2)").alias("total_paid"),
    )
    return {
        "fact_rentals": fact,
        "dim_tariff": spark.createDataFrame(
            [(1, "Lux", 5.0), (2, "Eco", 3.0)], "tariff_key bigint, tariff_name string, base_price_per_day double"
        ),
        "dim_car": spark.createDataFrame(
            [(1, "A", "m", "p1", 1.0), (2, "B", "m", "p2", 1.0), (3, "B", "n", "p3", 1.0)],
            "car_key bigint, brand string, model string, license_plate string, daily_rental_price double",
        ),
        "dim_client": spark.createDataFrame(
            [(1, "N N", "X", "Gold"), (2, "N N", "X", "Gold"), (3, "M", "Y", "Gold")],
            "client_key bigint, full_name string, city string, loyalty_level string",
        ),
        "dim_employee": spark.createDataFrame(
            [(1, "E"), (2, "E"), (3, "F")], "employee_key bigint, full_name string"
        ),
    }


def rows(df):
    return [tuple(r) for r in df.collect()]


def money(text):
    return Decimal(text)


def test_tariffs(star):
    got = rows(reports.tariffs(star["fact_rentals"], star["dim_tariff"]))
    assert got == [("Eco", 3.0, 2, money("207.00"), money("17")), ("Lux", 5.0, 3, money("100.01"), money("50"))]


def test_top_cars_puts_missing_revenue_first(star):
    got = rows(reports.top_cars(star["fact_rentals"], star["dim_car"]))
    assert [(r[2], r[5]) for r in got] == [("p3", None), ("p2", money("200.02")), ("p1", money("100.01"))]
    assert rows(reports.top_cars(star["fact_rentals"], star["dim_car"], limit=1)) == got[:1]


def test_brands(star):
    assert rows(reports.brands(star["fact_rentals"], star["dim_car"])) == [("B", 3), ("A", 2)]


def test_namesakes_merge(star):
    got = rows(reports.top_clients(star["fact_rentals"], star["dim_client"]))
    assert got == [("M", "Y", "Gold", 1, money("200.00")), ("N N", "X", "Gold", 4, money("107.03"))]
    assert rows(reports.client_cities(star["fact_rentals"], star["dim_client"])) == [("X", 4), ("Y", 1)]


def test_employees(star):
    got = rows(reports.employees(star["fact_rentals"], star["dim_employee"]))
    assert got == [("F", 1, money("200.00"), money("200.00")), ("E", 4, money("107.03"), money("26.76"))]


def test_average_rounds_once(spark, star):
    """2 / 3 cents and the like round half up from the exact quotient."""
    fact = spark.createDataFrame([(1, "0.01")] * 1 + [(1, "0.00")], "employee_key bigint, c string").select(
        "employee_key", F.col("c").cast("decimal(10,2)").alias("total_cost")
    )
    assert rows(reports.employees(fact, star["dim_employee"])) == [("E", 2, money("0.01"), money("0.01"))]


def test_months(star):
    assert rows(reports.rentals_by_month(star["fact_rentals"])) == [
        (D(2023, 1, 1), 2), (D(2024, 1, 1), 1), (D(2025, 12, 1), 1), (D(2026, 1, 1), 1), (None, 1),
    ]
    revenue = rows(reports.revenue_by_month(star["fact_rentals"]))
    assert revenue[0] == (D(2023, 1, 1), money("100.01")) and revenue[-1] == (None, None)
    assert sum(r[1] for r in revenue if r[1]) == money("307.03")


def test_year_comparison(star):
    assert rows(reports.month_year_comparison(star["fact_rentals"])) == [
        (1, "January", money("100.01"), money("200.00"), None),
        (12, "December", None, None, money("0.02")),
    ]


def test_stored_fact_gives_the_same_months(spark, star, tmp_path):
    """The fact as it is stored: partitioned by month, the rental without a date too."""
    fact = star["fact_rentals"]
    path = str(tmp_path / "fact")
    write_table(fact.withColumn("rental_month", F.trunc("rental_date", "MM")), path, "rental_month")
    stored = spark.read.parquet(path)
    for report in (reports.rentals_by_month, reports.revenue_by_month, reports.month_year_comparison):
        assert rows(report(stored)) == rows(report(fact))
    plan = reports.rentals_by_month(stored)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    pruned = reports.month_year_comparison(stored)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(rental_month" in pruned


def test_reports_aggregate_before_they_join(star):
    plan = reports.top_clients(star["fact_rentals"], star["dim_client"])._jdf.queryExecution()
    logical = plan.optimizedPlan().toString().splitlines()
    join = next(i for i, line in enumerate(logical) if "Join" in line)
    assert any("Aggregate [client_key" in line for line in logical[join:])
