"""The star schema on hand-made silver rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.plans import gold
from fleetlake.sources.layers import kept_in
from tests.conftest import final_plan

D = date


def silver_table(spark, table, rows):
    types = schemas.silver_types(table)
    schema = ", ".join(f"{n} {k}" for n, k in types.items())
    text = ", ".join(f"{n} string" for n in types)
    df = spark.createDataFrame(
        [tuple(None if r.get(n) is None else str(r[n]) for n in types) for r in rows], text
    )
    return df.select(*(F.col(n).cast(k) for n, k in types.items())).to(spark.createDataFrame([], schema).schema)


@pytest.fixture(scope="module")
def silver(spark):
    return {
        "locations": silver_table(spark, "locations", [{"location_id": 10, "city": "X"}, {"location_id": 5, "city": "Y"}]),
        "cars": silver_table(spark, "cars", [{"car_id": 3, "brand": "B"}, {"car_id": 1, "brand": "A"}]),
        "customers": silver_table(spark, "customers", [{"customer_id": 8, "first_name": "F"}, {"customer_id": 9, "last_name": "L"}]),
        "employees": silver_table(spark, "employees", [{"employee_id": 4, "first_name": "F", "last_name": "L"}]),
        "tariffs": silver_table(spark, "tariffs", [{"tariff_id": 2, "tariff_name": "T"}]),
        "rentals": silver_table(spark, "rentals", [
            {"rental_id": 1, "car_id": 3, "customer_id": 9, "employee_id": 4, "tariff_id": 2, "pickup_location_id": 5,
             "return_location_id": 10, "rental_date": "2024-01-30", "actual_return_date": "2024-02-02", "total_cost": "12.50"},
            {"rental_id": 2, "car_id": 77, "rental_date": "2019-12-31", "deposit_returned": "3"},
        ]),
        "payments": silver_table(spark, "payments", [
            {"payment_id": 1, "rental_id": 1, "amount": 10, "payment_method": "Cash", "status": "Completed"},
            {"payment_id": 2, "rental_id": 1, "amount": 5, "payment_method": "Cash", "status": "Completed"},
            {"payment_id": 3, "rental_id": 1, "amount": 1, "status": "Completed"},
            {"payment_id": 4, "rental_id": 1, "amount": 99, "payment_method": "Card", "status": "Failed"},
            {"payment_id": 5, "rental_id": 55, "amount": 4, "payment_method": "Card", "status": "Completed"},
        ]),
    }


def test_calendar(spark):
    days = {r["full_date"]: r for r in gold.dim_date(spark).collect()}
    assert len(days) == 4018 and min(days) == D(2020, 1, 1) and max(days) == D(2030, 12, 31)
    for day, expected in (
        (D(2024, 1, 7), (20240107, 2024, 1, 7, "January", 0, "Weekend")),
        (D(2024, 1, 8), (20240108, 2024, 1, 8, "January", 1, "Weekday")),
        (D(2024, 12, 14), (20241214, 2024, 12, 14, "December", 6, "Weekend")),
    ):
        r = days[day]
        assert (
            r["date_key"], r["year"], r["month"], r["day"], r["month_name"], r["day_of_week"], r["day_type"],
        ) == expected


def test_date_keys_outside_the_calendar(spark):
    days = ["2019-12-31", "2020-01-01", "2030-12-31", "2031-01-01", None]
    rentals = spark.createDataFrame([(d, None) for d in days], "d string, e string").select(
        F.col("d").cast("date").alias("rental_date"), F.col("e").cast("date").alias("actual_return_date")
    )
    found = gold.with_date_keys(rentals, gold.dim_date(spark)).collect()
    keys = {str(r["rental_date"]): r["rental_date_key"] for r in found}
    assert keys == {
        "2019-12-31": None, "2020-01-01": 20200101, "2030-12-31": 20301231, "2031-01-01": None, "None": None,
    }
    assert all(r["actual_return_date_key"] is None for r in found)


def test_dimensions(silver):
    dims = gold.build_dims(silver)
    assert [(r["car_key"], r["car_id"]) for r in dims["dim_car"].orderBy("car_key").collect()] == [(1, 1), (2, 3)]
    names = {r["customer_id"]: r["full_name"] for r in dims["dim_client"].collect()}
    assert names == {8: "F ", 9: " L"}
    assert dims["dim_employee"].first()["full_name"] == "F L"
    assert "salary" not in dims["dim_employee"].columns and "mileage" not in dims["dim_car"].columns


def test_payment_rollup(silver):
    paid = {r["rental_id"]: tuple(r)[1:] for r in gold.payment_rollup(silver["payments"]).collect()}
    assert paid == {1: (16, 3, 1), 55: (4, 1, 1)}


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_fact(silver, broadcast_rows):
    """The same rows whether the dimensions are broadcast or shuffled."""
    dims = gold.build_dims(silver)
    fact = gold.fact_rentals(silver["rentals"], silver["payments"], dims, broadcast_rows)
    first, second = sorted(fact.collect(), key=lambda r: r["rental_id"])
    assert len(first) == 26
    keys = ["car_key", "client_key", "employee_key", "tariff_key", "pickup_location_key", "return_location_key"]
    assert [first[k] for k in keys] == [2, 2, 1, 1, 1, 2]
    assert (first["rental_date_key"], first["actual_return_date_key"], first["duration_days"]) == (20240130, 20240202, 3)
    assert (first["total_paid"], first["payment_count"], first["unique_payment_methods"]) == (16, 3, 1)
    assert first["deposit_returned"] == 0 and str(first["total_cost"]) == "12.50"
    assert [second[k] for k in keys] == [None] * 6
    assert (second["rental_date_key"], second["duration_days"]) == (None, None)
    assert (second["total_paid"], second["payment_count"], second["unique_payment_methods"]) == (0, 0, 0)
    assert second["deposit_returned"] == 3


def test_fact_plan(silver):
    dims = gold.build_dims(silver)
    plan = final_plan(gold.fact_rentals(silver["rentals"], silver["payments"], dims))
    assert plan.count("BroadcastHashJoin") >= 8
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_a_busy_rental_is_combined_before_the_shuffle(spark):
    payments = spark.range(1000).select(
        F.lit(1).cast("bigint").alias("rental_id"), F.lit("Completed").alias("status"),
        F.lit(1).cast("decimal(10,2)").alias("amount"), F.lit("Cash").alias("payment_method"),
    )
    rolled = gold.payment_rollup(payments)
    assert tuple(rolled.first()) == (1, 1000, 1000, 1)
    assert "partial_sum" in rolled._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_a_fact_made_in_stored_steps(spark, silver, broadcast_rows, tmp_path):
    dims = gold.build_dims(silver)
    nameless = silver["rentals"].withColumn("rental_id", F.lit(None).cast("bigint"))
    rentals = silver["rentals"].unionByName(nameless)
    payments = silver["payments"].unionByName(silver["payments"].withColumn("rental_id", F.lit(None).cast("bigint")))
    whole = gold.fact_rentals(rentals, payments, dims)
    steps = gold.fact_rentals(rentals, payments, dims, broadcast_rows, kept_in(str(tmp_path)))
    assert steps.columns == whole.columns
    assert sorted(map(repr, steps.collect())) == sorted(map(repr, whole.collect()))
    # payments by rental; what is found for rows with an id and without one, of one type of key
    assert len(list(tmp_path.iterdir())) == (1 if broadcast_rows else 3)
