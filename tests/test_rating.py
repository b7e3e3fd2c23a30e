"""Rating, payment kinds, balances and anomaly counts on hand-made rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fleetlake.plans import rating
from tests.test_clean import text_table
from tests.test_gold import silver_table


@pytest.mark.parametrize("broadcast_rows", [1000, 0])
def test_rate_rentals(spark, broadcast_rows):
    tariffs = silver_table(spark, "tariffs", [
        {"tariff_id": 1, "base_price_per_day": "10.50", "km_included_per_day": 100, "additional_km_price": "0.25"},
    ])
    rentals = silver_table(spark, "rentals", [
        {"rental_id": 1, "tariff_id": 1, "rental_days": 3, "km_driven": 301, "total_cost": "31.00"},
        {"rental_id": 2, "tariff_id": 1, "rental_days": 3, "km_driven": 10, "total_cost": "31.50"},
        {"rental_id": 3, "rental_days": 3, "km_driven": 10, "total_cost": "1"},
    ])
    got = sorted(tuple(r) for r in rating.rate_rentals(rentals, tariffs, broadcast_rows).collect())
    d = Decimal
    assert got == [
        (1, 1, d("31.50"), 1, d("0.25"), d("31.75"), d("31.00"), d("-0.75")),
        (2, 1, d("31.50"), 0, d("0.00"), d("31.50"), d("31.50"), d("0.00")),
        (3, None, None, None, None, None, d("1.00"), None),
    ]


def test_classify_payments(spark):
    rentals = silver_table(spark, "rentals", [
        {"rental_id": 1, "deposit_amount": 100}, {"rental_id": 2, "deposit_amount": 100}, {"rental_id": 3},
    ])
    payments = silver_table(spark, "payments", [
        {"payment_id": 2, "rental_id": 1, "amount": 500, "payment_type": "Deposit"},
        {"payment_id": 1, "rental_id": 1, "amount": 80},
        {"payment_id": 3, "rental_id": 2, "amount": "79.99"},
        {"payment_id": 4, "rental_id": 2, "amount": 100},
        {"payment_id": 5, "rental_id": 3, "amount": 100},
        {"payment_id": 6, "rental_id": 9, "amount": 100},
    ])
    got = {r["payment_id"]: r["payment_type"] for r in rating.classify_payments(payments, rentals).collect()}
    assert got == {1: "Deposit", 2: "Rental", 3: "Rental", 4: "Rental", 5: "Rental", 6: "Rental"}


def test_classify_payments_orders_no_rental(spark, shuffled_joins):
    """Most payments belong to one rental; no task gets them all and nothing is windowed."""
    rentals = silver_table(spark, "rentals", [{"rental_id": 1, "deposit_amount": 10}])
    payments = spark.range(1000).select(
        F.col("id").alias("payment_id"), F.lit(1).cast("bigint").alias("rental_id"),
        F.lit(50).cast("decimal(10,2)").alias("amount"), F.lit("x").alias("payment_type"),
    )
    marked = rating.classify_payments(payments, rentals)
    sizes = [r["count"] for r in marked.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) < 300
    assert [r["payment_id"] for r in marked.where("payment_type = 'Deposit'").collect()] == [0]
    assert "Window" not in marked._jdf.queryExecution().executedPlan().toString()


def test_balance(spark):
    rentals = silver_table(spark, "rentals", [
        {"rental_id": 1, "total_cost": 100, "deposit_amount": 20}, {"rental_id": 2, "total_cost": 5},
    ])
    payments = silver_table(spark, "payments", [
        {"payment_id": 1, "rental_id": 1, "amount": 90, "status": "Completed"},
        {"payment_id": 2, "rental_id": 1, "amount": 50, "status": "Refunded"},
        {"payment_id": 3, "rental_id": 1, "amount": 40, "status": "Completed"},
    ])
    got = sorted(tuple(r) for r in rating.rental_balance(rentals, payments).collect())
    assert got == [(1, 120, 130, -10), (2, 5, 0, 5)]


def test_anomalies(spark):
    raw = {
        "rentals": text_table(spark, "rentals", [{"total_cost": "-1"}, {"total_cost": "x"}, {"total_cost": "1"}]),
        "payments": text_table(spark, "payments", [{"amount": "-1"}, {"amount": "0"}, {"amount": "0.0"}, {}]),
        "car_condition": text_table(spark, "car_condition", [
            {"cost": "-30000", "is_repaired": "true"}, {"cost": "5", "repair_date": "2024-01-01"}, {"is_repaired": "false"},
        ]),
    }
    got = {r["anomaly"]: r["row_count"] for r in rating.anomaly_counts(raw).collect()}
    assert got == {
        "negative_total_cost": 1, "negative_amount": 1, "zero_amount": 2, "negative_cost": 1,
        "outlier_cost": 1, "missing_repair_date": 2, "repaired_without_date": 1,
    }
