"""Business rules as audits: expected bills, payment kinds, balances, anomalies."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import columns as C
from fleetlake.operators.joins import BROADCAST_ROWS, lookup_all
from fleetlake.operators.quality import count_matching

# Fixed value: the share of the deposit that a first payment must reach to count as one.
DEPOSIT_SHARE = "0.8"


def rate_rentals(
    rentals: DataFrame, tariffs: DataFrame, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """What each rental should cost by its tariff, next to what was billed.

    A rental without a tariff keeps nulls.
    """
    prices = tariffs.select(
        "tariff_id", "base_price_per_day", "km_included_per_day", "additional_km_price"
    )
    priced = lookup_all(rentals, [("tariff_id", prices)], "rental_id", broadcast_rows)
    # wide enough for any two of the columns' values
    included = F.col("km_included_per_day").cast("bigint") * F.col("rental_days")
    extra_km = C.clip(F.col("km_driven") - included, low=0)
    base = F.round(F.col("base_price_per_day") * F.col("rental_days"), 2)
    extra = F.round(F.col("expected_additional_km") * F.col("additional_km_price"), 2)
    total = F.col("expected_base_cost") + F.col("expected_additional_km_cost")
    return (
        priced.withColumns(
            {
                "expected_additional_km": extra_km,
                "expected_base_cost": base.cast("decimal(18,2)"),
            }
        )
        .withColumn("expected_additional_km_cost", extra.cast("decimal(18,2)"))
        .withColumn("expected_total_cost", total.cast("decimal(18,2)"))
        .select(
            "rental_id", "tariff_id", "expected_base_cost", "expected_additional_km",
            "expected_additional_km_cost", "expected_total_cost", "total_cost",
            (F.col("total_cost") - F.col("expected_total_cost"))
            .cast("decimal(18,2)").alias("billed_difference"),
        )
    )


def classify_payments(payments: DataFrame, rentals: DataFrame) -> DataFrame:
    """'Deposit' for a rental's first payment if it covers 80 % of the deposit, else 'Rental'.

    The first payment is the one with the lowest id; payments that share an id
    and a rental (a broken key) are classified alike. It is found with its amount
    by an aggregate, and only those that cover the share are matched to the payments
    again, so the payments of a busy rental are never gathered or ordered.
    """
    first = (
        payments.where(F.col("payment_id").isNotNull())
        .groupBy("rental_id")
        .agg(F.min(F.struct("payment_id", "amount")).alias("first"))
    )
    deposits = rentals.where(F.col("deposit_amount").isNotNull()).select(
        "rental_id", "deposit_amount"
    )
    least = F.col("deposit_amount") * F.lit(DEPOSIT_SHARE).cast("decimal(2,1)")
    covering = (
        first.join(deposits, "rental_id")
        .where(F.col("first.amount") >= least)
        .select(F.col("rental_id").alias("_rental"), F.col("first.payment_id").alias("_payment"))
    )
    matched = (F.col("payment_id") == F.col("_payment")) & (F.col("rental_id") == F.col("_rental"))
    kind = F.when(F.col("_payment").isNotNull(), "Deposit").otherwise("Rental")
    return payments.join(covering, matched, "left").select(
        "payment_id",
        "rental_id",
        "amount",
        kind.alias("payment_type"),
        F.col("payment_type").alias("declared_type"),
    )


def rental_balance(rentals: DataFrame, payments: DataFrame) -> DataFrame:
    """Cost plus deposit of each rental against its completed payments."""
    paid = (
        payments.where(F.col("status") == "Completed")
        .groupBy("rental_id")
        .agg(F.sum("amount").cast("decimal(18,2)").alias("paid"))
    )
    amount_due = (
        F.coalesce("total_cost", F.lit(0)) + F.coalesce("deposit_amount", F.lit(0))
    ).cast("decimal(18,2)")
    return (
        rentals.join(paid, "rental_id", "left")
        .withColumns(
            {
                "amount_due": amount_due,
                "amount_paid": F.coalesce("paid", F.lit(0)).cast("decimal(18,2)"),
            }
        )
        .select(
            "rental_id",
            "amount_due",
            "amount_paid",
            (F.col("amount_due") - F.col("amount_paid")).cast("decimal(18,2)").alias("balance"),
        )
    )


def anomaly_counts(raw: Mapping[str, DataFrame], cost_limit: float = 20_000) -> DataFrame:
    """Faults in the raw (text) tables that the cleaning jobs repair."""
    total, amount, cost = (C.number(F.col(c)) for c in ("total_cost", "amount", "cost"))
    repaired = C.flag(F.col("is_repaired"), False)
    no_repair_date = C.iso_date(F.col("repair_date")).isNull()
    return (
        count_matching(raw["rentals"], "rentals", {"negative_total_cost": total < 0})
        .unionByName(
            count_matching(
                raw["payments"],
                "payments",
                {"negative_amount": amount < 0, "zero_amount": amount == 0},
            )
        )
        .unionByName(
            count_matching(
                raw["car_condition"],
                "car_condition",
                {
                    "negative_cost": cost < 0,
                    "outlier_cost": F.abs(cost) > cost_limit,
                    "missing_repair_date": no_repair_date,
                    "repaired_without_date": repaired & no_repair_date,
                },
            )
        )
    )
