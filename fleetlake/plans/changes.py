"""Which months of the rental fact a refresh has to make anew.

A month is made anew if its rentals or their payments differ from those that the
published month was made of, or if a dimension gives one of its rentals another key.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import columns as C
from fleetlake.operators.joins import lookup_all, row_counts
from fleetlake.plans.gold import with_rollup

# Rental columns that the fact is made of, besides what the payments add.
FACT_SOURCES = [
    "rental_id", "car_id", "customer_id", "employee_id", "tariff_id", "pickup_location_id",
    "return_location_id", "rental_date", "scheduled_return_date", "actual_return_date",
    "rental_days", "total_cost", "base_cost", "additional_km_cost", "deposit_returned", "status",
    "km_driven", "additional_km", "is_late_return", "late_days", "total_paid", "payment_count",
    "unique_payment_methods",
]
# Dimension, its id and key, and the expressions of a rental that are looked up in it.
LOOKED_UP = [
    ("dim_car", "car_id", "car_key", ["car_id"]),
    ("dim_client", "customer_id", "client_key", ["customer_id"]),
    ("dim_employee", "employee_id", "employee_key", ["employee_id"]),
    ("dim_tariff", "tariff_id", "tariff_key", ["tariff_id"]),
    ("dim_location", "location_id", "location_key", ["pickup_location_id", "return_location_id"]),
    ("dim_date", "date_key", "full_date", ["rental_date", "actual_return_date"]),
]


def month() -> Column:
    return F.trunc("rental_date", "MM").alias("rental_month")


def row_digests(names: list[str]) -> list[Column]:
    """Two 64-bit digests of a row; a null differs from every value and from other columns' nulls."""
    nulls = [F.when(F.col(c).isNull(), F.lit(1 << i)).otherwise(0) for i, c in enumerate(names)]
    mask = reduce(lambda a, b: a + b, (n.cast("long") for n in nulls))
    return [F.xxhash64(*names, mask), F.xxhash64(F.lit(1), *names, mask)]


def month_digests(rentals: DataFrame, rollup: DataFrame) -> DataFrame:
    """One row per month: its rentals, and the sums of their digests, whatever the order.

    Sums combine map-side, so that a month with most of the rows shuffles no more than
    others; a repeated row counts as often as it is there. Two contents of a month
    that differ are taken for equal with a chance of about 2 ** -128.
    """
    one, two = (d.cast("decimal(20,0)") for d in row_digests(FACT_SOURCES))
    return (
        with_rollup(rentals, rollup)
        .groupBy(month())
        .agg(F.count("*").alias("rentals"), F.sum(one).alias("one"), F.sum(two).alias("two"))
    )


def differing(old: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """Different values of a column (null is one) in rows that only one of two tables holds.

    Neither table holds a row twice.
    """
    both = old.unionByName(new)
    return both.groupBy(*both.columns).count().where("count = 1").select(column).distinct()


def months_of_new_keys(
    rentals: DataFrame, old: Mapping[str, DataFrame], new: Mapping[str, DataFrame]
) -> DataFrame | None:
    """Months with a rental whose id or day has a key that is new, gone or another one.

    None if no dimension differs in its keys. Ids are looked up as the fact looks
    them up: hot ones are spread, and only a counted few are broadcast.
    """
    changed = {}
    for name, id_column, key, _ in LOOKED_UP:
        before, after = (
            d[name].where(F.col(id_column).isNotNull()).select(id_column, key) for d in (old, new)
        )
        changed[name] = differing(before, after, id_column)
    rows = row_counts(changed)
    lookups, found = [], {}
    for name, id_column, _, uses in LOOKED_UP:
        for use in uses if rows[name] else []:
            value = C.date_key(F.col(use)) if name == "dim_date" else F.col(use)
            found[f"_{use}"] = value
            flag = F.lit(True).alias(f"_is_changed_{use}")
            lookups.append((f"_{use}", changed[name].select(id_column, flag)))
    if not lookups:
        return None
    ids = rentals.select("rental_id", month(), *(c.alias(n) for n, c in found.items()))
    any_changed = reduce(lambda a, b: a | b, (F.col(f"_is_changed{n}").isNotNull() for n in found))
    return lookup_all(ids, lookups, "rental_id").where(any_changed).select("rental_month").distinct()
