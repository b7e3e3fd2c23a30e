"""The nine reports over the star schema.

``total_cost`` is revenue billed, ``total_paid`` money received. Every status
counts. The fact is aggregated by dimension key before it meets the dimension:
the join then sees each key once, and no fact row is shuffled whole.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(20,2)"


def _total(name: str) -> Column:
    return F.sum(name).cast(MONEY)


def _per_key(fact: DataFrame, key: str, *measures: str) -> DataFrame:
    """Rentals and summed measures per dimension key; rows without a key drop out."""
    return (
        fact.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("rentals_count"), *(_total(m).alias(m) for m in measures))
    )


def _regroup(per_key: DataFrame, dim: DataFrame, key: str, by: list[str]):
    return per_key.join(dim.select(key, *by), key).groupBy(*by)


def tariffs(fact: DataFrame, dim_tariff: DataFrame) -> DataFrame:
    by = ["tariff_name", "base_price_per_day"]
    per_key = _per_key(fact, "tariff_key", "total_cost", "total_paid")
    return (
        _regroup(per_key, dim_tariff, "tariff_key", by)
        .agg(
            F.sum("rentals_count").alias("rentals_count"),
            _total("total_cost").alias("total_revenue"),
            _total("total_paid").alias("received_payments"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), *by)
    )


def _top(per_key: DataFrame, dim: DataFrame, key: str, by: list[str], limit: int) -> DataFrame:
    """The groups with most revenue; equal revenue is ordered by the group itself."""
    return (
        _regroup(per_key, dim, key, by)
        .agg(
            F.sum("rentals_count").alias("rentals_count"),
            _total("total_cost").alias("total_revenue"),
        )
        .orderBy(F.desc_nulls_first("total_revenue"), *(F.asc_nulls_last(c) for c in by))
        .limit(limit)
    )


def top_cars(fact: DataFrame, dim_car: DataFrame, limit: int = 10) -> DataFrame:
    by = ["brand", "model", "license_plate", "daily_rental_price"]
    return _top(_per_key(fact, "car_key", "total_cost"), dim_car, "car_key", by, limit)


def top_clients(fact: DataFrame, dim_client: DataFrame, limit: int = 10) -> DataFrame:
    """Grouped by name, city and level, so clients who share all three count as one."""
    by = ["full_name", "city", "loyalty_level"]
    return _top(_per_key(fact, "client_key", "total_cost"), dim_client, "client_key", by, limit)


def brands(fact: DataFrame, dim_car: DataFrame) -> DataFrame:
    return (
        _regroup(_per_key(fact, "car_key"), dim_car, "car_key", ["brand"])
        .agg(F.sum("rentals_count").alias("rentals_count"))
        .orderBy(F.desc("rentals_count"), F.asc_nulls_last("brand"))
    )


def client_cities(fact: DataFrame, dim_client: DataFrame) -> DataFrame:
    return (
        _regroup(_per_key(fact, "client_key"), dim_client, "client_key", ["city"])
        .agg(F.sum("rentals_count").alias("rentals_count"))
        .select(F.col("city").alias("client_city"), "rentals_count")
        .orderBy(F.desc("rentals_count"), F.asc_nulls_last("client_city"))
    )


def _by_month(fact: DataFrame):
    """Grouped by month; the stored fact is partitioned by it, so no column need be read."""
    stored = "rental_month" in fact.columns
    month = F.col("rental_month") if stored else F.trunc("rental_date", "MM")
    return fact.groupBy(month.alias("month"))


def rentals_by_month(fact: DataFrame) -> DataFrame:
    counted = _by_month(fact).agg(F.count("*").alias("rentals_count"))
    return counted.orderBy(F.asc_nulls_last("month"))


def revenue_by_month(fact: DataFrame) -> DataFrame:
    summed = _by_month(fact).agg(_total("total_cost").alias("total_revenue"))
    return summed.orderBy(F.asc_nulls_last("month"))


def employees(fact: DataFrame, dim_employee: DataFrame) -> DataFrame:
    """Grouped by name, so namesakes count as one.

    The average is sum over count at full scale: Spark's decimal ``avg`` rounds
    to six places, which a second rounding could carry over a half cent.
    """
    per_key = (
        fact.where(F.col("employee_key").isNotNull())
        .groupBy("employee_key")
        .agg(
            F.count("*").alias("rentals_count"),
            F.count("total_cost").alias("billed"),
            _total("total_cost").alias("total_cost"),
        )
    )
    average = F.round(F.sum("total_cost").cast("decimal(24,2)") / F.sum("billed"), 2)
    return (
        _regroup(per_key, dim_employee, "employee_key", ["full_name"])
        .agg(
            F.sum("rentals_count").alias("rentals_count"),
            _total("total_cost").alias("total_revenue"),
            average.cast(MONEY).alias("average_rental_value"),
        )
        .withColumnRenamed("full_name", "employee_name")
        .orderBy(F.desc_nulls_first("total_revenue"), F.asc_nulls_last("employee_name"))
    )


def month_year_comparison(fact: DataFrame, years: tuple[int, ...] = (2023, 2024, 2025)) -> DataFrame:
    """Revenue of each calendar month, one column per year; null where there is none."""
    first, end = date(min(years), 1, 1), date(max(years) + 1, 1, 1)
    day = F.col("rental_date")
    chosen = fact.where((day >= F.lit(first)) & (day < F.lit(end)))
    if "rental_month" in fact.columns:  # the stored fact is partitioned by it
        month = F.col("rental_month")
        chosen = chosen.where((month >= F.lit(first)) & (month < F.lit(end)))
    revenue = [
        F.sum(F.when(F.year(day) == year, F.col("total_cost"))).cast(MONEY).alias(f"revenue_{year}")
        for year in years
    ]
    by_month = chosen.groupBy(F.month(day).alias("month_number")).agg(*revenue)
    name = F.date_format(F.make_date(F.lit(years[0]), "month_number", F.lit(1)), "MMMM")
    return by_month.select(
        "month_number", name.alias("month_name"), *(f"revenue_{year}" for year in years)
    ).orderBy("month_number")


def all_reports(gold) -> dict[str, DataFrame]:
    fact = gold["fact_rentals"]
    return {
        "tariffs": tariffs(fact, gold["dim_tariff"]),
        "top_cars": top_cars(fact, gold["dim_car"]),
        "brands": brands(fact, gold["dim_car"]),
        "top_clients": top_clients(fact, gold["dim_client"]),
        "client_cities": client_cities(fact, gold["dim_client"]),
        "rentals_by_month": rentals_by_month(fact),
        "revenue_by_month": revenue_by_month(fact),
        "employees": employees(fact, gold["dim_employee"]),
        "month_year_comparison": month_year_comparison(fact),
    }
