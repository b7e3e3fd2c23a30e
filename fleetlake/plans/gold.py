"""The star schema: six dimensions and the rental fact."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions import columns as C
from fleetlake.operators.joins import BROADCAST_ROWS, Keep, as_it_is, lookup_all
from fleetlake.operators.keys import surrogate_key

# Puts a key of the second name, by the id of the first, before a table's columns.
Number = Callable[[DataFrame, str, str], DataFrame]

# The days that the calendar covers.
FIRST_DAY, LAST_DAY = date(2020, 1, 1), date(2030, 12, 31)


def dim_date(spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY) -> DataFrame:
    """One row per day, 4018 in all by default; the week starts on Sunday = 0."""
    days = (last - first).days + 1
    day = F.date_add(F.lit(first), F.col("id").cast("int"))
    weekday = F.dayofweek("full_date") - 1
    return spark.range(0, days, 1, 1).select(day.alias("full_date")).select(
        C.date_key(F.col("full_date")).alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.month("full_date").alias("month"),
        F.day("full_date").alias("day"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        weekday.alias("day_of_week"),
        F.when(weekday.isin(0, 6), "Weekend").otherwise("Weekday").alias("day_type"),
    )


def dim_car(cars: DataFrame, number: Number = surrogate_key) -> DataFrame:
    kept = cars.select(
        "car_id", "brand", "model", "year", "color", "license_plate", "vin", "status",
        "daily_rental_price", "current_location_id", "purchase_date", "purchase_price",
    )
    return number(kept, "car_id", "car_key")


def dim_client(customers: DataFrame, number: Number = surrogate_key) -> DataFrame:
    kept = customers.select(
        "customer_id", "first_name", "last_name",
        C.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "email", "phone", "city", "loyalty_level", "date_of_birth", "driving_license",
        "license_issue_date", "license_expiry_date", "registration_date",
    )
    return number(kept, "customer_id", "client_key")


def dim_employee(employees: DataFrame, number: Number = surrogate_key) -> DataFrame:
    kept = employees.select(
        "employee_id",
        C.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"),
        "email", "position", "hire_date", "is_active",
    )
    return number(kept, "employee_id", "employee_key")


def dim_location(locations: DataFrame, number: Number = surrogate_key) -> DataFrame:
    kept = locations.select("location_id", "city", "address", "opening_hours", "is_active")
    return number(kept, "location_id", "location_key")


def dim_tariff(tariffs: DataFrame, number: Number = surrogate_key) -> DataFrame:
    kept = tariffs.select(
        "tariff_id", "tariff_name", "base_price_per_day", "km_included_per_day",
        "additional_km_price", "min_rental_days", "insurance_type", "cancellation_policy",
    )
    return number(kept, "tariff_id", "tariff_key")


DIMENSIONS = {
    "dim_date": lambda silver: dim_date(silver["rentals"].sparkSession),
    "dim_car": lambda silver: dim_car(silver["cars"]),
    "dim_client": lambda silver: dim_client(silver["customers"]),
    "dim_employee": lambda silver: dim_employee(silver["employees"]),
    "dim_location": lambda silver: dim_location(silver["locations"]),
    "dim_tariff": lambda silver: dim_tariff(silver["tariffs"]),
}


# Dimensions whose keys may be kept over refreshes: their source, id and key.
KEYED = {
    "dim_car": (dim_car, "cars", "car_id", "car_key"),
    "dim_client": (dim_client, "customers", "customer_id", "client_key"),
    "dim_employee": (dim_employee, "employees", "employee_id", "employee_key"),
    "dim_location": (dim_location, "locations", "location_id", "location_key"),
    "dim_tariff": (dim_tariff, "tariffs", "tariff_id", "tariff_key"),
}


def registry_name(dimension: str) -> str:
    return dimension.replace("dim_", "keys_")


def build_dims(silver: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build(silver) for name, build in DIMENSIONS.items()}


def payment_rollup(payments: DataFrame) -> DataFrame:
    """Completed payments per rental: sum, count and distinct methods."""
    return (
        payments.where(F.col("status") == "Completed")
        .groupBy("rental_id")
        .agg(
            F.sum("amount").cast("decimal(18,2)").alias("total_paid"),
            F.count("*").alias("payment_count"),
            F.count_distinct("payment_method").alias("unique_payment_methods"),
        )
    )


def with_payments(rentals: DataFrame, payments: DataFrame) -> DataFrame:
    """Add the payment rollup; a rental without completed payments gets zeros."""
    return with_rollup(rentals, payment_rollup(payments))


def with_rollup(rentals: DataFrame, rollup: DataFrame) -> DataFrame:
    """Both sides hold a rental at most once, so the join has no hot key."""
    return _with_totals(rentals.join(rollup, "rental_id", "left"))


def _with_totals(joined: DataFrame) -> DataFrame:
    totals = ["total_paid", "payment_count", "unique_payment_methods"]
    return joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in totals}).withColumn(
        "total_paid", F.col("total_paid").cast("decimal(18,2)")
    )


def with_date_keys(rentals: DataFrame, calendar: DataFrame) -> DataFrame:
    """Keys of the rental and actual return days; null outside the calendar."""
    keys = F.broadcast(calendar.select("date_key"))  # one row per day of a fixed range
    for day, key in (
        ("rental_date", "rental_date_key"),
        ("actual_return_date", "actual_return_date_key"),
    ):
        found = keys.withColumnRenamed("date_key", key)
        rentals = rentals.join(found, C.date_key(F.col(day)) == F.col(key), "left")
    return rentals


def with_dim_keys(
    rentals: DataFrame,
    dims: Mapping[str, DataFrame],
    broadcast_rows: int = BROADCAST_ROWS,
    rollup: DataFrame | None = None,
    keep: Keep = as_it_is,
) -> DataFrame:
    """Surrogate keys of car, client, employee, tariff and both locations, then the rollup's columns."""

    def pairs(dim: str, natural: str, key: str, name: str) -> DataFrame:
        return dims[dim].select(natural, F.col(key).alias(name))

    lookups = [
        ("car_id", pairs("dim_car", "car_id", "car_key", "car_key")),
        ("customer_id", pairs("dim_client", "customer_id", "client_key", "client_key")),
        ("employee_id", pairs("dim_employee", "employee_id", "employee_key", "employee_key")),
        ("tariff_id", pairs("dim_tariff", "tariff_id", "tariff_key", "tariff_key")),
        (
            "pickup_location_id",
            pairs("dim_location", "location_id", "location_key", "pickup_location_key"),
        ),
        (
            "return_location_id",
            pairs("dim_location", "location_id", "location_key", "return_location_key"),
        ),
    ]
    return lookup_all(rentals, lookups, "rental_id", broadcast_rows, rollup, keep)


def with_duration(rentals: DataFrame) -> DataFrame:
    """Days between the rental and the actual return, null if either is missing."""
    return rentals.withColumn("duration_days", F.datediff("actual_return_date", "rental_date"))


def fact_rentals(
    rentals: DataFrame,
    payments: DataFrame,
    dims: Mapping[str, DataFrame],
    broadcast_rows: int = BROADCAST_ROWS,
    keep: Keep = as_it_is,
) -> DataFrame:
    """One row per rental: dimension keys, measures and the payment rollup.

    Rentals and payments meet in one join on the unique rental id, by which rentals
    are shuffled once for it and the large lookups. ``keep`` may store the payments by
    rental and what large lookups find.
    """
    return fact_of_rollup(rentals, keep(payment_rollup(payments)), dims, broadcast_rows, keep)


def fact_of_rollup(
    rentals: DataFrame,
    rollup: DataFrame,
    dims: Mapping[str, DataFrame],
    broadcast_rows: int = BROADCAST_ROWS,
    keep: Keep = as_it_is,
) -> DataFrame:
    """The fact from payments that are rolled up already."""
    keyed = with_dim_keys(rentals, dims, broadcast_rows, rollup, keep)
    keyed = with_date_keys(with_duration(keyed), dims["dim_date"])
    return _with_totals(keyed).select(
        "rental_id", "car_key", "client_key", "employee_key", "tariff_key",
        "pickup_location_key", "return_location_key", "rental_date_key",
        "actual_return_date_key", "rental_days", "total_cost", "base_cost",
        "additional_km_cost",
        F.coalesce("deposit_returned", F.lit(0)).cast("decimal(10,2)").alias("deposit_returned"),
        "status", "km_driven", "additional_km", "scheduled_return_date", "is_late_return",
        "late_days", "rental_date", "actual_return_date", "duration_days", "total_paid",
        "payment_count", "unique_payment_methods",
    )
