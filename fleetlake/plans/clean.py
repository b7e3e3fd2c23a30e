"""Cleaning jobs: one per source table, text columns in, typed columns out.

No job drops a row. Columns that a job does not mention pass through as they
came; the silver layer types them. Every job is a narrow pass over the scan,
plus a small aggregate where a median is filled in or duplicates are found.
These may be found in a stored copy of the columns that they need (``copy``), so that a
source which is slow to read is read for them but once.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions import columns as C
from fleetlake.operators.medians import fill_with_median


def _amounts(
    df: DataFrame, bounds: dict[str, tuple[float, float]], copy: DataFrame | None = None
) -> DataFrame:
    """Coerce, drop the sign, fill with the median (of the unbounded values), then bound."""
    sizes = {c: F.abs(C.number(F.col(c))) for c in bounds}
    seen = None if copy is None else copy.select(*(v.alias(c) for c, v in sizes.items()))
    filled = fill_with_median(df.withColumns(sizes), list(bounds), seen)
    return filled.withColumns(
        {c: C.clip(F.col(c), float(low), float(high)) for c, (low, high) in bounds.items()}
    )


def _stamped(df: DataFrame, run_ts: datetime) -> DataFrame:
    return df.withColumns({"created_at": C.moment(run_ts), "updated_at": C.moment(run_ts)})


def clean_locations(df: DataFrame, *, run_ts: datetime) -> DataFrame:
    return _stamped(df.withColumn("is_active", C.flag(F.col("is_active"), True)), run_ts)


# Accepted ranges and defaults of the car fields.
CAR_PRICE_BOUNDS = {"purchase_price": (10_000, 200_000), "daily_rental_price": (10, 500)}


def clean_cars(
    df: DataFrame,
    *,
    run_ts: datetime,
    price_bounds=CAR_PRICE_BOUNDS,
    copy: DataFrame | None = None,
) -> DataFrame:
    cleaned = _amounts(df, price_bounds, copy).withColumns(
        {
            "purchase_date": C.iso_date(F.col("purchase_date")),
            "year": C.whole(C.number(F.col("year")), 2020, 2010, 2024),
            "mileage": C.whole(C.number(F.col("mileage")), 0, 0, 500_000),
            "status": F.coalesce("status", F.lit("Available")),
        }
    )
    return _stamped(cleaned, run_ts)


def mark_shared_licenses(df: DataFrame, copy: DataFrame | None = None) -> DataFrame:
    """Append the customer id to every licence that several rows hold; null counts as ''.

    The licences held once are found by aggregation, and rows are matched to
    them by id and licence. So neither step brings the rows of one licence
    together, even if most customers have none.
    """
    license_ = F.coalesce("driving_license", F.lit(""))
    filled = df.withColumn("driving_license", license_)
    single = (
        (df if copy is None else copy)
        .withColumn("driving_license", license_)
        .groupBy("driving_license")
        .agg(F.count("*").alias("_holders"), F.min("customer_id").alias("_only"))
        .where("_holders = 1")
        .select(F.col("driving_license").alias("_license"), "_only")
    )
    same = (F.col("driving_license") == F.col("_license")) & F.col("customer_id").eqNullSafe(
        F.col("_only")
    )
    marked = F.concat_ws("_", "driving_license", "customer_id")
    return (
        filled.join(single, same, "left")
        .withColumn(
            "driving_license",
            F.when(F.col("_license").isNull(), marked).otherwise(F.col("driving_license")),
        )
        .drop("_license", "_only")
    )


def clean_customers(
    df: DataFrame,
    *,
    run_ts: datetime,
    as_of: date | None = None,
    copy: DataFrame | None = None,
) -> DataFrame:
    as_of = as_of or run_ts.date()
    dates = ["date_of_birth", "license_issue_date", "license_expiry_date", "registration_date"]
    cleaned = df.withColumns({c: C.iso_date(F.col(c)) for c in dates}).withColumns(
        {
            "date_of_birth": C.adult_birth_date(F.col("date_of_birth"), as_of),
            "email": C.email(F.col("email"), "unknown@example.com"),
        }
    )
    return _stamped(mark_shared_licenses(cleaned, copy), run_ts)


# Accepted range of salaries.
SALARY_BOUNDS = {"salary": (500, 5_000)}


def clean_employees(
    df: DataFrame,
    *,
    run_ts: datetime,
    salary_bounds=SALARY_BOUNDS,
    copy: DataFrame | None = None,
) -> DataFrame:
    cleaned = _amounts(df, salary_bounds, copy).withColumns(
        {
            "hire_date": C.iso_date(F.col("hire_date")),
            "is_active": C.flag(F.col("is_active"), True),
            "email": C.email(F.col("email"), "employee@rental.by"),
        }
    )
    return _stamped(cleaned, run_ts)


# Accepted ranges of the tariff prices.
TARIFF_BOUNDS = {
    "base_price_per_day": (10, 500),
    "additional_km_price": (0.1, 10),
    "deposit_amount": (100, 3_000),
}


def clean_tariffs(
    df: DataFrame,
    *,
    run_ts: datetime,
    price_bounds=TARIFF_BOUNDS,
    copy: DataFrame | None = None,
) -> DataFrame:
    limits = ["km_included_per_day", "min_rental_days", "max_rental_days"]
    cleaned = _amounts(df, price_bounds, copy).withColumns(
        {c: C.whole(C.number(F.col(c)), 1) for c in limits}
    )
    cleaned = cleaned.withColumn(
        "max_rental_days", F.greatest("min_rental_days", "max_rental_days")
    )
    return _stamped(cleaned, run_ts)


def clean_rentals(df: DataFrame, *, run_ts: datetime) -> DataFrame:
    rented = F.col("rental_date")
    dates = ["rental_date", "scheduled_return_date", "actual_return_date"]
    numbers = ["rental_days", "km_driven", "additional_km", "deposit_amount", "deposit_returned"]
    costs = ["base_cost", "additional_km_cost", "total_cost"]
    parsed = df.withColumns(
        {c: C.iso_date(F.col(c)) for c in dates}
        | {c: C.number(F.col(c)) for c in numbers}
        | {c: F.abs(C.number(F.col(c))) for c in costs}
    )
    repaired = parsed.withColumns(
        {c: C.not_before(F.col(c), rented) for c in dates[1:]}
        | {
            "deposit_returned": C.clip_to(F.col("deposit_returned"), 0.0, F.col("deposit_amount")),
            "total_cost": F.coalesce(
                "total_cost", F.col("base_cost") + F.col("additional_km_cost")
            ),
        }
    )
    scheduled, actual = F.col("scheduled_return_date"), F.col("actual_return_date")
    booked = F.datediff(scheduled, rented).cast("double")
    finished = repaired.withColumns(
        {
            "rental_days": C.whole(F.coalesce("rental_days", booked), 1, low=1),
            "km_driven": C.whole(F.col("km_driven"), 100),
            "additional_km": C.whole(F.col("additional_km"), 0),
            "status": F.coalesce("status", F.lit("Completed")),
            "notes": F.coalesce("notes", F.lit("")),
        }
    )
    return _stamped(finished, run_ts).withColumns(
        {"is_late_return": C.is_late(actual, scheduled), "late_days": C.late_days(actual, scheduled)}
    )


# Accepted range of one payment.
PAYMENT_BOUNDS = {"amount": (0, 10_000)}


def clean_payments(
    df: DataFrame,
    *,
    run_ts: datetime,
    amount_bounds=PAYMENT_BOUNDS,
    copy: DataFrame | None = None,
) -> DataFrame:
    cleaned = _amounts(df, amount_bounds, copy).withColumns(
        {
            "payment_date": C.iso_timestamp(F.col("payment_date")),
            "status": F.coalesce("status", F.lit("Completed")),
            "payment_method": F.coalesce("payment_method", F.lit("Cash")),
            "payment_type": F.coalesce("payment_type", F.lit("Rental")),
        }
    )
    return _stamped(cleaned, run_ts)


# Accepted range of one repair or service.
CONDITION_BOUNDS = {"cost": (0, 20_000)}


def clean_car_condition(
    df: DataFrame,
    *,
    run_ts: datetime,
    cost_bounds=CONDITION_BOUNDS,
    copy: DataFrame | None = None,
) -> DataFrame:
    dates = {c: C.iso_timestamp(F.col(c)) for c in ("entry_date", "repair_date")}
    repaired = C.not_before(F.col("repair_date"), F.col("entry_date")).cast("date")
    cleaned = (
        _amounts(df.withColumns(dates), cost_bounds, copy)
        .withColumn("repair_date", repaired)
        .withColumns(
            {
                "is_repaired": F.col("repair_date").isNotNull()
                | C.flag(F.col("is_repaired"), False),
                "entry_type": F.coalesce("entry_type", F.lit("Maintenance")),
                "description": F.coalesce("description", F.lit("Regular check")),
                "reported_by": F.coalesce("reported_by", F.lit("Employee")),
                "notes": F.coalesce("notes", F.lit("")),
            }
        )
    )
    return _stamped(cleaned, run_ts)


CLEANERS = {
    "locations": clean_locations,
    "cars": clean_cars,
    "customers": clean_customers,
    "employees": clean_employees,
    "tariffs": clean_tariffs,
    "rentals": clean_rentals,
    "payments": clean_payments,
    "car_condition": clean_car_condition,
}

# The columns in which jobs find medians or shared licences, before they read the whole table.
READ_AGAIN = {
    "cars": list(CAR_PRICE_BOUNDS),
    "customers": ["customer_id", "driving_license"],
    "employees": list(SALARY_BOUNDS),
    "tariffs": list(TARIFF_BOUNDS),
    "payments": list(PAYMENT_BOUNDS),
    "car_condition": list(CONDITION_BOUNDS),
}
