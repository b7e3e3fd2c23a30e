"""Table schemas, keys and references of the raw, silver and gold layers.

Identifiers and surrogate keys are BIGINT: a 32-bit id runs out long before
the row counts these jobs are meant for.
"""

from __future__ import annotations

import re

# Column names, order and raw types of the eight source tables.
RAW = {
    "locations": (
        "location_id bigint, city varchar(100), address string, phone varchar(20), "
        "opening_hours varchar(50), is_active varchar(10)"
    ),
    "cars": (
        "car_id bigint, brand varchar(50), model varchar(50), year int, color varchar(30), "
        "license_plate varchar(20), vin varchar(50), current_location_id bigint, "
        "purchase_date varchar(20), purchase_price decimal(10,2), daily_rental_price decimal(10,2), "
        "fuel_type varchar(20), transmission varchar(20), seats int, status varchar(20), mileage int"
    ),
    "customers": (
        "customer_id bigint, first_name varchar(100), last_name varchar(100), email varchar(150), "
        "phone varchar(20), date_of_birth varchar(20), driving_license varchar(50), "
        "license_issue_date varchar(20), license_expiry_date varchar(20), address string, "
        "city varchar(100), registration_date varchar(20), loyalty_level varchar(20)"
    ),
    "employees": (
        "employee_id bigint, first_name varchar(100), last_name varchar(100), email varchar(150), "
        "phone varchar(20), position varchar(50), hire_date varchar(20), salary decimal(10,2), "
        "location_id bigint, is_active varchar(10)"
    ),
    "tariffs": (
        "tariff_id bigint, tariff_name varchar(50), base_price_per_day decimal(10,2), "
        "km_included_per_day int, additional_km_price decimal(10,2), deposit_amount decimal(10,2), "
        "min_rental_days int, max_rental_days int, insurance_type varchar(30), "
        "cancellation_policy varchar(30)"
    ),
    "rentals": (
        "rental_id bigint, car_id bigint, customer_id bigint, employee_id bigint, tariff_id bigint, "
        "pickup_location_id bigint, return_location_id bigint, rental_date varchar(20), "
        "scheduled_return_date varchar(20), actual_return_date varchar(20), rental_days int, "
        "km_driven int, additional_km int, base_cost decimal(10,2), additional_km_cost decimal(10,2), "
        "total_cost decimal(10,2), deposit_amount decimal(10,2), deposit_returned decimal(10,2), "
        "status varchar(20), notes string"
    ),
    "payments": (
        "payment_id bigint, rental_id bigint, payment_date varchar(20), payment_method varchar(30), "
        "amount decimal(10,2), payment_type varchar(30), status varchar(20)"
    ),
    "car_condition": (
        "condition_id bigint, car_id bigint, entry_date varchar(20), entry_type varchar(20), "
        "description string, cost decimal(10,2), reported_by varchar(30), is_repaired varchar(10), "
        "repair_date varchar(20), notes string"
    ),
}

# The columns whose silver type is not the raw one, and the added columns.
_SILVER_TYPES = {
    "locations": {"is_active": "boolean"},
    "cars": {"purchase_date": "date"},
    "customers": {
        "date_of_birth": "date",
        "license_issue_date": "date",
        "license_expiry_date": "date",
        "registration_date": "date",
    },
    "employees": {"hire_date": "date", "is_active": "boolean"},
    "tariffs": {},
    "rentals": {
        "rental_date": "date",
        "scheduled_return_date": "date",
        "actual_return_date": "date",
    },
    "payments": {"payment_date": "timestamp_ntz"},
    "car_condition": {
        "entry_date": "timestamp_ntz",
        "is_repaired": "boolean",
        "repair_date": "date",
    },
}
_AUDIT = {"created_at": "timestamp_ntz", "updated_at": "timestamp_ntz"}
_RENTAL_FEATURES = {"is_late_return": "boolean", "late_days": "int"}

# Text that is neither a true nor a false word becomes this value; null elsewhere.
BOOLEAN_ELSE = {("rentals", "is_late_return"): False}

# Primary keys and references between silver tables, as
# (constraint, child, column, parent); parents are referenced by primary key.
PRIMARY_KEYS = {
    "locations": "location_id",
    "cars": "car_id",
    "customers": "customer_id",
    "employees": "employee_id",
    "tariffs": "tariff_id",
    "rentals": "rental_id",
    "payments": "payment_id",
    "car_condition": "condition_id",
}
FOREIGN_KEYS = [
    ("fk_cars_location", "cars", "current_location_id", "locations"),
    ("fk_employees_location", "employees", "location_id", "locations"),
    ("fk_rentals_car", "rentals", "car_id", "cars"),
    ("fk_rentals_customer", "rentals", "customer_id", "customers"),
    ("fk_rentals_employee", "rentals", "employee_id", "employees"),
    ("fk_rentals_tariff", "rentals", "tariff_id", "tariffs"),
    ("fk_rentals_pickup_location", "rentals", "pickup_location_id", "locations"),
    ("fk_rentals_return_location", "rentals", "return_location_id", "locations"),
    ("fk_payments_rental", "payments", "rental_id", "rentals"),
    ("fk_car_condition_car", "car_condition", "car_id", "cars"),
]

# Keys and references of the star schema.
GOLD_PRIMARY_KEYS = {
    "dim_date": "date_key",
    "dim_car": "car_key",
    "dim_client": "client_key",
    "dim_employee": "employee_key",
    "dim_location": "location_key",
    "dim_tariff": "tariff_key",
    "fact_rentals": "rental_id",
}
GOLD_FOREIGN_KEYS = [
    ("fk_fact_car", "fact_rentals", "car_key", "dim_car"),
    ("fk_fact_client", "fact_rentals", "client_key", "dim_client"),
    ("fk_fact_employee", "fact_rentals", "employee_key", "dim_employee"),
    ("fk_fact_tariff", "fact_rentals", "tariff_key", "dim_tariff"),
    ("fk_fact_pickup_location", "fact_rentals", "pickup_location_key", "dim_location"),
    ("fk_fact_return_location", "fact_rentals", "return_location_key", "dim_location"),
    ("fk_fact_rental_date", "fact_rentals", "rental_date_key", "dim_date"),
    ("fk_fact_actual_return_date", "fact_rentals", "actual_return_date_key", "dim_date"),
]

TABLES = list(RAW)


def raw_types(table: str) -> dict[str, str]:
    """Column name -> raw type, where ``varchar(n)`` carries a length rule."""
    return dict(column.split(" ") for column in RAW[table].split(", "))


def raw_schema(table: str) -> str:
    """The raw schema as Spark DDL; text lengths are checked apart from it."""
    return ", ".join(
        f"{name} {re.sub(r'varchar.*', 'string', kind)}" for name, kind in raw_types(table).items()
    )


def max_lengths(table: str) -> dict[str, int]:
    return {
        name: int(kind[len("varchar(") : -1])
        for name, kind in raw_types(table).items()
        if kind.startswith("varchar(")
    }


def silver_types(table: str) -> dict[str, str]:
    """Column name -> silver type, in table order."""
    types = {
        name: "string" if kind.startswith("varchar") else kind
        for name, kind in raw_types(table).items()
    }
    types |= _SILVER_TYPES[table] | _AUDIT
    return types | _RENTAL_FEATURES if table == "rentals" else types
