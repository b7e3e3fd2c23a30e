"""The cleaning jobs on hand-made rows."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.plans import clean
from fleetlake.plans.silver import cast_silver
from tests.conftest import final_plan

RUN = datetime(2026, 1, 1, 12, 30)
D = date


def text_table(spark, table, rows):
    """Rows as dicts of text; columns that are not given are null."""
    names = list(schemas.raw_types(table))
    schema = ", ".join(f"{n} string" for n in names)
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


def by_id(df, key):
    return {r[key]: r for r in df.collect()}


def test_locations(spark):
    rows = [
        {"location_id": "1", "phone": "+375", "is_active": "false"},
        {"location_id": "2", "is_active": None},
    ]
    got = by_id(clean.clean_locations(text_table(spark, "locations", rows), run_ts=RUN), "location_id")
    assert got["1"]["is_active"] is False and got["2"]["is_active"] is True
    assert got["1"]["phone"] == "+375"
    assert got["1"]["created_at"] == got["1"]["updated_at"] == RUN


def test_cars(spark):
    rows = [
        {"car_id": "1", "year": "2031", "purchase_price": "-50000", "daily_rental_price": "5", "mileage": "3.7"},
        {"car_id": "2", "year": "n/k", "purchase_price": None, "daily_rental_price": "800", "mileage": "-20"},
        {"car_id": "3", "year": "2015.9", "purchase_price": "900000", "daily_rental_price": "x",
         "mileage": "900000", "status": "Rented", "purchase_date": "2024-02-30"},
    ]
    got = by_id(clean.clean_cars(text_table(spark, "cars", rows), run_ts=RUN), "car_id")
    assert [got[k]["year"] for k in "123"] == [2024, 2020, 2015]
    # the median (475000) is taken before the bounds are applied
    assert [got[k]["purchase_price"] for k in "123"] == [50000, 200000, 200000]
    assert [got[k]["daily_rental_price"] for k in "123"] == [10, 500, 402.5]
    assert [got[k]["mileage"] for k in "123"] == [3, 0, 500000]
    assert [got[k]["status"] for k in "123"] == ["Available", "Available", "Rented"]
    assert got["3"]["purchase_date"] is None


def test_car_bounds_are_parameters(spark):
    rows = [{"car_id": "1", "daily_rental_price": "800", "purchase_price": "20000"}]
    wide = {"purchase_price": (0, 1e9), "daily_rental_price": (0, 1e9)}
    df = clean.clean_cars(text_table(spark, "cars", rows), run_ts=RUN, price_bounds=wide)
    assert df.first()["daily_rental_price"] == 800


@pytest.mark.parametrize(
    ("licenses", "expected"),
    [
        ({1: "A", 2: "A", 3: "B", 4: None, 5: None}, {1: "A_1", 2: "A_2", 3: "B", 4: "_4", 5: "_5"}),
        ({1: "A", 2: None}, {1: "A", 2: ""}),
    ],
)
def test_shared_licenses(spark, licenses, expected):
    rows = [{"customer_id": str(i), "driving_license": v} for i, v in licenses.items()]
    got = by_id(clean.mark_shared_licenses(text_table(spark, "customers", rows)), "customer_id")
    assert {int(k): r["driving_license"] for k, r in got.items()} == expected


def test_shared_licenses_keep_rows_with_repeated_ids(spark):
    rows = [
        {"customer_id": "1", "driving_license": "A"},
        {"customer_id": "1", "driving_license": "B"},
        {"customer_id": None, "driving_license": "C"},
        {"customer_id": "2", "driving_license": "D"},
        {"customer_id": "2", "driving_license": "D"},
    ]
    got = clean.mark_shared_licenses(text_table(spark, "customers", rows)).collect()
    assert sorted(r["driving_license"] for r in got) == ["A", "B", "C", "D_2", "D_2"]


def test_shared_licenses_join_on_customer_not_on_license(spark, shuffled_joins):
    """A licence held by most customers is never gathered: the shuffle key has the id in it."""
    rows = [{"customer_id": str(i), "driving_license": None} for i in range(900)]
    rows += [{"customer_id": str(i), "driving_license": f"L{i}"} for i in range(900, 1000)]
    marked = clean.mark_shared_licenses(text_table(spark, "customers", rows))
    sizes = marked.groupBy(F.spark_partition_id()).count().collect()
    assert marked.where("driving_license = concat('_', customer_id)").count() == 900
    assert max(r["count"] for r in sizes) < 300


def test_customers(spark):
    rows = [{"customer_id": "1", "email": "A@B.C", "date_of_birth": "2015-01-01", "license_expiry_date": "soon"},
            {"customer_id": "2", "date_of_birth": "1980-01-01", "driving_license": "Q"}]
    df = clean.clean_customers(text_table(spark, "customers", rows), run_ts=RUN, as_of=D(2026, 1, 1))
    got = by_id(df, "customer_id")
    assert got["1"]["email"] == "a@b.c" and got["2"]["email"] == "unknown@example.com"
    assert got["1"]["date_of_birth"] == D(2001, 1, 7) and got["2"]["date_of_birth"] == D(1980, 1, 1)
    assert got["1"]["license_expiry_date"] is None


def test_tariffs(spark):
    rows = [
        {"tariff_id": "1", "base_price_per_day": "20", "additional_km_price": "0", "deposit_amount": "-50",
         "min_rental_days": "3", "max_rental_days": "1", "km_included_per_day": "many"},
        {"tariff_id": "2", "base_price_per_day": None, "additional_km_price": "3", "deposit_amount": "9000",
         "min_rental_days": None, "max_rental_days": "30", "km_included_per_day": "200.9"},
    ]
    got = by_id(clean.clean_tariffs(text_table(spark, "tariffs", rows), run_ts=RUN), "tariff_id")
    assert [got[k]["base_price_per_day"] for k in "12"] == [20, 20]
    assert [got[k]["additional_km_price"] for k in "12"] == [0.1, 3]
    assert [got[k]["deposit_amount"] for k in "12"] == [100, 3000]
    assert [(got[k]["min_rental_days"], got[k]["max_rental_days"]) for k in "12"] == [(3, 3), (1, 30)]
    assert [got[k]["km_included_per_day"] for k in "12"] == [1, 200]


def test_rentals(spark):
    base = {"rental_date": "2024-05-01", "scheduled_return_date": "2024-05-04", "actual_return_date": "2024-05-06"}
    rows = [
        base | {"rental_id": "1", "base_cost": "10", "additional_km_cost": "2", "km_driven": "70.9"},
        base | {"rental_id": "2", "base_cost": "10", "total_cost": None, "rental_days": "0"},
        base | {"rental_id": "3", "total_cost": "-5", "rental_days": "-2", "deposit_returned": "200", "deposit_amount": "10"},
        base | {"rental_id": "4", "scheduled_return_date": "2024-04-01", "actual_return_date": "2024-04-30"},
        {"rental_id": "5", "deposit_returned": "-5", "status": "Active", "notes": "n"},
    ]
    got = by_id(clean.clean_rentals(text_table(spark, "rentals", rows), run_ts=RUN), "rental_id")
    assert [got[k]["total_cost"] for k in "123"] == [12, None, 5]
    assert [got[k]["rental_days"] for k in "12345"] == [3, 1, 1, 1, 1]
    assert got["3"]["deposit_returned"] == 10 and got["5"]["deposit_returned"] == 0
    assert (got["1"]["is_late_return"], got["1"]["late_days"]) == (True, 2)
    assert got["4"]["scheduled_return_date"] == got["4"]["actual_return_date"] == D(2024, 5, 2)
    assert (got["4"]["is_late_return"], got["4"]["late_days"]) == (False, 0)
    assert (got["5"]["is_late_return"], got["5"]["late_days"]) == (False, None)
    assert [got[k]["km_driven"] for k in "12"] == [70, 100] and got["1"]["additional_km"] == 0
    assert [got[k]["status"] for k in "15"] == ["Completed", "Active"]
    assert [got[k]["notes"] for k in "15"] == ["", "n"]


def test_rentals_is_one_narrow_pass(spark):
    df = clean.clean_rentals(text_table(spark, "rentals", [{"rental_id": "1"}]), run_ts=RUN)
    plan = final_plan(df)
    assert "Exchange" not in plan and "Python" not in plan


def test_payments(spark):
    rows = [
        {"payment_id": "1", "amount": "5"},
        {"payment_id": "2", "amount": "20000", "payment_date": "2024-05-01"},
        {"payment_id": "3", "amount": None, "status": "Failed", "payment_method": "Card", "payment_type": "Deposit"},
        {"payment_id": "4", "amount": "-7"},
    ]
    got = by_id(clean.clean_payments(text_table(spark, "payments", rows), run_ts=RUN), "payment_id")
    assert [got[k]["amount"] for k in "1234"] == [5, 10000, 7, 7]
    assert got["2"]["payment_date"] == datetime(2024, 5, 1)
    filled = got["1"]
    assert (filled["status"], filled["payment_method"], filled["payment_type"]) == ("Completed", "Cash", "Rental")
    kept = got["3"]
    assert (kept["status"], kept["payment_method"], kept["payment_type"]) == ("Failed", "Card", "Deposit")


def test_car_condition(spark):
    rows = [
        {"condition_id": "1", "entry_date": "2024-05-10", "repair_date": "2024-05-01", "is_repaired": "false", "cost": "-30000"},
        {"condition_id": "2", "entry_date": "2024-05-10", "is_repaired": "true", "cost": "10"},
        {"condition_id": "3", "entry_date": "2024-05-10 15:00:00", "repair_date": "2024-05-10"},
    ]
    df = clean.clean_car_condition(text_table(spark, "car_condition", rows), run_ts=RUN)
    got = by_id(df, "condition_id")
    assert got["1"]["repair_date"] == D(2024, 5, 11) and got["1"]["is_repaired"] is True
    assert got["2"]["repair_date"] is None and got["2"]["is_repaired"] is True
    assert got["3"]["repair_date"] == D(2024, 5, 11)  # midnight comes before 15:00
    assert [got[k]["cost"] for k in "123"] == [20000, 10, 15005]
    assert (got["1"]["entry_type"], got["1"]["description"], got["1"]["reported_by"]) == (
        "Maintenance", "Regular check", "Employee",
    )


def test_silver_types_and_fail_fast(spark):
    rows = [{"payment_id": "1", "rental_id": "2", "amount": "1.005", "payment_date": "2024-05-01"}]
    df = clean.clean_payments(text_table(spark, "payments", rows), run_ts=RUN)
    typed = cast_silver("payments", df)
    assert dict(typed.dtypes) == schemas.silver_types("payments")
    assert str(typed.first()["amount"]) == "1.01"  # half away from zero, by the text's digits
    bad = cast_silver("payments", df.withColumn("rental_id", F.lit("3.0")))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.collect()


def test_silver_reads_boolean_words(spark):
    rows = [{"location_id": str(i), "is_active": w} for i, w in enumerate(["T", "no", "maybe"])]
    df = text_table(spark, "locations", rows).withColumns(
        {c: F.lit("2026-01-01 00:00:00") for c in ("created_at", "updated_at")}
    )
    got = by_id(cast_silver("locations", df), "location_id")
    assert [got[i]["is_active"] for i in range(3)] == [True, False, None]


def test_no_job_drops_or_repeats_a_row(spark):
    for table, job in clean.CLEANERS.items():
        key = schemas.PRIMARY_KEYS[table]
        rows = [{key: str(i % 7)} for i in range(20)]
        assert job(text_table(spark, table, rows), run_ts=RUN).count() == 20, table


def test_medians_and_licences_of_a_copy(spark):
    """A stored copy of the columns in READ_AGAIN gives what the table gives."""
    values = [None, "5", "-7.5", "x", "1200", "1300", "90000", "64", "64"]
    for table, columns in clean.READ_AGAIN.items():
        key = schemas.PRIMARY_KEYS[table]
        rows = [{key: str(i // 2)} | dict.fromkeys([c for c in columns if c != key], v) for i, v in enumerate(values)]
        df = text_table(spark, table, rows)
        job = clean.CLEANERS[table]
        whole = sorted(map(repr, job(df, run_ts=RUN).collect()))
        assert sorted(map(repr, job(df, run_ts=RUN, copy=df.select(*columns)).collect())) == whole, table
