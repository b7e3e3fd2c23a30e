"""The jobs end to end on a directory of small CSV files."""

from datetime import date, datetime
from pathlib import Path

import pytest

from contract import registry
from fleetlake import jobs, schemas
from fleetlake.sources import csv
from fleetlake.sources.layers import IntegrityError, Layer

FILES = {
    "locations": "location_id,city,address,phone,opening_hours,is_active\n1,X,a,+3751,8-20,false\n",
    "cars": (
        "car_id,brand,model,year,color,license_plate,vin,current_location_id,purchase_date,purchase_price,"
        "daily_rental_price,fuel_type,transmission,seats,status,mileage\n"
        "1,B,M,2020,red,P1,V1,1,2020-01-01,50000,100,Petrol,Manual,5,,10\n"
    ),
    "customers": (
        "customer_id,first_name,last_name,email,phone,date_of_birth,driving_license,license_issue_date,"
        "license_expiry_date,address,city,registration_date,loyalty_level\n"
        '1,Ann,"O""Hara",A@X.Y,1,1980-01-01,,2010-01-01,2030-01-01,a,X,2020-01-01,Gold\n'
        "2,Bob,B,,1,,,2010-01-01,2030-01-01,a,X,2020-01-01,Gold\n"
    ),
    "employees": (
        "employee_id,first_name,last_name,email,phone,position,hire_date,salary,location_id,is_active\n"
        "1,E,E,e@x.y,1,Manager,2020-01-01,900,1,true\n"
    ),
    "tariffs": (
        "tariff_id,tariff_name,base_price_per_day,km_included_per_day,additional_km_price,deposit_amount,"
        "min_rental_days,max_rental_days,insurance_type,cancellation_policy\n"
        "1,Eco,20,100,0.5,150,1,30,Full,Strict\n"
    ),
    "rentals": (
        "rental_id,car_id,customer_id,employee_id,tariff_id,pickup_location_id,return_location_id,rental_date,"
        "scheduled_return_date,actual_return_date,rental_days,km_driven,additional_km,base_cost,"
        "additional_km_cost,total_cost,deposit_amount,deposit_returned,status,notes\n"
        "1,1,1,1,1,1,1,2024-05-01,2024-05-04,2024-05-06,3,70,0,60,0,-60,150,100,Completed,\n"
        "2,1,2,1,1,1,1,2024-06-01,2024-06-04,,,,,40,5,,150,,,\n"
    ),
    "payments": (
        "payment_id,rental_id,payment_date,payment_method,amount,payment_type,status\n"
        "1,1,2024-05-01,Cash,60,Deposit,Completed\n2,2,2024-06-01,,-45,,\n"
    ),
    "car_condition": (
        "condition_id,car_id,entry_date,entry_type,description,cost,reported_by,is_repaired,repair_date,notes\n"
        "1,1,2024-05-01,Damage,Dent,100,Customer,false,,\n"
    ),
}


@pytest.fixture
def source(tmp_path):
    directory = tmp_path / "source"
    directory.mkdir()
    for table, text in FILES.items():
        (directory / f"{table}.csv").write_text(text, encoding="utf-8")
    return directory


def test_all_layers(spark, source, tmp_path):
    lake = str(tmp_path / "lake")
    counts = {t: FILES[t].count("\n") - 1 for t in schemas.TABLES}
    assert jobs.load_raw(spark, str(source), lake) == counts
    raw = Layer(spark, lake, "raw").table("rentals")
    assert str(raw.where("rental_id = 1").first()["total_cost"]) == "-60.00"

    options = {"run_ts": datetime(2026, 1, 1, 8), "as_of": date(2026, 1, 1)}
    assert jobs.clean_all(spark, str(source), lake, **options) == counts
    assert jobs.load_silver(spark, lake) == counts
    silver = Layer(spark, lake, "silver").tables(schemas.TABLES)
    for table, df in silver.items():
        assert dict(df.dtypes) == schemas.silver_types(table)
    assert {r["driving_license"] for r in silver["customers"].collect()} == {"_1", "_2"}
    profile = {r["table_name"]: (r["row_count"], r["unique_keys"]) for r in jobs.silver_profile(spark, lake).collect()}
    assert profile == {t: (n, n) for t, n in counts.items()}

    assert jobs.build_gold(spark, lake)["fact_rentals"] == 2
    reports = jobs.run_reports(spark, lake)
    months = {str(r["month"]): str(r["total_revenue"]) for r in reports["revenue_by_month"].collect()}
    assert months == {"2024-05-01": "60.00", "2024-06-01": "45.00"}
    tariff = reports["tariffs"].first()
    assert (tariff["rentals_count"], str(tariff["received_payments"])) == (2, "105.00")
    assert jobs.store_reports(spark, lake)["employees"] == 1


def test_silver_from_cleaned_csv(spark, source, tmp_path):
    """The cleaned tables as CSV load to the same silver rows, empty notes included."""
    lake, cleaned = str(tmp_path / "lake"), str(tmp_path / "cleaned")
    jobs.clean_all(spark, str(source), lake, run_ts=datetime(2026, 1, 1, 8), csv_to=cleaned)
    jobs.load_silver(spark, lake)
    tables = Layer(spark, lake, "silver").tables(schemas.TABLES)
    direct = {t: sorted(map(repr, df.collect())) for t, df in tables.items()}
    jobs.load_silver(spark, lake, processed_csv=cleaned)
    for table, df in Layer(spark, lake, "silver").tables(schemas.TABLES).items():
        assert sorted(map(repr, df.collect())) == direct[table], table


def test_command_line(spark, source, tmp_path, monkeypatch, capsys):
    from fleetlake.__main__ import main

    lake = str(tmp_path / "lake")
    for arguments in (["clean", "--source", str(source)], ["load-silver"]):
        monkeypatch.setattr("sys.argv", ["fleetlake", *arguments, "--lake", lake])
        main()
    printed = capsys.readouterr().out
    assert "rentals              2" in printed and "total" in printed and "unique_keys" in printed
    monkeypatch.setattr("sys.argv", ["fleetlake", "clean", "--lake", lake])
    with pytest.raises(SystemExit):
        main()


def test_broken_references_stop_the_silver_layer(spark, source, tmp_path):
    lake = str(tmp_path / "lake")
    with open(source / "payments.csv", "a", encoding="utf-8") as f:
        f.write("2,99,2024-06-01,Cash,1,Rental,Completed\n")
    jobs.clean_all(spark, str(source), lake, run_ts=datetime(2026, 1, 1))
    with pytest.raises(IntegrityError) as error:
        jobs.load_silver(spark, lake)
    assert "duplicate_key" in str(error.value) and "fk_payments_rental" in str(error.value)
    assert Layer(spark, lake, "silver").version() == 0


def test_keys_stay_over_refreshes(spark, source, tmp_path):
    """The first customer goes, a third one with a lower id than the second's comes, all keys stay."""
    lake, options = str(tmp_path / "lake"), {"run_ts": datetime(2026, 1, 1, 8), "as_of": date(2026, 1, 1)}

    def refresh(customers, stable):
        (source / "customers.csv").write_text(customers, encoding="utf-8")
        jobs.clean_all(spark, str(source), lake, **options)
        jobs.load_silver(spark, lake)
        jobs.build_gold(spark, lake, stable_keys=stable)
        gold = Layer(spark, lake, "gold").tables(jobs.GOLD_TABLES)
        keys = {r["customer_id"]: r["client_key"] for r in gold["dim_client"].collect()}
        used = {r["rental_id"]: r["client_key"] for r in gold["fact_rentals"].collect()}
        return keys, used

    text = FILES["customers"].replace("\n2,Bob", "\n5,Bob")
    (source / "rentals.csv").write_text(FILES["rentals"].replace("\n2,1,2,1", "\n2,1,5,1"), encoding="utf-8")
    # a version without a registry counts as one
    assert refresh(text, False) == ({1: 1, 5: 2}, {1: 1, 2: 2})
    more = text + "3,Cy,C,,1,,,2010-01-01,2030-01-01,a,X,2020-01-01,Gold\n"
    assert refresh(more, True) == ({1: 1, 5: 2, 3: 3}, {1: 1, 2: 2})
    (source / "rentals.csv").write_text(
        FILES["rentals"].replace("\n2,1,2,1", "\n2,1,5,1").replace("\n1,1,1,1", "\n1,1,3,1"), encoding="utf-8"
    )
    fewer = "\n".join(line for line in more.split("\n") if not line.startswith("1,"))
    assert refresh(fewer, True) == ({5: 2, 3: 3}, {1: 3, 2: 2})
    assert Layer(spark, lake, "gold").table("keys_client").count() == 3
    assert refresh(more, True)[0] == {1: 1, 5: 2, 3: 3}


def driver_tables(spark, directory):
    """A few rows of the tables that the registered queries read."""
    tables = {
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
                     [(i, f"C{i}", i % 3, 1.5 * i, "AUTO") for i in range(5)]),
        "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
                     [(i, f"S{i}", i % 3, 900.0 * i) for i in range(4)]),
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(i, "hot bolt", "B", "T", i, 900.0 + i) for i in range(6)]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, "
                   "o_orderpriority string",
                   [(i, i % 5, "FOP"[i % 3], 100.0 + i, f"1996-0{1 + i % 3}-05", "1-URGENT") for i in range(1, 31)]),
        "lineitem": ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                     "l_linestatus string, l_shipdate string",
                     [(i, (i + k) % 6, (i + k) % 4, k, 2.0, 40.0 + k, 0.1, 0.0, "ANR"[k % 3], "FO"[i % 2], "1996-05-01")
                      for i in range(1, 30) for k in (1, 2)]),
        "events": ("event_id long, ts string, user_id long, event_type string, value double, props string",
                   [(i, "2024-01-01 00:00:11", i % 6, "error", 2.5 * i, f'{{"k": {i}}}') for i in range(20)]),
    }
    for name, (kinds, rows) in tables.items():
        df = spark.createDataFrame(rows, kinds)
        times = {c: df[c].cast("timestamp") for c in ("o_orderdate", "l_shipdate", "ts") if c in df.columns}
        df.withColumns(times).write.parquet(f"{directory}/{name}.parquet")
    return str(directory)


def test_a_full_refresh_keeps_its_layers_only(spark, tmp_path, monkeypatch):
    """Its CSV files are compressed and go when they are read; steps and copies go, too."""
    tables = driver_tables(spark, tmp_path / "tables")
    scratch = tmp_path / "scratch"
    made = []

    def folder(_spark):
        made.append(scratch / str(len(made)))
        return f"file://{made[-1]}"

    kept, remove = [], csv.remove

    def removed(session, path):
        files = sorted(str(f) for f in Path(path.removeprefix("file://")).rglob("part-*"))
        kept.append([f for f in files if ".csv" in f])
        remove(session, path)

    monkeypatch.setattr(registry, "scratch_dir", folder)
    monkeypatch.setattr(jobs, "scratch_dir", folder)
    monkeypatch.setattr(csv, "remove", removed)
    months = {str(r["month"]): float(r["total_revenue"]) for r in registry.full_refresh(spark, tables).collect()}
    # all 30 rentals: no total is negative, 'abc' or null at these ids but for 50, 53 and 59
    assert months == {
        f"2024-0{1 + m}-05"[:8] + "01": sum(100.0 + i for i in range(1, 31) if i % 3 == m) for m in range(3)
    }
    sources = [files for files in kept if files]
    assert len(sources) == 1 and all(f.endswith(".csv.gz") for f in sources[0])
    assert {Path(f).parent.name for f in sources[0]} == {f"{t}.csv" for t in schemas.TABLES}
    left = {f.relative_to(scratch).parts[1] for f in scratch.rglob("part-*")}
    assert left == {"processed", "gold"} and len(made) == 4
    assert all(".zstd.parquet" in f.name for f in scratch.rglob("part-*") if "/version=" in str(f) and "_schemas" not in str(f))
