"""Refreshes of the fact that write only the months that changed."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fleetlake import jobs, schemas
from fleetlake.plans import changes
from fleetlake.sources import layers
from fleetlake.sources.layers import Layer, Patch

MONTHS = [date(2024, m, 1) for m in range(1, 7)]


def table(spark, name, rows):
    """Rows given by some of their columns; the others are null."""
    kinds = schemas.silver_types(name)
    schema = ", ".join(f"{c} {kind}" for c, kind in kinds.items())
    return spark.createDataFrame([tuple(r.get(c) for c in kinds) for r in rows], schema)


def rental(i, day, **more):
    known = {"rental_id": i, "car_id": 1 + i % 2, "customer_id": 1 + i % 3, "employee_id": 1, "tariff_id": 1,
             "pickup_location_id": 1, "return_location_id": 1, "rental_date": day, "total_cost": Decimal(i),
             "is_late_return": False}
    return known | more


@pytest.fixture
def rows():
    return {
        "locations": [{"location_id": 1}],
        "cars": [{"car_id": 1}, {"car_id": 2}],
        "customers": [{"customer_id": c} for c in (1, 2, 3)],
        "employees": [{"employee_id": 1}],
        "tariffs": [{"tariff_id": 1}],
        "rentals": [rental(i, MONTHS[i % 6].replace(day=1 + i % 28)) for i in range(36)] + [rental(99, None)],
        "payments": [
            {"payment_id": i, "rental_id": i % 36, "amount": Decimal(7), "payment_method": "Cash", "status": "Completed"}
            for i in range(72)
        ],
        "car_condition": [],
    }


def silver(spark, rows):
    return {t: table(spark, t, rows[t]) for t in schemas.TABLES}


def content(layer):
    return sorted(map(repr, layer.table("fact_rentals").collect()))


def written_by(layer):
    """The version that wrote each month's partition."""
    parts = layer.parts(layer.version())["fact_rentals"]
    return {p.split("rental_month=")[1]: int(p.split("/")[0].split("=")[1]) for p in parts}


def check_like_full(spark, layer, tables, tmp_path):
    """A full refresh, with the key registries of the layer, gives the same fact."""
    full = Layer(spark, f"file://{tmp_path}/full{layer.version()}", "gold")
    stored = layer.tables([r for r in layer.schemas(layer.version()) if r.startswith("keys_")])
    full.refresh([{name: lambda _, df=df: df for name, df in stored.items()}])
    jobs.refresh_gold(tables, full, stable_keys=True)
    assert content(full) == content(layer)


def test_only_changed_months_are_written(spark, rows, tmp_path):
    layer = Layer(spark, f"file://{tmp_path}/lake", "gold")
    first = silver(spark, rows)
    assert jobs.refresh_gold_changes(first, layer)["fact_rentals"] == 37
    names = [m.isoformat() for m in MONTHS]
    assert written_by(layer) == dict.fromkeys([*names, layers.NULL_PART], 1)

    # the same rows: nothing is written
    assert jobs.refresh_gold_changes(first, layer)["fact_rentals"] == 37
    assert set(written_by(layer).values()) == {1}

    # a rental moves from January to March, one in May gets another payment
    moved = [r | {"rental_date": date(2024, 3, 31)} if r["rental_id"] == 0 else r for r in rows["rentals"]]
    paid = rows["payments"] + [{"payment_id": 100, "rental_id": 4, "amount": Decimal(1), "status": "Completed"}]
    third = silver(spark, rows | {"rentals": moved, "payments": paid})
    jobs.refresh_gold_changes(third, layer)
    assert {m for m, v in written_by(layer).items() if v == 3} == {"2024-01-01", "2024-03-01", "2024-05-01"}
    check_like_full(spark, layer, third, tmp_path)

    # June is empty now, the rental without a date has another status
    fewer = [r | ({"status": "Active"} if r["rental_id"] == 99 else {}) for r in moved if r["rental_id"] % 6 != 5]
    left = {r["rental_id"] for r in fewer}
    fourth = silver(spark, rows | {"rentals": fewer, "payments": [p for p in paid if p["rental_id"] in left]})
    jobs.refresh_gold_changes(fourth, layer)
    assert "2024-06-01" not in written_by(layer)
    assert {m for m, v in written_by(layer).items() if v == 4} == {layers.NULL_PART}
    check_like_full(spark, layer, fourth, tmp_path)

    # partitions that neither of the last two versions reads are gone, others stay
    parts = tmp_path / "lake" / "gold" / "parts" / "fact_rentals"
    stored = {str(p.relative_to(parts)) for p in parts.glob("*/rental_month=*")}
    assert stored == set(layer.parts(4)["fact_rentals"]) | set(layer.parts(3)["fact_rentals"])
    assert layer.table("fact_rentals", 3).count() == 37


def test_keys_that_change_touch_their_months(spark, rows, tmp_path, monkeypatch):
    """A car that comes later gives keys to the rentals that name it; its months are made anew."""
    monkeypatch.setattr(jobs, "_gold_check", lambda tables: spark.range(0))
    layer = Layer(spark, f"file://{tmp_path}/lake", "gold")
    late = [r | {"car_id": 2 if r["rental_id"] in (7, 8) else 1, "return_location_id": None} for r in rows["rentals"]]
    jobs.refresh_gold_changes(silver(spark, rows | {"rentals": late, "cars": [{"car_id": 1}]}), layer)
    second = silver(spark, rows | {"rentals": late})
    jobs.refresh_gold_changes(second, layer)
    assert {m for m, v in written_by(layer).items() if v == 2} == {"2024-02-01", "2024-03-01"}
    assert layer.table("fact_rentals").where("car_key IS NULL").count() == 0
    check_like_full(spark, layer, second, tmp_path)
    # and a car that goes takes them away
    third = silver(spark, rows | {"rentals": late, "cars": [{"car_id": 1}]})
    jobs.refresh_gold_changes(third, layer)
    assert layer.table("fact_rentals").where("car_key IS NULL").count() == 2


def test_empty_tables_and_a_full_refresh_between(spark, rows, tmp_path):
    layer = Layer(spark, f"file://{tmp_path}/lake", "gold")
    nothing = silver(spark, {t: [] for t in schemas.TABLES})
    assert jobs.refresh_gold_changes(nothing, layer)["fact_rentals"] == 0
    assert layer.table("fact_rentals").collect() == []
    first = silver(spark, rows)
    assert jobs.refresh_gold_changes(first, layer)["fact_rentals"] == 37
    jobs.refresh_gold(first, layer, stable_keys=True)
    assert layer.parts(layer.version()) == {}
    assert jobs.refresh_gold_changes(first, layer)["fact_rentals"] == 37
    assert set(written_by(layer).values()) == {4}


def test_digests_see_nulls_and_repeats(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (1, 1), (None, None)], "a int, b int")
    one, two = changes.row_digests(["a", "b"])
    found = df.select(one.alias("one"), two.alias("two")).collect()
    assert len({r["one"] for r in found}) == len({r["two"] for r in found}) == 4
    assert all(r["one"] != r["two"] for r in found)


def test_a_repeated_rental_changes_its_month(spark, rows):
    rentals = table(spark, "rentals", rows["rentals"])
    rollup = spark.createDataFrame(
        [], "rental_id bigint, total_paid decimal(18,2), payment_count bigint, unique_payment_methods bigint"
    )
    twice = rentals.unionByName(rentals.where("rental_id IN (2, 8)"))
    old, new = (changes.month_digests(r, rollup) for r in (rentals, twice))
    assert [r[0] for r in changes.differing(old, new, "rental_month").collect()] == [date(2024, 3, 1)]
    assert changes.differing(old, old, "rental_month").collect() == []


def test_a_patch_on_a_version_that_is_gone_fails(spark, tmp_path):
    layer = Layer(spark, f"file://{tmp_path}", "gold")
    layout = {"t": ("m", ["id"])}
    some = spark.range(4).select("id", (F.col("id") % 2).alias("m"))
    layer.refresh([{"t": lambda _: Patch(some)}], layout=layout)
    kept = layer.parts(1)["t"]

    def slow(_):
        for _ in range(2):
            Layer(spark, f"file://{tmp_path}", "gold").refresh([{"t": lambda _: spark.range(3)}])
        return Patch(some.limit(0), kept)

    with pytest.raises(RuntimeError, match="published since version 1"):
        layer.refresh([{"t": slow}], layout=layout)
    assert layer.table("t").count() == 3
