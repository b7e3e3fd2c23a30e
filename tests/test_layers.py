"""Layers: refused versions, declared schemas, refreshes side by side, stored reports."""

import time

import pytest
from pyspark.sql import functions as F

from fleetlake import jobs, schemas
from fleetlake.operators import keys, quality
from fleetlake.sources.layers import IntegrityError, Layer, shuffles_dropped


def test_the_whole_report_of_a_refused_version_is_stored(spark, tmp_path):
    layer = Layer(spark, f"file://{tmp_path}", "silver")
    layer.refresh([{"t": lambda _: spark.range(5)}])

    def check(tables):
        return quality.primary_key_violations(tables, {"t": "id"})

    twice = spark.range(300).unionByName(spark.range(300))
    with pytest.raises(IntegrityError, match="300 violations.*t, duplicate_key: 300") as refused:
        layer.refresh([{"t": lambda _: twice}], check)
    place = str(refused.value).split("all in ")[1].split(": t,")[0]
    stored = spark.read.parquet(place)
    assert stored.count() == 300 and stored.select("key").distinct().count() == 300
    assert layer.version() == 1 and layer.table("t").count() == 5
    layer.refresh([{"t": lambda _: spark.range(7)}], check)
    assert layer.table("t").count() == 7


def test_empty_and_null_partitions_keep_their_types(spark, tmp_path):
    layer = Layer(spark, f"file://{tmp_path}", "gold")
    rows = spark.range(4).select("id", F.lit(None).cast("date").alias("month"))
    for df in (rows.limit(0), rows):
        written = layer.refresh([{"fact": lambda _, df=df: df}], layout={"fact": ("month", ["id"])})
        back = layer.table("fact")
        assert dict(back.dtypes) == {"id": "bigint", "month": "date"}
        assert back.count() == written["fact"] == df.count()


def test_an_empty_fact_builds_and_reports(spark, tmp_path):
    silver = {
        t: spark.createDataFrame([], ", ".join(f"{c} {k}" for c, k in schemas.silver_types(t).items()))
        for t in schemas.TABLES
    }
    lake = f"file://{tmp_path}"
    jobs.refresh_gold(silver, Layer(spark, lake, "gold"))
    made = jobs.run_reports(spark, lake)
    assert dict(made["rentals_by_month"].dtypes)["month"] == "date"
    assert all(df.collect() == [] for df in made.values())


def test_refreshes_never_share_a_directory(spark, tmp_path):
    """A refresh that begins while another one runs takes a version of its own."""
    layer = Layer(spark, f"file://{tmp_path}", "raw")

    def slow(_):
        Layer(spark, f"file://{tmp_path}", "raw").refresh([{"t": lambda _: spark.range(3)}])
        return spark.range(9)

    layer.refresh([{"t": slow}])
    assert layer._published() == [1, 2]
    assert layer.table("t", 1).count() == 9 and layer.table("t", 2).count() == 3


def test_stored_reports_have_their_order(spark, tmp_path, monkeypatch):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        report = spark.range(500).select("id", F.xxhash64("id").alias("h")).orderBy("h")
        monkeypatch.setattr(jobs, "run_reports", lambda *_: {"r": report})
        jobs.store_reports(spark, f"file://{tmp_path}")
        stored = Layer(spark, f"file://{tmp_path}", "reports").table("r")
        rows = sorted(stored.collect(), key=lambda r: r["position"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hashes = [r["h"] for r in rows]
    assert hashes == sorted(hashes) and len({r["position"] for r in rows}) == 500
    assert rows[-1]["position"] >= 1 << 33  # sorted by several tasks


def test_numbers_of_null_and_repeated_ids(spark):
    rows = [(None, i) for i in range(50)] + [(i % 20, i) for i in range(100)] + [(1000, 0)]
    df = spark.createDataFrame(rows, "id long, other long")
    got = keys.surrogate_key(df, "id", "number").collect()
    assert sorted(r["number"] for r in got) == list(range(1, 152))
    ids = [r["id"] for r in sorted(got, key=lambda r: r["number"])]
    assert ids == sorted((i for i in ids if i is not None)) + [None] * 50
    alone = spark.createDataFrame([(None,), (None,), (3,)], "id long")
    assert sorted(r["number"] for r in keys.surrogate_key(alone, "id", "number").collect()) == [1, 2, 3]


def shuffle_files(spark) -> set[str]:
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while found.hasNext():
        name = found.next().getName()
        names |= {name} if name.startswith("shuffle_") else set()
    return names


def gone(spark, before: set[str]) -> bool:
    """Whether no other shuffle file than those before is left; Spark deletes them in the background."""
    for _ in range(40):
        if not shuffle_files(spark) - before:
            return True
        time.sleep(0.1)
    return False


def test_a_refresh_leaves_no_shuffle_files(spark, tmp_path):
    """A later stage and the check find those of the stages before gone, too."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, seen = shuffle_files(spark), []

    def shuffled(n):
        return spark.range(n).repartition("id").withColumn("m", F.col("id") % 3)

    def second(stored):
        seen.append(gone(spark, before))
        return stored["a"].groupBy("m").count()

    def check(stored):
        seen.append(gone(spark, before))
        return stored["b"].groupBy("m").agg(F.max("count").alias("n")).where("n > 1000")

    layer = Layer(spark, str(tmp_path), "gold")
    layout = {"a": ("m", ["id"])}
    assert layer.refresh([{"a": lambda _: shuffled(3000)}, {"b": second}], check, layout) == {"a": 3000, "b": 3}
    assert gone(spark, before) and seen == [True, True]
    assert spark.conf.get(setting) == "false"
    assert sorted(r["count"] for r in layer.table("b").collect()) == [1000] * 3


def test_the_shuffle_setting_is_restored_by_the_last_block(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    for before in ("false", "true", None):
        if before:
            spark.conf.set(setting, before)
        first, second = shuffles_dropped(spark), shuffles_dropped(spark)
        first.__enter__()
        second.__enter__()
        first.__exit__(None, None, None)
        assert spark.conf.get(setting) == "true"
        second.__exit__(None, None, None)
        assert spark.conf.get(setting, None) == before
        with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
            1 / 0
        assert spark.conf.get(setting, None) == before
        spark.conf.unset(setting)
