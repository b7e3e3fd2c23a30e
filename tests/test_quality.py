"""Keys, references, profiles and counts over planted faults."""

from pyspark.sql import functions as F

from fleetlake.operators import quality

KEYS = {"parent": "id", "child": "cid"}
REFS = [("fk_child_parent", "child", "pid", "parent"), ("fk_child_other", "child", "oid", "parent")]


def tables(spark):
    return {
        "parent": spark.createDataFrame([(1,), (2,)], "id bigint"),
        "child": spark.createDataFrame(
            [(1, 1, 1), (1, 9, 2), (None, None, None), (4, 9, None)],
            "cid bigint, pid bigint, oid bigint",
        ),
    }


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_primary_keys(spark):
    found = {tuple(r) for r in quality.primary_key_violations(tables(spark), KEYS).collect()}
    assert found == {("child", "duplicate_key", 1, 2), ("child", "null_key", None, 1)}


def test_foreign_keys(spark):
    found = rows(quality.foreign_key_violations(tables(spark), REFS, KEYS))
    assert found == [("child", "fk_child_parent", 9, 2)]


def test_report_is_empty_for_sound_tables(spark):
    sound = tables(spark) | {
        "child": spark.createDataFrame([(1, 1, 1), (2, None, 2)], "cid bigint, pid bigint, oid bigint")
    }
    assert rows(quality.integrity_report(sound, KEYS, REFS)) == []
    assert len(quality.integrity_report(tables(spark), KEYS, REFS).collect()) == 3


def test_summary(spark):
    assert rows(quality.constraint_summary(tables(spark), KEYS, REFS)) == [
        ("child", "fk_child_other", 2, 0),
        ("child", "fk_child_parent", 2, 1),
        ("child", "primary_key", 3, 2),
        ("parent", "primary_key", 2, 0),
    ]


def test_profile_and_counts(spark):
    assert rows(quality.key_profile(tables(spark), KEYS)) == [("child", 4, 2), ("parent", 2, 2)]
    assert rows(quality.row_count_report(tables(spark))) == [("child", 4), ("parent", 2), ("total", 6)]


def test_count_matching(spark):
    df = tables(spark)["child"]
    counted = quality.count_matching(df, "child", {"nine": F.col("pid") == 9, "none": F.col("cid") == 77})
    assert rows(counted) == [("child", "nine", 2), ("child", "none", 0)]


def test_a_hot_key_is_counted_before_the_shuffle(spark):
    """Partial aggregation and one exchange of counts; the rows are not exchanged."""
    hot = {"parent": spark.range(10).select("id"), "child": spark.range(1000).select(
        F.col("id").alias("cid"), F.lit(3).cast("bigint").alias("pid"), F.lit(4).cast("bigint").alias("oid"))}
    plan = quality.foreign_key_violations(hot, REFS, KEYS)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
