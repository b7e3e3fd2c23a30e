"""The rental tables as DataFrames over one directory of driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import views
from fleetlake import jobs, schemas
from fleetlake.functions import columns as C
from fleetlake.plans.clean import CLEANERS
from fleetlake.plans.silver import cast_silver
from fleetlake.sources.layers import Layer, scratch_dir

RUN_TS = datetime(2026, 1, 1)

# The driver writes a table as one file, often of one row group, which one task reads.
# Rows of the larger tables are spread by these columns, whatever their size.
SPREAD_BY = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"],
    "orders": ["o_orderkey"],
    "events": ["event_id"],
}

_plans: dict[tuple[str, str, str], DataFrame] = {}
_gold: dict[tuple[str, str], dict[str, DataFrame]] = {}


def source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if name in SPREAD_BY:
        df = df.repartition(*SPREAD_BY[name])
    return df


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a view over some; the plan (not the data) is made once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _plans:
        if name in views.SOURCES:
            _plans[key] = source(spark, sf_dir, name)
        else:
            sources = {s: view(spark, sf_dir, s) for s in views.sources_of(name)}
            _plans[key] = spark.sql(views.spark_sql(name), **sources)
    return _plans[key]


def dirty(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return view(spark, sf_dir, f"{table}_dirty")


def cleaned(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return CLEANERS[table](dirty(spark, sf_dir, table), run_ts=RUN_TS)


def silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A typed table of the rental model, as the silver layer would hold it."""
    df = view(spark, sf_dir, table).withColumns(
        {"created_at": C.moment(RUN_TS), "updated_at": C.moment(RUN_TS)}
    )
    if table == "rentals":
        scheduled, actual = F.col("scheduled_return_date"), F.col("actual_return_date")
        df = df.withColumns(
            {
                "is_late_return": C.is_late(actual, scheduled),
                "late_days": C.late_days(actual, scheduled),
            }
        )
    return cast_silver(table, df)


def silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: silver(spark, sf_dir, t) for t in schemas.TABLES}


def broken_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    tables = {t: view(spark, sf_dir, t) for t in schemas.TABLES}
    broken = {t: view(spark, sf_dir, f"{t}_broken") for t in ("cars", "rentals", "payments")}
    return tables | broken


def gold(spark: SparkSession, sf_dir: str, *, fresh: bool = False) -> dict[str, DataFrame]:
    """The published star schema over a directory, built once per session; reports read it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if fresh or key not in _gold:
        layer = Layer(spark, scratch_dir(spark), "gold")
        jobs.refresh_gold(silver_tables(spark, sf_dir), layer)
        _gold[key] = layer.tables(jobs.GOLD_TABLES)
    return _gold[key]
