"""The registered queries: each runs one operator over whole driver tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import model
from fleetlake import jobs, schemas
from fleetlake.functions import columns as C
from fleetlake.operators import keys, quality
from fleetlake.operators.joins import BROADCAST_ROWS
from fleetlake.plans import gold, rating, reports
from fleetlake.plans.silver import cast_silver
from fleetlake.sources import csv
from fleetlake.sources.layers import (
    Layer,
    scratch_dir,
    shuffles_dropped,
    side_by_side,
    write_table,
)

# One by one, as each shuffles its sources whole.
LARGE = ("rentals", "payments", "car_condition")
ROWS_PER_FILE = 200_000


def clean(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.cleaned(spark, sf_dir, table)


def silver_types(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_silver(table, model.cleaned(spark, sf_dir, table))


def load_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = csv.table_path(scratch_dir(spark), "rentals")
    csv.write_csv(model.view(spark, sf_dir, "rentals"), path)
    return csv.read_raw(spark, path, "rentals")


def _raw_files(spark: SparkSession, sf_dir: str, dirty: bool) -> str:
    directory = scratch_dir(spark)

    def write(table: str) -> None:
        df = model.dirty(spark, sf_dir, table) if dirty else model.view(spark, sf_dir, table)
        if table == "car_condition" and not dirty:  # a raw time is at most 20 characters long
            df = df.withColumn("entry_date", F.date_trunc("second", "entry_date").cast("string"))
        csv.write_csv(df, csv.table_path(directory, table), rows_per_file=ROWS_PER_FILE)

    def write_large() -> None:
        for table in LARGE:
            write(table)

    work = {table: partial(write, table) for table in schemas.TABLES if table not in LARGE}
    with shuffles_dropped(spark):
        side_by_side(spark, work | {"large": write_large})
    return directory


def load_raw_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = scratch_dir(spark)
    jobs.load_raw(spark, _raw_files(spark, sf_dir, dirty=False), lake)
    return quality.row_count_report(Layer(spark, lake, "raw").tables(schemas.TABLES))


def load_raw_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of all eight raw tables, its columns joined as text."""
    lake = scratch_dir(spark)
    jobs.load_raw(spark, _raw_files(spark, sf_dir, dirty=False), lake)
    tables = Layer(spark, lake, "raw").tables(schemas.TABLES)
    lines = None
    for table, df in tables.items():
        text = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in df.columns]
        part = df.select(
            F.lit(table).alias("table_name"),
            F.col(schemas.PRIMARY_KEYS[table]).alias("id"),
            F.concat_ws("|", *text).alias("line"),
        )
        lines = part if lines is None else lines.unionByName(part)
    return lines


def load_silver_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = csv.table_path(scratch_dir(spark), "car_condition")
    csv.write_csv(model.dirty(spark, sf_dir, "car_condition"), path)
    return csv.read_text(spark, path)


def load_line_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row has line breaks and quotes in its last column."""
    path = csv.table_path(scratch_dir(spark), "car_condition")
    rows = model.dirty(spark, sf_dir, "car_condition")
    notes = F.concat(F.coalesce("notes", F.lit("")), F.lit('\n"'), "condition_id", F.lit('",\n'))
    csv.write_csv(rows.withColumn("notes", notes), path)
    return csv.read_text(spark, path, multi_line=True)


def load_raw_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each raw table where two files are absent, and whether the strict load names it."""
    source, lake = _raw_files(spark, sf_dir, dirty=False), scratch_dir(spark)
    for table in ("tariffs", "payments"):
        csv.remove(spark, csv.table_path(source, table))
    try:
        jobs.load_raw(spark, source, lake)
        message = ""
    except FileNotFoundError as error:
        message = str(error)
    jobs.load_raw(spark, source, lake, on_missing="empty")
    counted = quality.row_count_report(Layer(spark, lake, "raw").tables(schemas.TABLES))
    named = F.array_contains(
        F.split(F.substring_index(F.lit(message), ": ", -1), ", "), F.col("table_name")
    )
    return counted.withColumn("is_named", named)


def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV files through every job to the month report."""
    lake = scratch_dir(spark)
    source = _raw_files(spark, sf_dir, dirty=True)
    jobs.clean_all(spark, source, lake, run_ts=model.RUN_TS)
    csv.remove(spark, source)  # written above, and read whole by now
    silver = Layer(spark, lake, "processed").tables(schemas.TABLES)
    typed = {t: cast_silver(t, df) for t, df in silver.items()}
    jobs.refresh_gold(typed, Layer(spark, lake, "gold"))
    return jobs.run_reports(spark, lake)["revenue_by_month"]


def silver_bool_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.col("word")
    return model.view(spark, sf_dir, "flags").select(
        "condition_id",
        "word",
        C.boolean_word(word).alias("or_null"),
        C.boolean_word(word, False).alias("or_false"),
    )


def check_primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.primary_key_violations(model.broken_tables(spark, sf_dir), schemas.PRIMARY_KEYS)


def check_foreign_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.foreign_key_violations(
        model.broken_tables(spark, sf_dir), schemas.FOREIGN_KEYS, schemas.PRIMARY_KEYS
    )


def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.integrity_report(
        model.broken_tables(spark, sf_dir), schemas.PRIMARY_KEYS, schemas.FOREIGN_KEYS
    )


def profile_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.key_profile(model.broken_tables(spark, sf_dir), schemas.PRIMARY_KEYS)


def layer_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_count_report(model.silver_tables(spark, sf_dir))


def publish_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dimension as readers see it after its layer was refreshed twice."""
    layer = Layer(spark, scratch_dir(spark), "gold")
    for _ in range(2):
        layer.refresh(
            [{"dim_client": lambda _: gold.dim_client(model.silver(spark, sf_dir, "customers"))}],
            lambda written: quality.primary_key_violations(written, schemas.GOLD_PRIMARY_KEYS),
        )
    return layer.table("dim_client")


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar with the rentals that start on each day."""
    started = (
        model.view(spark, sf_dir, "rentals")
        .groupBy(F.col("rental_date").alias("full_date"))
        .agg(F.count("*").alias("started"))
    )
    return (
        gold.dim_date(spark)
        .join(started, "full_date", "left")
        .withColumn("rentals_count", F.coalesce("started", F.lit(0)))
        .drop("started")
    )


def dimension(build, table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return build(model.silver(spark, sf_dir, table))


def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = model.view(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return keys.surrogate_key(orders, "o_orderkey", "order_key")


def surrogate_key_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that repeat, and every tenth row without one."""
    ids = model.view(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderkey % 10 <> 0 THEN o_orderkey div 3 END AS id"
    )
    return keys.surrogate_key(ids, "id", "number")


def stable_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client keys after three loads: some customers, then others and fewer of those, then all.

    ``first_load`` is the load that a customer came with.
    """
    customers = model.view(spark, sf_dir, "customers").select("customer_id", "city")
    remainder = F.col("customer_id") % 10
    loads = [customers.where(remainder < 5), customers.where(remainder.between(3, 7)), customers]
    known = None
    for load in loads:
        path = f"{scratch_dir(spark)}/keys"
        write_table(keys.key_registry(known, load, "customer_id", "client_key"), path)
        known = spark.read.parquet(path)
    first = F.when(remainder < 5, 1).when(remainder < 8, 2).otherwise(3)
    return keys.with_key(customers, known, "customer_id", "client_key").withColumn(
        "first_load", first
    )


def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base holds customers above Bronze; a batch brings every customer twice."""
    customers = model.view(spark, sf_dir, "customers").select(
        "customer_id", "city", "loyalty_level"
    )
    batch = customers.withColumn("city", F.concat(F.lit("new "), "city")).unionByName(
        customers.withColumn("city", F.concat(F.lit("old "), "city"))
    )
    return keys.insert_if_absent(customers.where("loyalty_level <> 'Bronze'"), batch, "customer_id")


def payment_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.payment_rollup(model.silver(spark, sf_dir, "payments"))


def fact_dim_lookup(
    spark: SparkSession, sf_dir: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rentals against the stored dimensions."""
    rentals = gold.with_dim_keys(
        model.silver(spark, sf_dir, "rentals"), model.gold(spark, sf_dir), broadcast_rows
    )
    return rentals.select(
        "rental_id", "car_key", "client_key", "employee_key", "tariff_key",
        "pickup_location_key", "return_location_key",
    )


def fact_date_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rentals = gold.with_date_keys(model.silver(spark, sf_dir, "rentals"), gold.dim_date(spark))
    return rentals.select(
        "rental_id", "rental_date", "actual_return_date", "rental_date_key",
        "actual_return_date_key",
    )


def fact_date_keys_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of the rentals are moved by ten years, most of them out of the calendar."""
    moved = {
        c: F.date_add(c, ((F.col("rental_id") % 3 - 1) * 3653).cast("int"))
        for c in ("rental_date", "actual_return_date")
    }
    rentals = model.silver(spark, sf_dir, "rentals").withColumns(moved)
    return gold.with_date_keys(rentals, gold.dim_date(spark)).select(
        "rental_id", "rental_date", "actual_return_date", "rental_date_key",
        "actual_return_date_key",
    )


def fact_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rentals = model.silver(spark, sf_dir, "rentals").select("rental_id")
    return gold.with_payments(rentals, model.silver(spark, sf_dir, "payments"))


def fact_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.with_duration(
        model.silver(spark, sf_dir, "rentals").select(
            "rental_id", "rental_date", "actual_return_date"
        )
    )


def fact_rentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fact_rentals(
        model.silver(spark, sf_dir, "rentals"),
        model.silver(spark, sf_dir, "payments"),
        model.gold(spark, sf_dir),
    )


def fact_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after two refreshes by change, and the refresh that wrote a row's month.

    At first some rentals of every fourth month are missing, and some of the months
    after these have another cost.
    """
    silver = model.silver_tables(spark, sf_dir)
    rentals = silver["rentals"]
    of_four = F.month("rental_date") % 4
    missing = F.coalesce((of_four == 1) & (F.col("rental_id") % 5 == 0), F.lit(False))
    other = (of_four == 2) & (F.col("rental_id") % 7 == 0)
    cost = F.when(other, (F.col("total_cost") + 1).cast("decimal(10,2)")).otherwise(F.col("total_cost"))
    layer = Layer(spark, scratch_dir(spark), "gold")
    earlier = rentals.where(~missing).withColumn("total_cost", cost)
    jobs.refresh_gold_changes(silver | {"rentals": earlier}, layer)
    jobs.refresh_gold_changes(silver, layer)
    written = F.regexp_extract("_metadata.file_path", r"part_version=(\d+)/", 1).cast("int")
    return layer.table("fact_rentals").withColumn("written_by", written).drop("rental_month")


def check_gold_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.constraint_summary(
        model.gold(spark, sf_dir), schemas.GOLD_PRIMARY_KEYS, schemas.GOLD_FOREIGN_KEYS
    )


def check_gold_keys_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts that point to no car, and facts that come twice."""
    tables = model.gold(spark, sf_dir)
    fact = tables["fact_rentals"]
    astray = F.when(F.col("rental_id") % 7 == 0, F.lit(-1)).otherwise(F.col("car_key"))
    broken = fact.withColumn("car_key", astray).unionByName(fact.where("rental_id % 11 = 0"))
    return quality.constraint_summary(
        tables | {"fact_rentals": broken}, schemas.GOLD_PRIMARY_KEYS, schemas.GOLD_FOREIGN_KEYS
    )


def report_revenue_null_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month report of a star schema in which every fourth rental has no date."""
    silver = model.silver_tables(spark, sf_dir)
    dated = F.when(F.col("rental_id") % 4 != 0, F.col("rental_date"))
    rentals = silver["rentals"].withColumn("rental_date", dated)
    layer = Layer(spark, scratch_dir(spark), "gold")
    jobs.refresh_gold(silver | {"rentals": rentals}, layer)
    return reports.revenue_by_month(layer.table("fact_rentals"))


def report(build, dims: tuple[str, ...], spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = model.gold(spark, sf_dir)
    return build(tables["fact_rentals"], *(tables[d] for d in dims))


def rate_rentals(
    spark: SparkSession, sf_dir: str, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    return rating.rate_rentals(
        model.silver(spark, sf_dir, "rentals"),
        model.silver(spark, sf_dir, "tariffs"),
        broadcast_rows,
    )


def classify_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating.classify_payments(
        model.silver(spark, sf_dir, "payments"), model.silver(spark, sf_dir, "rentals")
    )


def rental_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rating.rental_balance(
        model.silver(spark, sf_dir, "rentals"), model.silver(spark, sf_dir, "payments")
    )


def anomaly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = ("rentals", "payments", "car_condition")
    return rating.anomaly_counts({t: model.dirty(spark, sf_dir, t) for t in tables})


QUERIES = {
    **{f"clean_{t}": partial(clean, t) for t in schemas.TABLES},
    "load_raw": load_raw,
    "load_raw_all": load_raw_all,
    "load_raw_counts": load_raw_counts,
    "load_raw_missing": load_raw_missing,
    "load_silver_text": load_silver_text,
    "load_line_breaks": load_line_breaks,
    "silver_types": partial(silver_types, "rentals"),
    **{f"silver_{t}": partial(silver_types, t) for t in schemas.TABLES if t != "rentals"},
    "silver_bool_parse": silver_bool_parse,
    "check_primary_keys": check_primary_keys,
    "check_foreign_keys": check_foreign_keys,
    "integrity_report": integrity_report,
    "profile_keys": profile_keys,
    "layer_row_counts": layer_row_counts,
    "publish_layer": publish_layer,
    "dim_date": dim_date,
    "dim_car": partial(dimension, gold.dim_car, "cars"),
    "dim_client": partial(dimension, gold.dim_client, "customers"),
    "dim_employee": partial(dimension, gold.dim_employee, "employees"),
    "dim_location": partial(dimension, gold.dim_location, "locations"),
    "dim_tariff": partial(dimension, gold.dim_tariff, "tariffs"),
    "surrogate_key": surrogate_key,
    "surrogate_key_nulls": surrogate_key_nulls,
    "stable_keys": stable_keys,
    "insert_if_absent": insert_if_absent,
    "payment_rollup": payment_rollup,
    "fact_dim_lookup": fact_dim_lookup,
    # no lookup is broadcast: what tables beyond the limit take
    "fact_dim_lookup_large": partial(fact_dim_lookup, broadcast_rows=0),
    "fact_date_keys": fact_date_keys,
    "fact_date_keys_outside": fact_date_keys_outside,
    "fact_payments": fact_payments,
    "fact_duration": fact_duration,
    "fact_rentals": fact_rentals,
    "fact_changes": fact_changes,
    "check_gold_keys": check_gold_keys,
    "check_gold_keys_broken": check_gold_keys_broken,
    "report_tariffs": partial(report, reports.tariffs, ("dim_tariff",)),
    "report_top_cars": partial(report, reports.top_cars, ("dim_car",)),
    "report_brands": partial(report, reports.brands, ("dim_car",)),
    "report_top_clients": partial(report, reports.top_clients, ("dim_client",)),
    "report_client_cities": partial(report, reports.client_cities, ("dim_client",)),
    "report_rentals_by_month": partial(report, reports.rentals_by_month, ()),
    "report_revenue_by_month": partial(report, reports.revenue_by_month, ()),
    "report_revenue_null_dates": report_revenue_null_dates,
    "report_employees": partial(report, reports.employees, ("dim_employee",)),
    "report_month_year_pivot": partial(report, reports.month_year_comparison, ()),
    "rate_rentals": rate_rentals,
    "rate_rentals_large": partial(rate_rentals, broadcast_rows=0),
    "classify_payments": classify_payments,
    "rental_balance": rental_balance,
    "anomaly_counts": anomaly_counts,
    "full_refresh": full_refresh,
}
