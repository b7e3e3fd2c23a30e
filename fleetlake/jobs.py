"""The jobs as a user runs them, each a refresh of one layer.

    python -m fleetlake load-raw    --source DIR --lake DIR [--on-missing empty]
    python -m fleetlake clean       --source DIR --lake DIR [--csv DIR] [--as-of DATE] [--run-ts TIME]
    python -m fleetlake load-silver --lake DIR [--source DIR] [--on-missing empty]
    python -m fleetlake build-gold  --lake DIR [--stable-keys | --changes]
    python -m fleetlake report      --lake DIR

``load-raw`` lands the source files as they are. ``clean`` and the steps after
it start from the same files, not from the landed copy. ``load-silver`` takes
the cleaned tables, or with ``--source`` cleaned CSV files. With ``--changes``
``build-gold`` writes only the months of the fact whose rentals, payments or keys
differ from the published version's; other refreshes are full ones.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake import schemas
from fleetlake.operators.keys import key_registry, with_key
from fleetlake.operators.quality import integrity_report, key_profile
from fleetlake.plans import changes, gold, reports
from fleetlake.plans.clean import CLEANERS, READ_AGAIN
from fleetlake.plans.silver import cast_silver
from fleetlake.sources import csv
from fleetlake.sources.layers import (
    NULL_PART,
    Layer,
    Patch,
    kept_in,
    scratch_dir,
    shuffles_dropped,
    write_table,
)

GOLD_TABLES = list(schemas.GOLD_PRIMARY_KEYS)
MONTHS = "months_of_fact_rentals"  # what each month of the fact was made of
FACT_LAYOUT = {"fact_rentals": ("rental_month", ["car_key"])}


def load_raw(
    spark: SparkSession, source: str, lake: str, *, on_missing: str = "error", multi_line=False
) -> dict[str, int]:
    """CSV files to typed raw tables; ``on_missing="empty"`` allows absent files."""
    found = csv.check_sources(spark, source, need_all=on_missing == "error")

    def build(table: str) -> DataFrame:
        if table not in found:
            return spark.createDataFrame([], schemas.raw_schema(table))
        path = csv.table_path(source, table)
        return csv.read_raw(spark, path, table, multi_line=multi_line)

    stage = {t: lambda _stored, t=t: build(t) for t in schemas.TABLES}
    return Layer(spark, lake, "raw").refresh([stage])


def clean_all(
    spark: SparkSession,
    source: str,
    lake: str,
    *,
    run_ts: datetime | None = None,
    as_of: date | None = None,
    multi_line: bool = False,
    csv_to: str | None = None,
) -> dict[str, int]:
    """CSV files to cleaned tables; all eight files must be there.

    With ``csv_to`` the cleaned tables are written there as CSV, too.

    Columns that are read more than once, for medians and shared licences, are first
    copied, as text, to Parquet; so the CSV is parsed twice.
    """
    csv.check_sources(spark, source)
    run_ts = run_ts or datetime.now()
    copies = scratch_dir(spark)
    keep = kept_in(copies)

    def build(table: str) -> DataFrame:
        path = csv.table_path(source, table)
        df = csv.read_source(spark, path, multi_line=multi_line)
        extra = {"as_of": as_of} if table == "customers" else {}
        if table in READ_AGAIN:
            extra["copy"] = keep(df.select(*READ_AGAIN[table]))
        return CLEANERS[table](df, run_ts=run_ts, **extra)

    stage = {t: lambda _stored, t=t: build(t) for t in schemas.TABLES}
    layer = Layer(spark, lake, "processed")
    try:
        rows = layer.refresh([stage])
    finally:
        csv.remove(spark, copies)
    if csv_to:
        for table, df in layer.tables(schemas.TABLES).items():
            csv.write_csv(df, csv.table_path(csv_to, table))
    return rows


def _silver_schema(table: str) -> str:
    return ", ".join(f"{c} {kind}" for c, kind in schemas.silver_types(table).items())


def _silver_check(tables) -> DataFrame:
    return integrity_report(tables, schemas.PRIMARY_KEYS, schemas.FOREIGN_KEYS)


def load_silver(
    spark: SparkSession,
    lake: str,
    *,
    processed_csv: str | None = None,
    on_missing: str = "error",
    multi_line: bool = False,
) -> dict[str, int]:
    """Cleaned tables (or a directory of cleaned CSV files) to the checked silver layer.

    ``on_missing="empty"`` allows absent CSV files; their tables are empty.
    """
    if processed_csv:
        found = csv.check_sources(spark, processed_csv, need_all=on_missing == "error")
        cleaned = {
            t: csv.read_text(spark, csv.table_path(processed_csv, t), multi_line=multi_line)
            if t in found
            else spark.createDataFrame([], _silver_schema(t))
            for t in schemas.TABLES
        }
    else:
        cleaned = Layer(spark, lake, "processed").tables(schemas.TABLES)
    stage = {t: lambda _stored, t=t: cast_silver(t, cleaned[t]) for t in schemas.TABLES}
    return Layer(spark, lake, "silver").refresh([stage], _silver_check)


def silver_profile(spark: SparkSession, lake: str) -> DataFrame:
    return key_profile(Layer(spark, lake, "silver").tables(schemas.TABLES), schemas.PRIMARY_KEYS)


def _gold_check(tables) -> DataFrame:
    return integrity_report(tables, schemas.GOLD_PRIMARY_KEYS, schemas.GOLD_FOREIGN_KEYS)


def _registry(layer: Layer, name: str, silver):
    """A stage's table: the key registry of a dimension, from the published version's one."""
    _, source, id_column, key = gold.KEYED[name]
    stored = gold.registry_name(name)
    version = layer.version()
    schemas_ = layer.schemas(version) if version else {}
    known = layer.table(stored, version) if stored in schemas_ else None
    if known is None and name in schemas_:  # published without a registry so far
        known = layer.table(name, version).select(id_column, key)
        known = known.where(F.col(id_column).isNotNull())
    return lambda _stored: key_registry(known, silver[source], id_column, key)


def refresh_gold(silver, layer: Layer, *, stable_keys: bool = False) -> dict[str, int]:
    """Write the dimensions, then the fact from the stored dimensions, and publish.

    With ``stable_keys``, each dimension's key registry is a table of the layer: ids
    keep the keys of the published version, and new ones are numbered above them.

    The fact is made in steps, each stored: payments by rental, the finds of large lookups, the
    rows, and these by month. So no two of them have their shuffle files on disk at once.
    """
    scratch = scratch_dir(layer.spark)
    steps = f"{scratch}/steps"
    dims = {name: lambda _stored, b=b: b(silver) for name, b in gold.DIMENSIONS.items()}
    stages = _keyed_stages(silver, layer) if stable_keys else [dims]

    def fact(stored):
        rows = gold.fact_rentals(
            silver["rentals"], silver["payments"], stored, keep=kept_in(steps)
        )
        rows = rows.withColumn("rental_month", F.trunc("rental_date", "MM"))
        rows = kept_in(f"{scratch}/rows")(rows)
        csv.remove(layer.spark, steps)
        return rows

    try:
        return layer.refresh([*stages, {"fact_rentals": fact}], _gold_check, FACT_LAYOUT)
    finally:
        csv.remove(layer.spark, scratch)


def refresh_gold_changes(silver, layer: Layer) -> dict[str, int]:
    """Refresh the star schema with stable keys; of the fact, write the months that changed.

    The layer keeps a row per month with the sums of its rows' digests. A month is made
    anew if they differ, or if a dimension now gives one of its rentals another key; a month that
    has no rentals any more is left out. Months in which nothing changed are taken over
    as they are stored. The first refresh of this kind writes all months. The result is
    that of a full refresh with stable keys. Lists of months go through the driver: a table of
    rentals has one value per month of its calendar.
    """
    published = layer.version()
    parts = layer.parts(published).get("fact_rentals") if published else None
    old = layer.tables([*gold.DIMENSIONS, MONTHS]) if parts is not None else {}
    text = F.coalesce(F.col("rental_month").cast("string"), F.lit(NULL_PART))
    scratch = scratch_dir(layer.spark)

    def changed_months(stored) -> list[str]:
        found = changes.differing(old[MONTHS], stored[MONTHS], "rental_month")
        by_key = changes.months_of_new_keys(silver["rentals"], old, stored)
        if by_key is not None:
            found = found.unionByName(by_key)
        return [r["month"] for r in found.select(text.alias("month")).distinct().collect()]

    def fact(stored):
        rentals = silver["rentals"].withColumn("rental_month", changes.month())
        kept = []
        if parts is not None:
            changed = changed_months(stored)
            rentals = rentals.where(text.isin(changed))
            kept = [p for p in parts if p.split("/rental_month=")[1] not in changed]
        rows = gold.fact_of_rollup(rentals.drop("rental_month"), rollup, stored)
        return Patch(rows.withColumn("rental_month", changes.month()), kept)

    try:
        # read for the digests and for the fact
        with shuffles_dropped(layer.spark):
            write_table(gold.payment_rollup(silver["payments"]), f"{scratch}/rollup")
        rollup = layer.spark.read.parquet(f"{scratch}/rollup")
        state = {MONTHS: lambda _stored: changes.month_digests(silver["rentals"], rollup)}
        stages = [*_keyed_stages(silver, layer), state, {"fact_rentals": fact}]
        return layer.refresh(stages, _gold_check, FACT_LAYOUT)
    finally:
        csv.remove(layer.spark, scratch)


def _keyed_stages(silver, layer: Layer) -> list[dict]:
    """The key registries, and the dimensions by them."""
    dims = {name: lambda _stored, b=b: b(silver) for name, b in gold.DIMENSIONS.items()}
    for name, (build, source, _, _) in gold.KEYED.items():

        def keyed(stored, name=name, build=build, source=source):
            registry = stored[gold.registry_name(name)]
            return build(
                silver[source], lambda df, id_column, key: with_key(df, registry, id_column, key)
            )

        dims[name] = keyed
    return [{gold.registry_name(n): _registry(layer, n, silver) for n in gold.KEYED}, dims]


def build_gold(
    spark: SparkSession, lake: str, *, stable_keys: bool = False, only_changes: bool = False
) -> dict[str, int]:
    silver = Layer(spark, lake, "silver").tables(schemas.TABLES)
    layer = Layer(spark, lake, "gold")
    if only_changes:
        return refresh_gold_changes(silver, layer)
    return refresh_gold(silver, layer, stable_keys=stable_keys)


def run_reports(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    return reports.all_reports(Layer(spark, lake, "gold").tables(GOLD_TABLES))


def store_reports(spark: SparkSession, lake: str) -> dict[str, int]:
    """Write the reports as tables of their own; ``position`` rises in the report's order.

    A report is sorted over all tasks; the positions have gaps between them.
    """
    made = run_reports(spark, lake)
    position = F.monotonically_increasing_id().alias("position")
    stage = {name: lambda _stored, df=df: df.select(position, "*") for name, df in made.items()}
    return Layer(spark, lake, "reports").refresh([stage])
