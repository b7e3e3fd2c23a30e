"""Dense surrogate keys and insert-if-absent."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Bounds the constants of a plan. It drops nothing: beyond it, buckets hold more rows.
MOST_BUCKETS = 8192


def _cut_points(df: DataFrame, id_column: str, buckets: int) -> list[float]:
    """Quantiles of the ids, at most one less than there are buckets."""
    shares = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    quantiles = F.expr(f"percentile_approx(`{id_column}`, array({shares}), {20 * buckets})")
    found = df.agg(quantiles).first()[0]
    return sorted({float(cut) for cut in found or []})


def surrogate_key(
    df: DataFrame,
    id_column: str,
    key: str,
    buckets: int | None = None,
    most_buckets: int = MOST_BUCKETS,
) -> DataFrame:
    """Number the rows 1..n in order of a numeric id, nulls last; rows of one id in any order.

    ``row_number`` over the whole table would sort it in one task. The ids are
    cut at their own quantiles instead, so that the buckets hold about equally
    many rows however the ids are spread; each bucket is numbered on its own,
    from the count of rows in the buckets before it. The cut points (at most
    ``buckets`` numbers) are fetched once and are constants of the plan, so a
    recomputed task puts every row in the same bucket as before. By default there
    are four buckets per shuffle partition. Rows without an id have buckets of
    their own behind the others, by the hash of their other columns.
    """
    if buckets is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = min(4 * partitions, most_buckets)
    # an empty table still needs a valid bucketing
    cuts = _cut_points(df, id_column, buckets) or [0.0]
    splits = [float("-inf"), *cuts, float("inf")]
    bucketed = (
        Bucketizer(
            splits=splits, inputCol="_id", outputCol="_bucket", handleInvalid="keep"
        )
        .transform(df.withColumn("_id", F.col(id_column).cast("double")))
        .drop("_id")
    )
    others = [c for c in df.columns if c != id_column]
    slice_ = F.pmod(F.xxhash64(*others), F.lit(buckets)) if others else F.lit(0)
    # behind the buckets of the numbers and the one of NaN
    bucketed = bucketed.withColumn("_bucket", F.coalesce("_bucket", slice_ + float(len(splits))))

    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_rows"))
        .select(
            "_bucket",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        )
    )
    within = Window.partitionBy("_bucket").orderBy(F.col(id_column).asc_nulls_last())
    # One offset per bucket: the broadcast side never has more than `buckets` + 1 rows.
    return (
        bucketed.withColumn("_number", F.row_number().over(within))
        .join(F.broadcast(offsets), "_bucket")
        .select((F.col("_offset") + F.col("_number")).alias(key), *df.columns)
    )


def key_registry(known: DataFrame | None, ids: DataFrame, id_column: str, key: str) -> DataFrame:
    """(id, key): the keys that ids have for good; known ones as they are, new ones above them.

    New ids are numbered on from the highest known key, in their order. Ids that
    are no longer there keep their keys, for when they come back. Null ids have none. ``known``
    is the registry so far (None at first), with unique ids; it should be stored, as it is read twice.
    """
    found = ids.select(id_column).where(F.col(id_column).isNotNull()).distinct()
    if known is None:
        return surrogate_key(found, id_column, key).select(id_column, key)
    new = found.join(known.select(id_column), id_column, "left_anti")
    highest = known.agg(F.coalesce(F.max(key), F.lit(0)).alias("_highest"))
    numbered = surrogate_key(new, id_column, key).crossJoin(F.broadcast(highest))  # of one row
    return known.select(id_column, key).unionByName(
        numbered.select(id_column, (F.col("_highest") + F.col(key)).alias(key))
    )


def with_key(df: DataFrame, registry: DataFrame, id_column: str, key: str) -> DataFrame:
    """Rows with the key that the registry has for their id, which comes first; null for a null id."""
    return df.join(registry, id_column, "left").select(key, *df.columns)


def insert_if_absent(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Append the new rows whose key is not there yet; existing rows stay as they are.

    Of several new rows with one key the smallest (by the columns in order) is
    taken, so a rerun gives the same rows. They are reduced before the join,
    which therefore sees each key once.
    """
    columns = [c for c in existing.columns if c != key]
    one_each = (
        new.groupBy(key)
        .agg(F.min(F.struct(*columns)).alias("_row"))
        .select(key, "_row.*")
    )
    return existing.unionByName(one_each.join(existing.select(key), key, "left_anti"))
