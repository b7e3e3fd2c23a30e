"""Exact column medians without gathering a column in one task.

Spark's ``median`` merges every distinct value into a single buffer. Here a
first pass counts the rows per narrow slice of values, which combines map-side
to almost nothing, and finds the slice that holds the middle rank. A second
pass counts the values of that slice only, and orders those of a small part of it.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SLICES_PER_OCTAVE = 256
_ZERO_SLICE = 1 << 20  # above the number of slices that doubles of one sign can fall in
_PARTS = 65536  # of the slice that holds the middle
_LARGEST = sys.float_info.max


def _slice(value: Column) -> Column:
    """A number that never falls as the value grows, one per 0.3 % of magnitude.

    Doubles span about 2100 octaves, so there are a bounded number of slices.
    """
    size = F.least(F.abs(value), F.lit(_LARGEST))
    magnitude = F.floor(F.log2(size) * _SLICES_PER_OCTAVE) + _ZERO_SLICE
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value).cast("int") * magnitude)


def medians(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """One row with the exact median of each double column, nulls ignored.

    An even number of values gives the mean of the middle two; no value gives null.
    """
    names = list(columns)
    pairs = F.array(
        *(F.struct(F.lit(i).alias("c"), columns[n].alias("v")) for i, n in enumerate(names))
    )
    values = (
        df.select(F.inline(pairs))
        .where(F.col("v").isNotNull())
        # never null, so that no join adds a filter to one use of the counts only
        .select("c", "v", F.coalesce(_slice(F.col("v")), F.lit(0)).alias("s"))
    )

    column = Window.partitionBy("c")
    earlier = column.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    middle = (
        values.groupBy("c", "s")
        .agg(
            F.count("*").alias("in_slice"), F.min("v").alias("least"), F.max("v").alias("most")
        )
        .select(
            "c",
            "s",
            "least",
            "most",
            "in_slice",
            F.coalesce(F.sum("in_slice").over(earlier), F.lit(0)).alias("before"),
            F.sum("in_slice").over(column).alias("total"),
        )
        .select(
            "*",
            F.expr("(total + 1) div 2").alias("low_rank"),
            F.expr("total div 2 + 1").alias("high_rank"),
        )
        .where("before < high_rank AND before + in_slice >= low_rank")
        .select("c", "s", "least", "most", "before", "low_rank", "high_rank")
    )

    # At most two slices per column hold the middle ranks, so `middle` is a handful of rows.
    slice_of = ["c", "s", "least", "most", "before", "low_rank", "high_rank"]
    counted = (
        values.join(F.broadcast(middle), ["c", "s"])
        .groupBy(*slice_of, "v")
        .agg(F.count("*").alias("n"))
    )
    # A slice may hold many values, so it is cut again, evenly between its least and its
    # greatest one; only the values of the part that holds the middle are put in order.
    share = (F.col("v") - F.col("least")) / (F.col("most") - F.col("least"))
    part = F.when(F.col("most") > F.col("least"), F.floor(share * _PARTS)).otherwise(F.lit(0))
    cut = counted.withColumn("p", F.coalesce(part, F.lit(0)))
    sooner = Window.partitionBy("c", "s").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    middle_parts = (
        cut.groupBy(*slice_of, "p")
        .agg(F.sum("n").alias("in_part"))
        .withColumn("before", F.col("before") + F.coalesce(F.sum("in_part").over(sooner), F.lit(0)))
        .where("before < high_rank AND before + in_part >= low_rank")
        .select("c", "s", "p", F.col("before").alias("before_part"))
    )
    upto = F.sum("n").over(Window.partitionBy("c", "s", "p").orderBy("v"))
    ranked = cut.join(F.broadcast(middle_parts), ["c", "s", "p"]).select(
        "c", "v", "low_rank", "high_rank", "n", (F.col("before_part") + upto).alias("last")
    )

    def at(rank: str) -> Column:
        first = F.col("last") - F.col("n") + 1
        return F.min(F.when(F.col(rank).between(first, F.col("last")), F.col("v")))

    per_column = ranked.groupBy("c").agg(((at("low_rank") + at("high_rank")) / 2).alias("m"))
    return per_column.agg(
        *(F.max(F.when(F.col("c") == i, F.col("m"))).alias(n) for i, n in enumerate(names))
    )


def fill_with_median(df: DataFrame, names: list[str], seen: DataFrame | None = None) -> DataFrame:
    """Replace nulls of double columns by the column's median over the whole table.

    The medians are read from ``seen``, a copy of these columns, if there is one.
    """
    found = medians(df if seen is None else seen, {n: F.col(n) for n in names})
    value = found.select(F.struct(*names)).scalar()
    return df.withColumns({n: F.coalesce(F.col(n), value.getField(n)) for n in names})
