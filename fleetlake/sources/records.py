"""CSV files with line breaks inside quotes, split among tasks.

A task that reads a range of a file can't know whether its first line begins
inside quotes. What a line does to that is one of four functions: after it, the text is inside
quotes whatever it was before, or outside, or as before, or the other way round. Functions of
lines combine to one of their range, and ranges of a file, of which there are few, combine in
order. So every range learns in which state it begins, and with that where its rows do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MOST_LINES = 100_000

# No quantifier gives back what it took, so a line is matched in one go. An unquoted field may hold
# quotes that aren't its first character; what follows a closing quote belongs to its field.
_INSIDE = '[^"]*+(?:""[^"]*+)*+'
_FIELDS = f'(?:(?:"{_INSIDE}"[^,]*+|(?!")[^,]*+),)*+'
_OPENS = f'^{_FIELDS}"{_INSIDE}$'
_STAYS_OPEN = f'^{_INSIDE}(?:"[^,]*+,{_FIELDS}"{_INSIDE})?+$'


def _after(before: Column) -> Column:
    """Whether the text is inside quotes behind a line, by whether it was before it."""
    return F.when(before, F.col("stays")).otherwise(F.col("opens"))


def _with_turns(functions: DataFrame, order: Window) -> DataFrame:
    """Rows that are functions (opens, stays) in an order, with what ``_state`` needs.

    The state before a row is what the last row that leaves no choice made of it,
    turned by the rows since then that turn it.
    """
    constant, turns = F.col("opens") == F.col("stays"), F.col("opens") & ~F.col("stays")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.coalesce(F.sum(turns.cast("int")).over(earlier), F.lit(0))
    fixed = F.when(constant, F.struct(F.col("opens").alias("state"), F.col("turned").alias("at")))
    last = F.last(fixed, ignorenulls=True).over(earlier)
    # counted behind the row that is fixed, which itself does not turn
    return functions.withColumn("turned", turned).withColumn("fixed", last)


def _state(begins: str) -> Column:
    """Whether the text is inside quotes before a row of ``_with_turns``."""
    return F.expr(
        f"CASE WHEN fixed IS NULL THEN {begins} != (turned % 2 = 1) "
        "ELSE fixed.state != ((turned - fixed.at) % 2 = 1) END"
    )


def read_records(spark: SparkSession, path: str, most_lines: int = MOST_LINES) -> DataFrame:
    """(file, record): each row of CSV files as text, with the line breaks inside its quotes.

    Lines end with a line feed, which a carriage return may precede; inside quotes such a pair becomes a
    line feed, as Spark's reader makes it. The header is left out, and so are blank lines. A row of over ``most_lines`` lines
    fails, as a quote that is never closed would gather the rest of its file in one task.
    """
    place = F.col("_metadata.file_block_start")
    read = spark.read.option("lineSep", "\n").text(path)
    lines = read.select(
        F.col("_metadata.file_path").alias("file"),
        place.alias("range"),
        F.monotonically_increasing_id().alias("id"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )
    lines = lines.withColumns({"opens": F.col("line").rlike(_OPENS), "stays": F.col("line").rlike(_STAYS_OPEN)})
    inside = Window.partitionBy("file", "range").orderBy("id")
    seen = _with_turns(lines.withColumn("number", F.row_number().over(inside)), inside)
    seen = seen.withColumns({"if_outside": _state("false"), "if_inside": _state("true")})

    # a row per range: what it does to the state, and where its last row begins in either case
    ranges = seen.groupBy("file", "range").agg(
        F.max_by(_after(F.col("if_outside")), "number").alias("opens"),
        F.max_by(_after(F.col("if_inside")), "number").alias("stays"),
        F.max(F.when(~F.col("if_outside"), F.col("number"))).alias("last_outside"),
        F.max(F.when(~F.col("if_inside"), F.col("number"))).alias("last_inside"),
    )
    in_order = Window.partitionBy("file").orderBy("range")
    ranges = _with_turns(ranges, in_order).withColumn("begins", _state("false"))
    last = F.when(F.col("begins"), F.col("last_inside")).otherwise(F.col("last_outside"))
    begun = F.when(last.isNotNull(), F.struct(F.col("range").alias("range"), last.alias("number")))
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        "file", "range", "begins", F.last(begun, ignorenulls=True).over(earlier).alias("open_row")
    )

    known = seen.join(ranges, ["file", "range"])
    before = F.when(F.col("begins"), F.col("if_inside")).otherwise(F.col("if_outside"))
    known = known.withColumn("inside", before)
    here = F.when(~F.col("inside"), F.struct("range", "number"))
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    start = F.coalesce(F.last(here, ignorenulls=True).over(upto), F.col("open_row"))
    known = known.withColumn("start", start).where("NOT (start.range = 0 AND start.number = 1)")

    alone = ~F.col("inside") & ~F.col("opens")
    whole = known.where(alone).select("file", F.col("line").alias("record"))
    parts = known.where(~alone).groupBy("file", "start").agg(
        F.count("*").alias("lines"),
        F.sort_array(F.collect_list(F.struct("range", "number", "line"))).alias("parts"),
    )
    message = F.concat(F.lit(f"a row of over {most_lines} lines: is a quote not closed? "), "file")
    sound = F.when(F.col("lines") > most_lines, F.raise_error(message)).otherwise(
        F.array_join(F.transform("parts", lambda p: p["line"]), "\n")
    )
    joined = parts.select("file", sound.alias("record"))
    return whole.unionByName(joined).where("trim(record) <> ''")
