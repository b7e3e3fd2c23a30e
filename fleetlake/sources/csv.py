"""CSV sources: typed raw loads and all-text reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake import schemas
from fleetlake.functions import columns as C
from fleetlake.sources.records import read_records

# Quotes are doubled inside quoted text. An unquoted empty field is null and a
# quoted one is empty text; the marker below stands for the former while parsing.
_UNQUOTED_EMPTY = "\u0001"
_BEYOND, _ROW = "_beyond_the_header", "_short_row"
_FORMAT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "nullValue": _UNQUOTED_EMPTY,
    "emptyValue": "",
    # every field of a row is parsed, whatever is selected: a malformed row can't pass a count
    "columnPruning": False,
}


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, in whichever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory that these jobs wrote, if it is there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def table_path(directory: str, table: str) -> str:
    return f"{directory.rstrip('/')}/{table}.csv"


def check_sources(
    spark: SparkSession, directory: str, tables=schemas.TABLES, *, need_all: bool = True
) -> list[str]:
    """The tables that have a source; one error names everything that is missing."""
    if not path_exists(spark, directory):
        raise FileNotFoundError(f"no such source directory: {directory}")
    found = [t for t in tables if path_exists(spark, table_path(directory, t))]
    missing = [t for t in tables if t not in found]
    if missing and need_all:
        raise FileNotFoundError(f"missing sources in {directory}: {', '.join(missing)}")
    return found


def _header(spark: SparkSession, path: str, multi_line: bool) -> list[str]:
    return spark.read.options(**_FORMAT, multiLine=multi_line).csv(path).columns


def _parsed(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool, **options
) -> DataFrame:
    """Rows of files by position; with ``multi_line`` quoted text may hold line breaks."""
    options = _FORMAT | options
    if not multi_line:
        return spark.read.schema(schema).options(**options).csv(path)
    texts = {k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items() if k != "header"}
    declared = ", ".join(
        f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields
    )
    parsed = F.from_csv("record", declared, texts)
    rows = read_records(spark, path).select(parsed.alias("row"))
    # in a filter, so that each row is parsed as a whole before columns are taken from it
    return rows.where("row IS NOT NULL").select("row.*")


def _schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_text(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """All columns as text, named by the header row; a row with more or fewer fields raises.

    Files are split among tasks; only text with line breaks inside quotes needs
    ``multi_line``, which shuffles the lines once to find where rows begin.
    """
    schema = _schema(_header(spark, path, multi_line))
    return _parsed(spark, path, schema, multi_line, mode="FAILFAST")


def read_source(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """Text columns as the cleaning jobs take them: every spelling of "no value" is null.

    A short row is filled with nulls; a row with a field too many raises.
    """
    columns = _header(spark, path, multi_line)
    # with one column more than the header, every good row is short, and a long one is not
    schema = _schema([*columns, _BEYOND, _ROW])
    df = _parsed(spark, path, schema, multi_line, columnNameOfCorruptRecord=_ROW)
    long = F.col(_BEYOND).isNotNull() | F.col(_ROW).isNull()
    error = F.raise_error(F.lit(f"a row of {path} has more fields than its header"))
    sound = df.where(F.when(long, error.cast("boolean")).otherwise(F.lit(True)))
    return sound.select(*(C.na_to_null(F.col(c)).alias(c) for c in columns))


def read_raw(
    spark: SparkSession, path: str, table: str, *, multi_line: bool = False
) -> DataFrame:
    """A raw table with its declared types.

    A malformed row, a value of another type or text over its length fails the
    load, whatever is selected from it. Columns are taken by position, as the
    header row is only skipped. Decimals are plain numbers, without groups.
    """
    declared = schemas.raw_schema(table)
    kinds = {f.name: f.dataType.simpleString() for f in T.StructType.fromDDL(declared)}
    decimals = {c: k for c, k in kinds.items() if k.startswith("decimal")}
    as_text = T.StructType(
        [
            T.StructField(f.name, T.StringType() if f.name in decimals else f.dataType)
            for f in T.StructType.fromDDL(declared)
        ]
    )
    df = _parsed(spark, path, as_text, multi_line, mode="FAILFAST")
    # in a filter, so that checks stay whatever columns are taken
    checks = [C.strict(F.col(c), k).isNotNull() | F.col(c).isNull() for c, k in decimals.items()]
    for name, length in schemas.max_lengths(table).items():
        too_long = F.concat(
            F.lit(f"value too long for {table}.{name} ({length} characters): "), F.col(name)
        )
        checks.append(
            F.when(F.length(name) > length, F.raise_error(too_long).cast("boolean")).otherwise(
                F.lit(True)
            )
        )
    # true of every row, but it needs all columns, so that none is read without its type
    checks.append(F.hash(*kinds) >= F.lit(-(1 << 31)))
    for check in checks:
        df = df.where(check)
    return df.select(*(C.strict(F.col(c), k).alias(c) if c in decimals else c for c, k in kinds.items()))


def write_csv(df: DataFrame, path: str, *, rows_per_file: int | None = None) -> None:
    """CSV that the readers above give back unchanged.

    With ``rows_per_file`` the files are compressed. A reader can't split such a file
    among tasks, so none has more rows than that.
    """
    options = _FORMAT | {
        "nullValue": "",
        "emptyValue": '""',
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    if rows_per_file:
        options |= {"compression": "gzip", "maxRecordsPerFile": rows_per_file}
    df.write.mode("overwrite").options(**options).csv(path)
