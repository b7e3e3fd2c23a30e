"""CSV sources and the publishing of layers."""

import os

import pytest
from pyspark.sql import functions as F

from fleetlake import jobs, schemas
from fleetlake.sources import csv
from fleetlake.sources.layers import IntegrityError, Layer, scratch_dir, write_table


def put(directory, table, text):
    path = os.path.join(directory, f"{table}.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


PAYMENTS = "payment_id,rental_id,payment_date,payment_method,amount,payment_type,status\n"


def test_typed_read(spark, tmp_path):
    path = put(tmp_path, "payments", PAYMENTS + '1,2,2024-05-01,"Card, ""gold""",12.345,"",\n2,,,,,,\n')
    df = csv.read_raw(spark, path, "payments")
    assert dict(df.dtypes)["amount"] == "decimal(10,2)"
    first, second = df.orderBy("payment_id").collect()
    assert str(first["amount"]) == "12.35"  # rounded half up to two places
    assert first["payment_method"] == 'Card, "gold"'
    assert first["payment_type"] == "" and first["status"] is None  # quoted and unquoted empty
    assert tuple(second) == (2, None, None, None, None, None, None)


@pytest.mark.parametrize(
    "line",
    [
        "x,2,2024-05-01,Card,1.0,Rental,Completed",
        "1,2,2024-05-01,Card,abc,Rental,Completed",
        '1,2,2024-05-01,Card,"1,234.5",Rental,Completed',
        "1,2,2024-05-01,Card,123456789012.0,Rental,Completed",
        "1,2,2024-05-01,Card,1.0",
        "1,2,2024-05-01,Card,1.0,Rental,Completed,more",
        f"1,2,{'9' * 21},Card,1.0,Rental,Completed",
    ],
)
def test_bad_rows_fail_the_load(spark, tmp_path, line):
    path = put(tmp_path, "payments", PAYMENTS + line + "\n")
    with pytest.raises(Exception, match="(?i)malformed|too long|not a decimal|out of range|cannot be represented"):
        csv.read_raw(spark, path, "payments").collect()
    with pytest.raises(Exception):  # noqa: B017  (whatever is taken)
        csv.read_raw(spark, path, "payments").select("payment_id").collect()
    with pytest.raises(Exception):  # noqa: B017
        csv.read_raw(spark, path, "payments").count()


def test_text_read_follows_the_header(spark, tmp_path):
    path = put(tmp_path, "x", 'b,"a"\n1.50,NA\n"",\n')
    text = csv.read_text(spark, path)
    assert text.dtypes == [("b", "string"), ("a", "string")]
    assert [tuple(r) for r in text.collect()] == [("1.50", "NA"), ("", None)]
    assert [tuple(r) for r in csv.read_source(spark, path).collect()] == [("1.50", None), (None, None)]


@pytest.mark.parametrize("line", ["1,2,3", "1", "1,2,", "1,2,3,4"])
def test_rows_unlike_the_header(spark, tmp_path, line):
    path = put(tmp_path, "x", f"a,b\n5,6\n{line}\n")
    for use in (lambda df: df.collect(), lambda df: df.select("a").collect(), lambda df: df.count()):
        with pytest.raises(Exception):  # noqa: B017
            use(csv.read_text(spark, path))
        if line == "1":
            assert use(csv.read_source(spark, path)) is not None
        else:
            with pytest.raises(Exception, match="more fields"):
                use(csv.read_source(spark, path))
    if line == "1":
        assert [tuple(r) for r in csv.read_source(spark, path).collect()] == [("5", "6"), ("1", None)]


def test_line_breaks_in_quotes(spark, tmp_path):
    path = put(tmp_path, "x", 'a,b\n"one\ntwo",3\n')
    assert [tuple(r) for r in csv.read_text(spark, path, multi_line=True).collect()] == [("one\ntwo", "3")]


def test_round_trip(spark, tmp_path):
    rows = [("", None, 'q"uo"te'), ("a,b", "é", " x "), (None, "", "\\")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    path = str(tmp_path / "t.csv")
    csv.write_csv(df, path)
    assert sorted(csv.read_text(spark, path).collect(), key=str) == sorted(df.collect(), key=str)


def test_missing_sources(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no such source directory"):
        csv.check_sources(spark, str(tmp_path / "nowhere"))
    put(tmp_path, "cars", "car_id\n")
    with pytest.raises(FileNotFoundError, match="locations, customers.*car_condition"):
        csv.check_sources(spark, str(tmp_path))
    assert csv.check_sources(spark, str(tmp_path), need_all=False) == ["cars"]


def test_absent_files_may_be_allowed(spark, tmp_path):
    put(tmp_path, "payments", PAYMENTS + "1,2,2024-05-01,Card,1.0,Rental,Completed\n")
    lake = str(tmp_path / "lake")
    with pytest.raises(FileNotFoundError):
        jobs.load_raw(spark, str(tmp_path), lake)
    rows = jobs.load_raw(spark, str(tmp_path), lake, on_missing="empty")
    assert rows == {t: int(t == "payments") for t in schemas.TABLES}
    assert Layer(spark, lake, "raw").table("cars").columns == list(schemas.raw_types("cars"))


def test_refresh_replaces_the_layer(spark, tmp_path):
    layer = Layer(spark, str(tmp_path), "gold")
    assert layer.version() == 0
    for n in (3, 5):
        assert layer.refresh([{"a": lambda _, n=n: spark.range(n)}, {"b": lambda s: s["a"]}]) == {"a": n, "b": n}
    assert layer.version() == 2
    layer.refresh([{"a": lambda _: spark.range(5)}, {"b": lambda s: s["a"]}])
    assert not os.path.exists(f"{layer.path}/version=1")
    assert os.path.exists(f"{layer.path}/version=2")  # for readers that still use it
    assert {k: df.count() for k, df in layer.tables(["a", "b"]).items()} == {"a": 5, "b": 5}


def test_failures_leave_the_published_version(spark, tmp_path):
    layer = Layer(spark, str(tmp_path), "gold")
    layer.refresh([{"a": lambda _: spark.range(3)}])
    with pytest.raises(IntegrityError, match="version 2 is not published.*bad"):
        layer.refresh(
            [{"a": lambda _: spark.range(9)}],
            lambda tables: tables["a"].where("id = 8").select(F.lit("bad").alias("rule"), "id"),
        )
    with pytest.raises(Exception, match="division|DIVIDE"):
        layer.refresh([{"a": lambda _: spark.range(9).select((F.lit(1) / (F.col("id") - 3)).alias("id"))}])
    assert layer.version() == 1 and layer.table("a").count() == 3


def test_large_partition_value_is_split(spark, tmp_path):
    """One month holds most rows; the write splits it over several files."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        df = spark.range(60000).select(
            "id", F.xxhash64("id").alias("h"), F.when(F.col("id") % 50 == 0, F.col("id") % 7).otherwise(0).alias("m")
        )
        assert write_table(df, str(tmp_path / "t"), "m", ["h"]) == 60000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = [f for f in os.listdir(tmp_path / "t" / "m=0") if f.endswith(".parquet")]
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 60000


class Session:
    """The parts of a session that name the shared folder."""

    def __init__(self, configured=None, master="local[8]"):
        self.configured, self.made, self.master = configured, None, master
        self.conf = self.sparkContext = self
        self.applicationId = f"{master}-{configured}"

    def get(self, name, default):
        return self.configured if name == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.made

    def setCheckpointDir(self, path):
        self.made = path


def test_scratch_dir_follows_the_session():
    shared = Session("hdfs://shared/checkpoints/")
    assert scratch_dir(shared).startswith("hdfs://shared/checkpoints/fleetlake-")
    assert shared.made is None and scratch_dir(shared) != scratch_dir(shared)
    alone = Session()
    first, second = scratch_dir(alone), scratch_dir(alone)
    assert first != second and first.rpartition("/")[0] == second.rpartition("/")[0]
    assert alone.made is None  # the session's own setting stays as it is
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(master="yarn"))


def test_machines_own_folders_are_refused_on_a_cluster(spark, tmp_path):
    class Cluster(Session):
        _jvm, _jsc = spark._jvm, spark._jsc

    assert scratch_dir(Cluster(f"file://{tmp_path}")).startswith("file:/")
    for path in (f"file://{tmp_path}", str(tmp_path)):
        with pytest.raises(ValueError, match="share"):
            scratch_dir(Cluster(path, master="yarn"))


def test_a_mounted_folder_is_taken_where_executors_see_it(spark, tmp_path):
    """A standalone cluster's file system may be a mount; its tasks are asked."""

    class Standalone(Session):
        _jvm, _jsc, defaultParallelism = spark._jvm, spark._jsc, 3

        def parallelize(self, values, parts):
            return spark.sparkContext.parallelize(values, parts)

    class Apart(Standalone):
        """One task of two sees what the driver wrote."""

        def parallelize(self, values, parts):
            return self

        def map(self, _):
            return self

        def collect(self):
            return [True, False]

    for master in ("spark://host:7077", "local-cluster[3,4,1024]"):
        mounted = f"file://{tmp_path}/mounted"
        found = scratch_dir(Standalone(mounted, master=master))
        assert found.startswith(f"{mounted}/fleetlake-") and not os.listdir(tmp_path / "mounted")
        with pytest.raises(ValueError, match="share"):
            scratch_dir(Apart(f"file://{tmp_path}/apart", master=master))


def test_without_a_checkpoint_folder_a_cluster_uses_the_warehouse(spark, tmp_path):
    class Cluster(Session):
        _jvm, _jsc, defaultParallelism = spark._jvm, spark._jsc, 3

        def get(self, name, default):
            return self.configured if name == "spark.sql.warehouse.dir" else default

        def parallelize(self, values, parts):
            return spark.sparkContext.parallelize(values, parts)

    for master in ("local-cluster[3,4,1024]", "spark://host:7077"):
        found = scratch_dir(Cluster(f"file://{tmp_path}/warehouse", master=master))
        assert found.startswith(f"file://{tmp_path}/warehouse/fleetlake-")


def test_a_checkpoint_folder_that_executors_do_not_share_gives_way_to_the_warehouse(spark, tmp_path):
    """Each machine has its own folder of that name: tasks write, and the driver sees nothing."""

    class Own:
        def __init__(self, tasks):
            self.tasks = tasks

        def map(self, _):
            return self

        def collect(self):
            return [True] * self.tasks

    class Cluster(Session):
        _jvm, _jsc, defaultParallelism, asked = spark._jvm, spark._jsc, 3, 0

        def get(self, name, default):
            return {
                "spark.checkpoint.dir": f"{tmp_path}/checkpoints",
                "spark.sql.warehouse.dir": f"file://{tmp_path}/warehouse",
            }.get(name, default)

        def parallelize(self, values, parts):
            self.asked += 1
            return Own(parts) if self.asked == 1 else spark.sparkContext.parallelize(values, parts)

    for master in ("local-cluster[3,4,1024]", "spark://host:7077"):
        cluster = Cluster(tmp_path, master=master)
        for _ in range(2):
            assert scratch_dir(cluster).startswith(f"file://{tmp_path}/warehouse/fleetlake-")
        assert cluster.asked == 2  # once per folder
    assert not os.listdir(tmp_path / "checkpoints") and not os.listdir(tmp_path / "warehouse")


def test_compressed_files_are_bounded(spark, tmp_path):
    text = F.when(F.col("id") % 3 == 0, F.lit("")).when(F.col("id") % 3 == 1, F.lit('a"b, c'))
    df = spark.range(0, 50, 1, 2).select(F.col("id").cast("string").alias("id"), text.alias("t"))
    path = str(tmp_path / "t.csv")
    csv.write_csv(df, path, rows_per_file=10)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 6 and all(f.endswith(".csv.gz") for f in files)
    assert sorted(map(repr, csv.read_text(spark, path).collect())) == sorted(map(repr, df.collect()))
    csv.write_csv(df.where("false"), path, rows_per_file=10)
    assert csv.read_text(spark, path).columns == ["id", "t"] and csv.read_text(spark, path).count() == 0
