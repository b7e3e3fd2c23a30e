"""Parquet layers that are written aside, checked, and then published as a whole.

A layer is a directory of versions. A new version is written next to the
current one; publishing it appends one row to the layer's list of versions, so
readers see all tables of the old version or all of the new one.

A partitioned table may also be refreshed in part: its partitions are then kept
beside the versions, each in the folder of the version that wrote it, and a
version lists those that it is made of.
"""

from __future__ import annotations

import json
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.sources.csv import path_exists, remove

_local_scratch: dict[str, str] = {}
_seen: dict[tuple[str, str], bool] = {}

# Per session: how many blocks drop shuffles just now, and what the setting was before them.
_dropping: dict[str, tuple[int, str | None]] = {}
_dropping_lock = threading.Lock()
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# The folder name that Spark gives to a partition of the null value.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Patch:
    """New rows of some partitions of a table, and the stored partitions that stay as they are."""

    rows: DataFrame
    kept: list[str] = field(default_factory=list)


Build = Callable[[Mapping[str, DataFrame]], DataFrame | Patch]


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """In this block the shuffle files of a query go when it ends, whatever their number.

    Otherwise they stay until the driver happens to collect the plan as garbage, and those
    of a whole refresh add up. Blocks may be nested and run at once in one session; the
    last one to end restores the setting.
    """
    session = spark._jsparkSession.sessionUUID()
    with _dropping_lock:
        blocks, before = _dropping.get(session) or (0, spark.conf.get(_DROP_SHUFFLES, None))
        _dropping[session] = blocks + 1, before
        spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _dropping_lock:
            blocks, before = _dropping.pop(session)
            if blocks > 1:
                _dropping[session] = blocks - 1, before
            elif before is None:
                spark.conf.unset(_DROP_SHUFFLES)
            else:
                spark.conf.set(_DROP_SHUFFLES, before)


def side_by_side(spark: SparkSession, work: Mapping[str, Callable]) -> dict:
    """Run independent jobs at once, so that small ones fill what large ones leave idle.

    All of them end before the first error, if any, is raised.
    """
    with ThreadPoolExecutor(max_workers=max(1, len(work))) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(job)) for name, job in work.items()
        }
    return {name: job.result() for name, job in running.items()}


class IntegrityError(Exception):
    """A layer breaks its keys or references and was not published."""


def scratch_dir(spark: SparkSession) -> str:
    """A new directory name in the folder that the cluster shares for such data.

    That is ``spark.checkpoint.dir``, or the warehouse where no such folder is set or
    the executors don't share it. Only a session without executors of its own (as in
    tests) makes a folder for all that it stores. On a cluster, a folder on a machine's own
    disk is passed over; a folder of a file system that a standalone cluster's machines
    mount is taken if its executors write there and the driver sees it.
    """
    master = spark.sparkContext.master
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if master.startswith("local") and not master.startswith("local-cluster"):
        if not base:
            application = spark.sparkContext.applicationId
            if application not in _local_scratch:
                _local_scratch[application] = tempfile.mkdtemp(prefix="fleetlake-")
            base = f"file://{_local_scratch[application]}"
    else:
        folders = (base, spark.conf.get("spark.sql.warehouse.dir", None))
        base = next((f for f in folders if f and _is_shared(spark, f)), None)
        if not base:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/fleetlake-{uuid.uuid4().hex}"


def _is_shared(spark: SparkSession, path: str) -> bool:
    """Whether a path is not on a machine's own disk."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getUri().getScheme() != "file":
        return True
    mounted = spark.sparkContext.master.startswith(("spark://", "local-cluster"))
    return mounted and _is_seen(spark, hadoop_path, system)


def _is_seen(spark: SparkSession, folder, system) -> bool:
    """Whether the driver sees what tasks on the executors write into its folder; asked once."""
    asked = (spark.sparkContext.applicationId, folder.toString())
    if asked not in _seen:
        trial = spark._jvm.org.apache.hadoop.fs.Path(folder, f"fleetlake-{uuid.uuid4().hex}")
        place = trial.toUri().getPath()

        def wrote(task: int) -> bool:
            try:
                with open(f"{place}/{task}", "w"):
                    return True
            except OSError:
                return False

        tasks = max(2, spark.sparkContext.defaultParallelism)
        _seen[asked] = False
        if system.mkdirs(trial):
            done = spark.sparkContext.parallelize(range(tasks), tasks).map(wrote).collect()
            _seen[asked] = all(done) and len(system.listStatus(trial)) == tasks
            system.delete(trial, True)
    return _seen[asked]


def write_table(
    df: DataFrame, path: str, partition_by: str | None = None, sort_by: list[str] | None = None
) -> int:
    """Write Parquet and return the rows written, counted by the write itself.

    Zstandard takes about two thirds of the disk that Spark's own choice does, and no more time.
    With ``partition_by``, rows are rebalanced by that column first: adaptive
    execution splits a large partition value over several tasks and files.
    """
    if partition_by:
        df = df.hint("rebalance", F.col(partition_by))
        df = df.sortWithinPartitions(partition_by, *(sort_by or []))
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path, compression="zstd")
    return seen.get["rows"]


def kept_in(folder: str) -> Callable[[DataFrame], DataFrame]:
    """A function that stores a table in a folder and gives it back as stored.

    What follows reads the files, so the shuffles before them are gone by then.
    """

    def keep(df: DataFrame) -> DataFrame:
        path = f"{folder}/{uuid.uuid4().hex}"
        write_table(df, path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return keep


def _claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).createNewFile(hadoop_path)


def _folders(spark: SparkSession, path: str, start: str) -> list[str]:
    """Names of the folders in a folder that begin with a text: one per partition."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop_path)
    names = (status.getPath().getName() for status in found if status.isDirectory())
    return sorted(name for name in names if name.startswith(start))


class Layer:
    """One layer (raw, processed, silver or gold) under a root directory.

    Any number of jobs may read it. Refreshes never share a directory: each claims
    a version of its own, and of those that are published the highest is read.
    Tables are read with the schema that they were written with, so that an empty
    table, or a partition column that is always null, keeps its types.
    """

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark = spark
        self.path = f"{root.rstrip('/')}/{name}"
        self._versions = f"{self.path}/_published_versions"

    def _published(self) -> list[int]:
        if not path_exists(self.spark, self._versions):
            return []
        listed = self.spark.read.schema("version bigint").parquet(self._versions)
        return sorted(row["version"] for row in listed.collect())

    def version(self) -> int:
        """The published version, 0 if there is none."""
        return max(self._published(), default=0)

    def _at(self, version: int, name: str) -> str:
        return f"{self.path}/version={version}/{name}"

    def _parts_at(self, name: str, part: str = "") -> str:
        return f"{self.path}/parts/{name}/{part}".rstrip("/")

    def _listed(self, version: int) -> list[Row]:
        # versions without the last column have no partitions beside them
        stored = self.spark.read.schema("name string, fields string, parts array<string>")
        return stored.parquet(self._at(version, "_schemas")).collect()

    def schemas(self, version: int) -> dict[str, T.StructType]:
        rows = self._listed(version)
        return {r["name"]: T.StructType.fromJson(json.loads(r["fields"])) for r in rows}

    def parts(self, version: int) -> dict[str, list[str]]:
        """The partitions of each table that is refreshed in part, as ``part_version=V/column=value``."""
        return {r["name"]: r["parts"] for r in self._listed(version) if r["parts"] is not None}

    def _read(
        self, version: int, name: str, schema: T.StructType, parts: list[str] | None
    ) -> DataFrame:
        reader = self.spark.read.schema(schema)
        if parts is None:
            return reader.parquet(self._at(version, name))
        if not parts:
            return self.spark.createDataFrame([], schema)
        places = [self._parts_at(name, part) for part in parts]
        found = reader.option("basePath", self._parts_at(name)).parquet(*places)
        return found.select(*schema.names)  # without part_version

    def table(self, name: str, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        return self._read(version, name, self.schemas(version)[name], self.parts(version).get(name))

    def tables(self, names: Iterable[str]) -> dict[str, DataFrame]:
        version = self.version()
        schemas, parts = self.schemas(version), self.parts(version)
        return {name: self._read(version, name, schemas[name], parts.get(name)) for name in names}

    def refresh(
        self,
        stages: Iterable[Mapping[str, Build]],
        check: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None,
        layout: Mapping[str, tuple[str, list[str]]] | None = None,
    ) -> dict[str, int]:
        """Write a new version, check it and publish it; returns the rows per table.

        The tables of a stage are written side by side. A table is made by a
        function of the tables that earlier stages stored. Any failure, or any
        row of the report that ``check`` gives for the stored tables, leaves the
        published version as it was. The whole report of a refused version is
        stored beside its tables, and the error names its place and counts.

        A function that gives a ``Patch`` writes only its rows, by the partition
        column of ``layout``, and the version takes the kept partitions over without
        a copy. Rows are counted of the whole table. Such a refresh fails if two others were
        published meanwhile, as what it keeps may be removed then.
        """
        with shuffles_dropped(self.spark):
            return self._refresh(stages, check, layout)

    def _refresh(self, stages, check, layout) -> dict[str, int]:
        published = self._published()
        version = max(published, default=0) + 1
        while not _claim(self.spark, f"{self.path}/_claims/{version}"):
            version += 1
        rows: dict[str, int] = {}
        stored: dict[str, DataFrame] = {}
        kinds: dict[str, T.StructType] = {}
        parts: dict[str, list[str]] = {}

        def write(name: str, build: Build) -> int:
            partition_by, sort_by = (layout or {}).get(name, (None, None))
            df = build(stored)
            if isinstance(df, Patch):
                kinds[name] = df.rows.schema
                own = f"part_version={version}"
                write_table(df.rows, self._parts_at(name, own), partition_by, sort_by)
                made = _folders(self.spark, self._parts_at(name, own), f"{partition_by}=")
                parts[name] = [*df.kept, *(f"{own}/{folder}" for folder in made)]
                self._need_kept(published)
                return self._read(version, name, kinds[name], parts[name]).count()
            kinds[name] = df.schema
            return write_table(df, self._at(version, name), partition_by, sort_by)

        for stage in stages:
            rows |= side_by_side(
                self.spark, {name: partial(write, name, build) for name, build in stage.items()}
            )
            stored |= {
                name: self._read(version, name, kinds[name], parts.get(name)) for name in stage
            }
        written = [(name, json.dumps(kinds[name].jsonValue()), parts.get(name)) for name in rows]
        kind = "name string, fields string, parts array<string>"
        fields = self.spark.createDataFrame(written, kind).coalesce(1)
        fields.write.mode("overwrite").parquet(self._at(version, "_schemas"))
        if check is not None:
            self._refuse_if_any(check(stored), version)
        if parts:
            self._need_kept(published)
        one = self.spark.range(version, version + 1, 1, 1).select(F.col("id").alias("version"))
        one.write.mode("append").parquet(self._versions)
        # readers that began on the version before may still need it
        used = {(n, p) for v in (version, *published[-1:]) for n, ps in self.parts(v).items() for p in ps}
        for old in published[:-1]:
            if not path_exists(self.spark, self._at(old, "_schemas")):
                continue  # removed by an earlier refresh
            for name, part in {(n, p) for n, ps in self.parts(old).items() for p in ps} - used:
                remove(self.spark, self._parts_at(name, part))
            remove(self.spark, f"{self.path}/version={old}")
        return rows

    def _need_kept(self, published: list[int]) -> None:
        """What a refresh in part takes over is there only while its version is one of the last two."""
        if published and published[-1] not in self._published()[-2:]:
            raise RuntimeError(f"{self.path}: others were published since version {published[-1]}")

    def _refuse_if_any(self, found: DataFrame, version: int) -> None:
        place = self._at(version, "_violations")
        if not write_table(found, place):
            return
        report = self.spark.read.schema(found.schema).parquet(place)
        by = [c for c in ("table_name", "rule") if c in report.columns]
        # a row per rule of the layer
        counted = report.groupBy(*by).count().orderBy(*by).collect()
        total = sum(r["count"] for r in counted)
        raise IntegrityError(
            f"{self.path} version {version} is not published: {total} violations, all in {place}: "
            + "; ".join(f"{', '.join(r[c] for c in by)}: {r['count']}" for r in counted)
        )
