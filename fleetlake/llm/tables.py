"""Tables in the shared folder, joins with hot keys, and whole groups of sorted rows."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import fleetlake
from fleetlake.sources.layers import scratch_dir


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this library, once per application.

    Spark's own file service does it, so that no path has to be set up beforehand.
    """
    context = spark.sparkContext
    if getattr(context, "_fleetlake_shipped", False):
        return
    root = Path(fleetlake.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="fleetlake-")) / "fleetlake.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as file:
        for path in sorted(root.rglob("*.py")):
            file.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._fleetlake_shipped = True


def stored(df: DataFrame) -> DataFrame:
    """Write a table into the folder that all executors share and read it from there.

    What depends on it starts from files, so a lost executor costs its own tasks
    only, and a second use costs no second computation.
    """
    path = f"{scratch_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_join(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    weight: str,
    how: str = "inner",
    hint: str | None = None,
) -> DataFrame:
    """Join rows with a table of unique keys, however many rows one key has.

    ``weight`` is the table's count of the rows with that key (it is dropped).
    Keys with over a quarter of a partition's share of all rows are broadcast;
    there are at most four per partition, whatever the data. They are told by their
    hashes; another key of such a hash is broadcast, too. Both inputs should
    be stored tables, as they are read twice. Keys must not be null. ``hint`` says
    how the other keys are joined.
    """
    parts = partitions(rows.sparkSession)
    total, most = table.agg(F.sum(weight), F.max(weight)).first()
    named, names = F.xxhash64(*keys), []
    hot_from = (total or 0) / (4 * parts)
    if (most or 0) > hot_from:
        hot = table.where(F.col(weight) > hot_from).select(named.alias("name"))
        names = sorted({row["name"] for row in hot.collect()})
    table = table.drop(weight)
    is_hot = named.isin(names)
    cold = table.where(~is_hot) if names else table
    cold = cold.hint(hint) if hint else cold
    rest = (rows.where(~is_hot) if names else rows).join(cold, keys, how)
    if not names:
        return rest
    return rows.join(F.broadcast(table.where(is_hot)), keys).unionByName(rest)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows that come sorted by key, as tables that cut no key's rows apart.

    Holds a batch and the rows of one key, so keys should have bounded groups.
    """
    kept: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        values = table.column(key).to_numpy()
        # the last key of the batch may go on in the next one
        start = int(np.searchsorted(values, values[-1], side="left"))
        if start:
            yield pa.concat_tables([*kept, table.slice(0, start)])
            kept = []
        elif kept and kept[-1].column(key)[-1].as_py() != values[0]:
            yield pa.concat_tables(kept)
            kept = []
        kept.append(table.slice(start))
    if kept:
        yield pa.concat_tables(kept)


def pairs_at(keys: np.ndarray, lag: int, alive: np.ndarray) -> np.ndarray:
    """Of the places in ``alive``, those whose key is the same ``lag`` places further on."""
    alive = alive[alive + lag < len(keys)]
    return alive[keys[alive] == keys[alive + lag]]


class Forest:
    """Components of places 0..n-1, joined by batches of links."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Join the components of a[i] and b[i]."""
        label = self.label
        while True:
            low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
            open_ = low != high
            if not open_.any():
                return
            a, b, low, high = a[open_], b[open_], low[open_], high[open_]
            np.minimum.at(label, high, low)
            while True:  # every place takes the label of its label
                further = label[label]
                if (further == label).all():
                    break
                label[:] = further

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Places that are not the first of their component, and that first one."""
        places = np.flatnonzero(self.label != np.arange(len(self.label)))
        return places, self.label[places]
