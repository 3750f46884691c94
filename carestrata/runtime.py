"""Session-level helpers: scratch tables, checked broadcasts, table access."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Largest row count, and largest size of all texts together, that a side may have
#: and still be broadcast: far below the 8 GB / 512M-row limits of a broadcast
#: relation and within executor memory.
BROADCAST_MAX_ROWS, BROADCAST_MAX_BYTES = 1_000_000, 64_000_000

#: Bytes of stored input for each partition that shuffles start with, and bytes that
#: a task reads of one: sorts and windows over them take some fifty times as many.
INPUT_PER_PARTITION, READ_PER_TASK = 4_000_000, 16_000_000

#: Bytes of the rows that go to a Python worker at a time: an executor holds a batch as a
#: growing buffer for each of its tasks, and so does each worker.
BYTES_PER_BATCH = 4_000_000

_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_READ_PER_TASK = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

_BYTES_PER_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_fitted: dict[str, int] = {}

_local_scratch: dict[str, str] = {}
_open_scratch: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="carestrata-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/carestrata/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    With ``by``, the table has a folder per value of that column of few values,
    so that a reader of one value opens only that folder.

    This cuts the lineage at a durable table: a lost executor re-reads files
    instead of recomputing the plan, and everything downstream sees the same
    rows (which matters once range partition bounds have been turned into ids).
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if _open_scratch:
        _open_scratch[-1].append(path)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path).select(df.columns)
    table._scratch_path = path
    return table


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def discard(table: DataFrame) -> None:
    """Delete a table of :func:`materialise` that nothing reads any more."""
    remove_path(table.sparkSession, table._scratch_path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete what :func:`materialise` writes inside, once everything is read.

    For jobs whose results are written out before they end.
    """
    _open_scratch.append([])
    try:
        yield
    finally:
        for path in _open_scratch.pop():
            remove_path(spark, path)


def fit_shuffles(spark: SparkSession, input_bytes: int) -> None:
    """Let the shuffles of the session start with partitions in proportion to the input.

    Adaptive execution joins small partitions up to ``READ_PER_TASK`` and splits skewed
    ones, so what a task holds does not grow with the input, whatever number of
    shuffle partitions the session has. What the session sets itself stays, and so does the
    larger number of two folders.
    """
    app = spark.sparkContext.applicationId
    # A new session of the application has no number yet, though the application has.
    found, ours = spark.conf.get(_FIRST_PARTITIONS, None), _fitted.get(app, 0)
    if found not in (None, str(ours)):
        return
    wanted = max(-(-input_bytes // INPUT_PER_PARTITION), int(spark.conf.get("spark.sql.shuffle.partitions")), ours)
    if found != str(wanted):
        spark.conf.set(_FIRST_PARTITIONS, wanted)
        _fitted[app] = wanted
    if spark.conf.get(_READ_PER_TASK, None) is None:
        spark.conf.set(_READ_PER_TASK, READ_PER_TASK)


def fit_batches(spark: SparkSession) -> None:
    """Bound what goes to a Python worker at a time by bytes: ten thousand texts may be any size.

    What the session sets itself stays.
    """
    if spark.conf.get(_BYTES_PER_BATCH, None) is None:
        spark.conf.set(_BYTES_PER_BATCH, BYTES_PER_BATCH)


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` has few rows and little text, by one aggregate over it."""
    texts = [F.length(F.col(f"`{f.name}`")) for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    width = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0).cast("long"))
    rows, size = df.agg(F.count(F.lit(1)), F.sum(width)).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def broadcast_when_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only after measuring it.

    Beyond ``max_rows`` or ``BROADCAST_MAX_BYTES`` the frame is returned untouched,
    so the join becomes a shuffled one whose hot keys adaptive execution splits.
    """
    return F.broadcast(df) if is_small(df, max_rows) else df


def broadcast_bounded(df: DataFrame, label: str, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """:func:`broadcast_when_small` for a frame that is costly to compute twice.

    The frame is written first, so that measuring it reads a stored table.
    """
    return broadcast_when_small(materialise(df, label), max_rows)


def broadcast_for(
    side: DataFrame, big: DataFrame, key: str, label: str, max_rows: int = BROADCAST_MAX_ROWS
) -> DataFrame:
    """:func:`broadcast_bounded`, which first tries the keys that ``big`` uses.

    A side beyond the bound is cut down to the distinct keys of ``big`` (one pass
    over one column) and checked again; if it is still too large, the join is a
    shuffled one.
    """
    table = materialise(side, label)
    if is_small(table, max_rows):
        return F.broadcast(table)
    in_use = big.select(key).distinct()
    return broadcast_bounded(table.join(in_use, key, "left_semi"), label, max_rows)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a dataset folder, stored as ``name.parquet``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
