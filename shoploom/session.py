"""Session settings the plans rely on, and tables written once in the shared folder."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    # Civil times are derived from UTC instants, so the session clock must be UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One customer, order or address may hold a large part of all rows: let the
    # runtime split its join partition even when that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A table by day has a folder per day: few tasks list many folders each, instead of a task for each folder.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}

# Narrow input rows are derived to wide ones and sorted or grouped within a task: it takes on little enough to hold them in
# memory. A session that is set to less stays as it is.
_AT_MOST = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}
_UNITS = {"": 1, "k": 2**10, "m": 2**20, "g": 2**30, "t": 2**40}


def _bytes(text: str) -> int:
    """Size of a setting such as `16m`, `64MB` or `134217728b`."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", text.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the plans rely on.

    They must hold when a result is run, not only while it is built, so they stay set. Pass `spark.newSession()`
    to keep them apart from one's own.
    """
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, most in _AT_MOST.items():
        if _bytes(spark.conf.get(key)) > _bytes(most):
            spark.conf.set(key, most)
    return spark


# Spark's own setting: what a query has shuffled goes when the query ends, not when the driver happens to collect garbage.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Fixed value: files that are read again take about two thirds of the room they take by default.
CODEC = "zstd"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What a write inside has shuffled is removed as soon as its files are there."""
    before = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, before)


def write_files(df: DataFrame, path: str) -> None:
    """Parquet files to be read again; nothing else of the run stays on disk."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, where it is unset one inside the warehouse.

    On a cluster a warehouse in a local folder is the driver's own: there the setting must be given.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not spark.sparkContext.master.startswith("local") and warehouse.startswith(("file:", "/")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{warehouse}/cuts"


def _files(spark: SparkSession, path: str):
    """Hadoop's file system and path of `path`."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def inputs_state(spark: SparkSession, folder: str) -> str:
    """A digest of the names, sizes and modification times of all files of the tables in `folder`."""
    files, top = _files(spark, folder)
    found, todo = [], [top]
    while todo:
        for s in files.listStatus(todo.pop()):
            if s.isDirectory():
                todo.append(s.getPath())
            else:
                found.append(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}")
    return hashlib.sha256("\n".join(sorted(found)).encode()).hexdigest()[:24]


def unique_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    files, where = _files(spark, path)
    files.delete(where, True)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files under `path`."""
    files, where = _files(spark, path)
    return files.getContentSummary(where).getLength()


def read_small(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    files, where = _files(spark, path)
    if not files.exists(where):
        return None
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside `path` and move it there in one step, over what is there."""
    jvm = spark._jvm
    files, beside = _files(spark, f"{path}-{uuid.uuid4().hex}")
    stream = files.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(beside), files.makeQualified(jvm.org.apache.hadoop.fs.Path(path)), options)


_KEPT: list[tuple[str, str, str | None]] = []  # application, path, table


def kept_path(spark: SparkSession, name: str, table: str | None = None) -> str:
    """A new path in the shared folder for what an operator writes on its way; `release` removes it, with its table."""
    path = f"{shared_folder(spark)}/{table}" if table else unique_path(spark, name)
    _KEPT.append((spark.sparkContext.applicationId, path, table))
    return path


def release(spark: SparkSession) -> None:
    """Remove all that operators of this application have written on their way; results that read it can't be run any more."""
    mine = [k for k in _KEPT if k[0] == spark.sparkContext.applicationId]
    for entry in mine:
        _, path, table = entry
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        remove(spark, path)
        _KEPT.remove(entry)


def cut(
    spark: SparkSession, name: str, state: str, make: Callable[[], DataFrame], columns: Sequence[str] | None = None
) -> tuple[DataFrame, str]:
    """The result of `make`, written once as Parquet in the shared folder, and its path.

    Used where several branches of a plan need the same wide result. The copy survives the loss of executors, carries
    true sizes for the join choice, and each branch reads only its own columns. `state` names what the result is made
    from; a copy that this application has finished for the same state is read again, whatever else has changed.

    With `columns` only these are made and written, unless the whole result is there already, which is read then.
    """
    def finished(path: str) -> bool:
        files, where = _files(spark, path)
        return files.exists(spark._jvm.org.apache.hadoop.fs.Path(where, "_SUCCESS"))

    path = f"{shared_folder(spark)}/cut-{name}-{spark.sparkContext.applicationId}-{state}"
    if columns is None:
        if not finished(path):
            write_files(make(), path)
        return spark.read.parquet(path), path
    if not finished(path):
        path = f"{path}-{hashlib.sha256(' '.join(columns).encode()).hexdigest()[:16]}"
        if not finished(path):
            write_files(make().select(*columns), path)
    return spark.read.parquet(path).select(*columns), path
