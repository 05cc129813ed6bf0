"""Shared folders for intermediate results, by Spark's own writers only.

Tables are deleted when the application ends, or earlier by ``release`` where it is known that nothing reads them any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_MADE: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, else the context's checkpoint folder.

    Where neither is set, a local master gets a temporary folder; a cluster's hosts would each see another one, so it gets an error.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    now = context._jsc.sc().getCheckpointDir()
    if not path and now.isDefined():
        path = now.get()
    if not path:
        if not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all hosts share")
        import tempfile

        path = "file://" + tempfile.gettempdir() + "/tessera-shared"
    if now.isEmpty():
        context.setCheckpointDir(path)
    return path.rstrip("/")


def place(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted at the application's end."""
    path = f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"
    at, fs = _located(spark, path)
    fs.deleteOnExit(at)
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _located(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables made within, at the end: for results that have been written by then."""
    made = _MADE.setdefault(spark.sparkContext.applicationId, [])
    before = len(made)
    try:
        yield
    finally:
        for path in made[before:]:
            drop(spark, path)


def drop(spark: SparkSession, path: str) -> None:
    at, fs = _located(spark, path)
    fs.delete(at, True)
    _MADE[spark.sparkContext.applicationId].remove(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def unshuffled(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written within are deleted when it is written."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Writes a Parquet table in the shared folder and reads it again: (table, its path).

    This cuts the lineage as a reliable checkpoint does; besides, columns can be pruned, and the planner knows the table's size
    (of a checkpoint it goes on multiplying what it guessed). What was shuffled for it is deleted at once; else it stays on the executors' disks
    until the driver happens to collect its garbage.
    """
    path = place(df.sparkSession, name)
    with unshuffled(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    return written(df, name)[0]
