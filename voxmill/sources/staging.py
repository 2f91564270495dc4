"""Stage tables: results that several later jobs read, written to shared storage."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
#: For rows of a megabyte: else a page, and the buffers that it is compressed in, holds a hundred of them.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1"}
#: Rows of a table of a few numbers that may be broadcast.
BROADCAST_ROWS = 500_000


def stage_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary folder only in local mode."""
    root = spark.conf.get(_SETTING, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="voxmill-stage-")
        spark.conf.set(_SETTING, root)
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once and read it back, so that it is computed once and survives lost executors.

    ``options``: of the writer, such as ``LARGE_ROWS``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes():
        _scopes()[-1].append(path)
    return path


_local = threading.local()


def _scopes() -> list[list[str]]:
    """The open scopes of this thread, each with the paths given out in it."""
    if not hasattr(_local, "scopes"):
        _local.scopes = []
    return _local.scopes


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder from whatever store it is in."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Stage tables and scratch paths of the block are removed at its end, also if it fails.

    They are on shared storage until then, so a lost executor costs no more than the tasks it ran. What is
    needed after the block must be written by ``settled``, or collected.
    """
    own: list[str] = []
    _scopes().append(own)
    try:
        yield
    finally:
        _scopes().remove(own)
        for path in own:
            remove_path(spark, path)


def settled(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """The result of ``make()`` as a stage table; those that it wrote on the way are removed."""
    path = scratch_path(spark, label)  # of the scope outside
    with scope(spark):
        made = make()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def broadcast_if_small(staged: DataFrame) -> DataFrame:
    """A stage table of a few numbers a row, marked for broadcast if its counted rows allow it."""
    return F.broadcast(staged) if staged.count() <= BROADCAST_ROWS else staged
