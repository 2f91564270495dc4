"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voxmill.sources.shipping import ship_package

SLICE_ROWS = 256
#: Bytes of the Arrow batches that tasks send to their workers, unless the session sets it. The JVM keeps buffers
#: of the largest ones outside its heap, and twice that while they grow: the default, 64 MB, is much of an executor.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def release() -> None:
    """Give back to the system what a task held; workers live on, and so would their largest size."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def map_batches(
    df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType
) -> DataFrame:
    """``df.mapInArrow`` with batches of about ``BATCH_BYTES``; the setting stays, as the plan runs later."""
    settings = df.sparkSession.conf
    if settings.get(_BATCH_SETTING, None) is None:
        settings.set(_BATCH_SETTING, BATCH_BYTES)
    return df.mapInArrow(run, schema)


def map_slices(
    df: DataFrame, schema: T.StructType, work: Callable[..., Iterable[tuple]], rows: int = SLICE_ROWS,
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """Feed ``df`` to ``work`` in slices of at most ``rows`` rows, one list per column.

    ``work(*columns)`` yields result tuples in the order of ``schema``. A slice bounds what a
    Python worker holds besides the Arrow batch itself. ``done`` drops at the end of a task what
    ``work`` kept, as workers live on into later stages.
    """
    ship_package(df.sparkSession)
    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                made = list(work(*(c.to_pylist() for c in part.columns)))
                if made:
                    columns = zip(*made)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), f.type) for c, f in zip(columns, target)], schema=target
                    )
        if done:
            done()
        release()

    return map_batches(df, run, schema)


def map_groups(
    df: DataFrame, keys: list[str], schema: T.StructType, work: Callable[..., Iterable[tuple]],
    partitions: int | None = None,
) -> DataFrame:
    """Call ``work(key values, *lists of the other columns)`` for each group of equal ``keys``.

    Rows are dealt by the keys and sorted within tasks; a worker holds one group at a time. The
    caller bounds the size of a group.
    """
    ship_package(df.sparkSession)
    target = to_arrow_schema(schema)
    n = len(keys)
    rest = [c for c in df.columns if c not in keys]
    dealt = df.select(*keys, *rest)
    dealt = dealt.repartition(partitions, *keys) if partitions else dealt.repartition(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        current, made = None, []

        def finish():
            if held:
                table = pa.Table.from_batches(held)
                made.extend(work(current, *(c.to_pylist() for c in table.columns[n:])))
                held.clear()

        def out(least: int):
            if len(made) > least:
                columns = list(zip(*made))
                made.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(columns, target)], schema=target
                )

        for batch in batches:
            values = list(zip(*(batch.column(i).to_pylist() for i in range(n))))
            start = 0
            for at in range(1, len(values) + 1):
                if at == len(values) or values[at] != values[start]:
                    if values[start] != current:
                        finish()
                        current = values[start]
                    held.append(batch.slice(start, at - start))
                    start = at
            yield from out(2000)
        finish()
        yield from out(0)
        release()

    return map_batches(dealt.sortWithinPartitions(*keys), run, schema)


#: Rows of a narrow table that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, bytes_per_row: int = 64, limit: int = 32_000_000) -> DataFrame:
    """``df``, a stage table, marked for broadcast if its counted rows prove it small."""
    rows = df.count()
    fits = rows <= BROADCAST_ROWS and rows * bytes_per_row <= limit
    return F.broadcast(df) if fits else df
