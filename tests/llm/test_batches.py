"""Batches that workers get are bounded in bytes, and so are the pages of tables with rows of a megabyte."""

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill.llm import rows
from voxmill.sources.staging import LARGE_ROWS, stage

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    before = spark.conf.get(SETTING, None)
    spark.conf.unset(SETTING)
    yield
    spark.conf.unset(SETTING)
    if before:
        spark.conf.set(SETTING, before)


def largest(spark):
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    long = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text"))
    return max(r.n for r in rows.map_batches(long, run, T.StructType([T.StructField("n", T.LongType())])).collect())


def test_batches_are_bounded(spark, unset):
    assert largest(spark) < 1.1 * rows.BATCH_BYTES


def test_the_limit_of_the_session_holds(spark, unset):
    spark.conf.set(SETTING, "1m")
    assert largest(spark) < 1.2e6


def test_slices_and_groups_run_on_bounded_batches(spark, unset):
    schema = T.StructType([T.StructField("n", T.LongType())])
    rows.map_slices(spark.range(1), schema, lambda ids: [(i,) for i in ids])
    assert spark.conf.get(SETTING) == str(rows.BATCH_BYTES)
    spark.conf.unset(SETTING)
    rows.map_groups(spark.range(1), ["id"], schema, lambda key: [key])
    assert spark.conf.get(SETTING) == str(rows.BATCH_BYTES)


def test_large_rows_share_no_page_by_the_hundred(spark):
    parts = F.concat(*[F.sha2(F.concat(F.col("id"), F.lit(f" {i}")), 512) for i in range(100)])
    large = spark.range(0, 40, 1, 1).select(F.repeat(parts, 40).alias("data"))
    pages = {}
    for name, options in (("plain", {}), ("large", LARGE_ROWS)):
        back = stage(large, name, **options)
        assert back.distinct().count() == 40
        found = duckdb.sql(f"SELECT unnest(encoding_stats) AS e FROM parquet_metadata({back.inputFiles()})")
        pages[name] = sum(e["count"] for e, in found.fetchall() if e["page_type"].startswith("DATA"))
    assert pages["large"] > 5 * pages["plain"]
