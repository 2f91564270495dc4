"""Positions and running totals over a whole table, without one task sorting everything.

The order column is cut into buckets of fixed width. A bucket's offset is the total of the buckets
before it, and a rank within the bucket does the rest. The order column is unique, so a bucket
holds at most ``width`` rows whatever the data looks like. Bucket totals are added up the same way,
``FAN`` of them in a group, level by level until one group holds all of the range. With dense ids
that is one level; ids spread over all 64 bits need three more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_WIDTH = 1_000_000
FAN = 10_000


def _offsets(totals: DataFrame, span: int) -> DataFrame:
    """(_bucket, _offset) of (_bucket, _sum): the sum of all buckets before this one.

    ``span`` bounds the rows: the buckets are integers in a range of that length. No window holds
    more than two ``FAN`` of them.
    """
    if span <= FAN:
        before = F.sum("_sum").over(W.orderBy("_bucket")) - F.col("_sum")
        return totals.select("_bucket", before.alias("_offset"))
    grouped = totals.withColumn("_group", F.expr(f"_bucket div {FAN}"))
    groups = grouped.groupBy("_group").agg(F.sum("_sum").alias("_sum"))
    bases = _offsets(groups.withColumnRenamed("_group", "_bucket"), span // FAN + 2)
    bases = bases.select(F.col("_bucket").alias("_group"), F.col("_offset").alias("_base"))
    before = F.sum("_sum").over(W.partitionBy("_group").orderBy("_bucket")) - F.col("_sum")
    return (
        grouped.withColumn("_before", before)
        .join(bases, "_group")
        .select("_bucket", (F.col("_before") + F.col("_base")).alias("_offset"))
    )


def running_total(
    df: DataFrame, order: str, value: str, out: str, width: int = BUCKET_WIDTH
) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows up to and including this one.

    ``order`` is a unique integer column. An action: one pass finds its least and greatest value;
    read ``df`` from a stage table.
    """
    least, greatest = df.agg(F.min(order), F.max(order)).first()
    span = 1 if least is None else greatest // width - least // width + 2
    bucketed = df.withColumn("_bucket", F.expr(f"{order} div {width}"))
    offsets = _offsets(bucketed.groupBy("_bucket").agg(F.sum(value).alias("_sum")), span)
    within = F.sum(value).over(W.partitionBy("_bucket").orderBy(order))
    return (
        bucketed.withColumn("_within", within)
        .join(offsets, "_bucket")
        .withColumn(out, F.col("_within") + F.col("_offset"))
        .drop("_bucket", "_within", "_offset")
    )


def positions(df: DataFrame, order: str, out: str) -> DataFrame:
    """Add the 1-based position of every row in ``order``."""
    return running_total(df.withColumn("_one", F.lit(1)), order, "_one", out).drop("_one")
