"""Filters and facets over clean records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxmill.functions import text as tx


def in_years(years: Sequence[int] | None = None, include_unknown: bool = False) -> Column:
    """By the year of ``review_date``. ``None`` keeps all; an empty list only unknown years."""
    if years is None:
        return F.lit(True)
    year = tx.extract_year(F.col("review_date"))
    chosen = F.coalesce(year.isin([int(y) for y in years]), F.lit(False))
    return chosen | (year.isNull() & F.lit(include_unknown))


def condition(
    return_only: bool = False,
    warranty_only: bool = False,
    issue: str = "all",
    years: Sequence[int] | None = None,
    include_unknown: bool = False,
) -> Column:
    """All filters in one condition; no part is null unless a flag or the labels are."""
    chosen = in_years(years, include_unknown)
    if return_only:
        chosen &= F.col("has_return_mention")
    if warranty_only:
        chosen &= F.col("has_warranty_mention")
    if issue != "all":
        chosen &= F.array_contains("issue_labels", issue)
    return chosen


def filter_mentions(
    records: DataFrame, return_only: bool = False, warranty_only: bool = False
) -> DataFrame:
    return records.where(condition(return_only, warranty_only))


def filter_issue(records: DataFrame, issue: str = "all") -> DataFrame:
    return records.where(condition(issue=issue))


def filter_years(
    records: DataFrame, years: Sequence[int] | None = None, include_unknown: bool = False
) -> DataFrame:
    return records.where(in_years(years, include_unknown))


def apply_filters(records: DataFrame, **conditions) -> DataFrame:
    """Records that meet ``condition(**conditions)``."""
    return records.where(condition(**conditions))


def available_years(records: DataFrame) -> DataFrame:
    """Distinct years of both dates, latest first."""
    both = F.array(
        tx.extract_year(F.col("review_date")), tx.extract_year(F.col("review_updated_date"))
    )
    return (
        records.select(F.explode(both).alias("year"))
        .where("year is not null")
        .distinct()
        .orderBy(F.desc("year"))
    )


def recent_years(records: DataFrame, min_year: int) -> DataFrame:
    """Years from ``min_year`` on, or all when there is none. The window holds one row per year."""
    years = available_years(records)
    latest = F.max("year").over(W.partitionBy(F.lit(1)))
    return (
        years.withColumn("_latest", latest)
        .where((F.col("year") >= min_year) | (F.col("_latest") < min_year))
        .drop("_latest").orderBy(F.desc("year"))
    )


def issue_values(records: DataFrame) -> DataFrame:
    return records.select(F.explode("issue_labels").alias("label")).distinct().orderBy("label")


def dataset_metrics(records: DataFrame, **conditions) -> DataFrame:
    """Records, those that meet ``condition(**conditions)``, and companies among the latter.

    No company counts as one. One pass over the records.
    """
    chosen = F.coalesce(condition(**conditions), F.lit(False))
    return records.select("company", chosen.alias("_in")).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("_in").alias("filtered_records"),
        (F.count_distinct(F.when(F.col("_in"), F.col("company")))
         + F.coalesce(F.max((F.col("_in") & F.col("company").isNull()).cast("int")), F.lit(0)))
        .alias("distinct_companies"),
    )


def dataset_preview(filtered: DataFrame, rows: int = 100) -> DataFrame:
    return filtered.orderBy("seq").limit(rows)
