"""What becomes of each queued page: status, recency, acceptance and counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.functions import text as tx
from voxmill.functions import urls
from voxmill.operators.numbering import running_total
from voxmill.sources.staging import stage


def record_year() -> Column:
    """The later year of the two dates; null when neither has one."""
    return F.greatest(
        tx.extract_year(F.col("review_date")), tx.extract_year(F.col("review_updated_date"))
    )


def default_min_year() -> Column:
    return F.year(F.current_timestamp()) - 4


def recency_filter(records: DataFrame, min_year: int | None = None) -> DataFrame:
    """Records from ``min_year`` on. A record without a year is dropped."""
    least = default_min_year() if min_year is None else F.lit(min_year)
    return records.where(record_year() >= least)


def crawl_outcomes(
    extracted: DataFrame,
    min_year: int | None = None,
    rules: Sequence[tuple[bool, str]] = (),
) -> DataFrame:
    """Add ``status`` and ``review_year`` to extracted pages; the first reason to skip decides.

    Robots rules of many hosts come as a column ``robots_allowed``, else one site's as ``rules``. A page
    whose ``html`` could not be had is an ``error``; ``fetched`` tells, where present.
    """
    least = default_min_year() if min_year is None else F.lit(min_year)
    fetched = F.col("fetched") if "fetched" in extracted.columns else F.lit(True)
    judged = "robots_allowed" in extracted.columns
    allowed = F.col("robots_allowed") if judged else urls.robots_allowed(F.col("raw_url"), rules)
    status = (
        F.when(~allowed, "skipped_by_robots")
        .when(~fetched, "error")
        .when(~F.col("has_body"), "no_review_body")
        .when(~F.col("is_warranty_return_relevant"), "skipped_not_relevant")
        .when(~F.coalesce(record_year() >= least, F.lit(False)), "skipped_old_year")
        .otherwise("ok_relevant")
    )
    return extracted.withColumns({"status": status, "review_year": record_year()})


def crawl_log(outcomes: DataFrame, min_year: int | None = None, discovery: DataFrame | None = None) -> DataFrame:
    """One log row per page, after those of ``discovery_log``, in the union schema of all entries."""
    least = default_min_year() if min_year is None else F.lit(min_year)
    old = F.col("status") == "skipped_old_year"
    reason = F.when(F.col("status") == "skipped_by_robots", "robots_disallow").when(
        F.col("status") == "error", "not_fetched")
    log = outcomes.select(
        "status", F.col("raw_url").alias("url"), reason.alias("reason"),
        F.when(old, F.col("review_date")).alias("review_date"),
        F.when(old, least).alias("min_year"),
        F.when(F.col("status") == "ok_relevant", F.col("review_year")).alias("review_year"),
    )
    return log if discovery is None else discovery.unionByName(log, allowMissingColumns=True)


def discovery_log(
    listings: DataFrame, found: DataFrame, frontier: DataFrame, target_records: int, light: bool = True
) -> DataFrame:
    """(status, url, complaint_links_found, queued_complaints) of the listings that were walked.

    ``listings`` is (listing_no, listing), ``found`` (listing_no, ord, link) with distinct links per
    listing. Categories count as walked while the queue before them is under the cap; the search (-1)
    always is, and tells how many links it queued.
    """
    cap = int(target_records * (1.5 if light else 3))
    count = F.count(F.lit(1))
    sizes = (
        listings.join(found.groupBy("listing_no").agg(count.alias("found")), "listing_no", "left")
        .join(frontier.groupBy("listing_no").agg(count.alias("queued")), "listing_no", "left")
        .select("listing_no", "listing", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("found", "queued")])
    )
    walked = running_total(stage(sizes, "listings"), "listing_no", "queued", "upto").where(
        (F.col("listing_no") < 0) | (F.col("upto") - F.col("queued") < cap)
    )
    nothing = F.lit(None).cast("long")
    rows = F.array(
        F.struct(F.lit("listing_scraped").alias("status"), F.col("found").alias("complaint_links_found"),
                 nothing.alias("queued_complaints")),
        F.struct(F.lit("search_seed_complete").alias("status"), nothing.alias("complaint_links_found"),
                 F.col("upto").alias("queued_complaints")),
    )
    entries = F.when(F.col("listing_no") < 0, rows).otherwise(F.slice(rows, 1, 1))
    return walked.select(F.col("listing").alias("url"), F.inline(entries)).select(
        "status", "url", "complaint_links_found", "queued_complaints"
    )


def accept_limit(outcomes: DataFrame, target_records: int, *order: str) -> DataFrame:
    """The first accepted records in queue order."""
    return outcomes.where("status = 'ok_relevant'").orderBy(*(order or ["ord"])).limit(target_records)


def crawl_status_counts(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("status").agg(F.count(F.lit(1)).alias("pages"))


def crawl_summary(
    frontier: DataFrame, accepted: DataFrame, target_records: int, min_year: int, light: bool = True
) -> DataFrame:
    """One row: parameters, queued links and collected records."""
    queued = frontier.agg(F.count(F.lit(1))).scalar()
    return accepted.agg(F.count(F.lit(1)).alias("records_collected")).select(
        F.lit(target_records).alias("target_records"), "records_collected",
        queued.alias("queued_urls"), F.lit(light).alias("light_mode"),
        F.lit(min_year).alias("min_year"),
    )
