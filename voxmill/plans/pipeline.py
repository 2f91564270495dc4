"""From stored pages to reports in one Spark application, stage by stage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.config import DEFAULT_SITE, Site
from voxmill.functions import urls
from voxmill.operators import (
    classifier,
    cleaning,
    crawl,
    enrichment,
    evaluation,
    features,
    insights,
    links,
    pages,
    reports,
    robots,
)
from voxmill.sources import records as io
from voxmill.sources.staging import stage


@dataclass(frozen=True)
class Paths:
    """Where the stages go. Every stage has its own folder; none is overwritten while read."""

    root: str

    def at(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def _written(df: DataFrame, path: str) -> DataFrame:
    io.write_records(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@dataclass(frozen=True)
class Crawl:
    """What a crawl is given besides the stored pages; whatever is left out takes no part.

    ``robots``: host, agent, allow, path_pattern. ``listings``: listing_no, url, html; start pages are
    numbered, -1 for the search and from 0 for categories, pages that only a "Next" link leads to are not.
    """

    robots: DataFrame | None = None
    listings: DataFrame | None = None
    agent: str = "*"
    target_records: int = 30
    light: bool = True
    search_pages: int = 2


def _allowed(rows: DataFrame, rules: DataFrame | None) -> DataFrame:
    return rows if rules is None else robots.judged(rows, rules)


def discover(given: Crawl, rules: DataFrame | None, paths: Paths, site: Site = DEFAULT_SITE) -> tuple[DataFrame, DataFrame]:
    """The queue (link, listing_no, ord, source), and the log of the listings walked for it."""
    scanned = links.page_anchors(given.listings, ("listing_no", "url"))
    if rules is not None:  # a walk ends where the rules forbid the next page
        scanned = robots.judged(scanned, rules).where("robots_allowed")
    scanned = stage(scanned, "listing-pages")
    starts = scanned.where("listing_no is not null").select("listing_no", F.col("url").alias("listing"))
    walks = [
        (starts.where("listing_no < 0"), given.search_pages),
        (starts.where("listing_no >= 0"), 1 if given.light else 2),
    ]
    found = [
        links.listing_links(own.select("listing"), scanned, n, site).join(own, "listing") for own, n in walks
    ]
    found = stage(found[0].unionByName(found[1]).select("listing_no", "ord", "link"), "found-links")
    queue = links.crawl_frontier(
        found.where("listing_no < 0"), found.where("listing_no >= 0"), given.target_records, given.light
    )
    queue = _written(queue, paths.at("queue"))
    return queue, crawl.discovery_log(starts, found, queue, given.target_records, given.light)


def queued_pages(stored: DataFrame, queue: DataFrame) -> DataFrame:
    """Every queued link with its stored page, the first one if several have the link's URL.

    ``stored`` is (seq, url, html). A link without a page keeps its row: ``fetched`` is false.
    """
    first = stored.groupBy(urls.normalize_url(F.col("url")).alias("link")).agg(F.min("seq").alias("seq"))
    placed = queue.join(first, "link", "left")
    return placed.join(stored, "seq", "left").select(
        "seq", "listing_no", "ord", F.coalesce("url", "link").alias("url"), "html",
        F.col("source").alias("discovery_source"), F.col("html").isNotNull().alias("fetched"),
    )


def extract(stored: DataFrame, paths: Paths, order: str = "page_id", min_year: int | None = None,
            site: Site = DEFAULT_SITE, given: Crawl = Crawl()) -> DataFrame:
    """Pages (url, html and an order column) -> raw records of relevant, recent reviews.

    With listings, only queued pages are looked at, in the order of the queue, up to the target. A page
    without html is an error.
    """
    stored = stored.withColumnRenamed(order, "seq").select("seq", "url", "html")
    rules = None if given.robots is None else robots.rule_index(given.robots, given.agent)
    keep, log = ["seq", "fetched"], None
    if given.listings is None:
        visited = stored.withColumn("fetched", F.col("html").isNotNull())
    else:
        queue, log = discover(given, rules, paths, site)
        visited = queued_pages(stored, queue)
        keep += ["listing_no", "ord"]
    visited = _allowed(visited, rules)
    keep += [c for c in ("robots_allowed",) if c in visited.columns]
    carried = [c for c in ("discovery_source",) if c in visited.columns]
    found = pages.page_candidates(visited, (*keep, *carried, "url"))
    outcomes = crawl.crawl_outcomes(pages.extracted(found, keep, site), min_year)
    outcomes = _written(outcomes, paths.at("outcomes"))
    io.write_records(crawl.crawl_status_counts(outcomes), paths.at("crawl_status"), "jsonl")
    io.write_records(crawl.crawl_log(outcomes, min_year, log), paths.at("crawl_log"))
    kept = outcomes.where("status = 'ok_relevant'")
    if given.listings is not None:
        kept = crawl.accept_limit(outcomes, given.target_records, "listing_no", "ord")
    gone = ("status", "review_year", "has_body", "fetched", "robots_allowed", "listing_no", "ord")
    return _written(kept.drop(*gone), paths.at("raw_reviews"))


def preprocess(raw: DataFrame, paths: Paths, site: Site = DEFAULT_SITE) -> DataFrame:
    clean = _written(cleaning.clean_reviews(raw, site=site), paths.at("clean_reviews"))
    io.write_summary(cleaning.preprocess_summary(raw, clean), paths.at("preprocessing_summary"))
    return clean


def extract_features(clean: DataFrame, paths: Paths) -> DataFrame:
    featured = _written(features.record_features(clean), paths.at("featured_reviews"))
    io.write_summary(reports.feature_report(featured), paths.at("feature_summary"))
    return featured


def enrich(featured: DataFrame, paths: Paths) -> DataFrame:
    predicted, metrics = classifier.train_and_predict(featured, paths.at("model"))
    enriched = _written(enrichment.enrich(predicted), paths.at("enriched_reviews"))
    io.write_summary(metrics, paths.at("model_metrics"))
    counts = enrichment.sentiment_distribution(enriched)
    io.write_records(counts, paths.at("sentiment_distribution"), "jsonl")
    return enriched


def report(enriched: DataFrame, paths: Paths) -> None:
    io.write_summary(evaluation.evaluation_report(enriched), paths.at("evaluation_report"))
    io.write_summary(insights.insights(enriched), paths.at("insights"))
    io.write_summary(insights.eda_summary(enriched), paths.at("eda_summary"))


def run(spark: SparkSession, pages_path: str, root: str, min_year: int | None = None,
        site: Site = DEFAULT_SITE, given: Crawl = Crawl()) -> DataFrame:
    """Everything, from a pages table to the enriched records and the reports."""
    paths = Paths(root)
    raw = extract(io.read_pages(spark, pages_path), paths, min_year=min_year, site=site, given=given)
    enriched = enrich(extract_features(preprocess(raw, paths, site), paths), paths)
    report(enriched, paths)
    return enriched
