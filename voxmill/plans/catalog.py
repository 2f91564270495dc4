"""Every operator as a named query over the supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill import lexicons as lx
from voxmill import schemas
from voxmill.functions import labels as lb
from voxmill.functions import text as tx
from voxmill.functions import urls
from voxmill.operators import (
    classifier,
    cleaning,
    crawl,
    enrichment,
    evaluation,
    features,
    filters,
    insights,
    links,
    pages,
    reports,
    robots,
    search,
    search_index,
    tfidf,
)
from voxmill.plans import pipeline
from voxmill.sources import records as io
from voxmill.sources import testviews as tv
from voxmill.sources.staging import scratch_path, stage

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered queries.
MIN_YEAR = 1998
TARGET_RECORDS = 200
QUERY = "warranty claim denied"
FILTERED_QUERY = "warranty claim denied refund"
ROBOTS = [
    (False, "/en/4"), (False, "/*?page="), (True, "/en/45"), (False, "/*.html$"), (False, ""),
]


def joined(name: str):
    return F.array_join(name, "|").alias(name)


# --- Inputs that several queries share ---

def clean(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.clean_reviews(tv.raw_reviews(spark, sf))


def staged_clean(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """For queries that go over the clean records more than once; with ``columns``, of these only."""
    records = clean(spark, sf)
    return stage(records.select(*columns) if columns else records, "clean")


#: What fits and searches read, and what the classifier does.
SEARCHED = ("seq", "review_text", "review_text_normalized")
CLASSIFIED = (*SEARCHED, "issue_labels")
#: What results show besides.
SHOWN = (*CLASSIFIED, "title", "root_cause_suggestion", "breadcrumbs", "comments")


def kept(spark: SparkSession, sf: str) -> DataFrame:
    raw = schemas.complete(tv.raw_reviews(spark, sf), schemas.RAW_REVIEW)
    return cleaning.fill_defaults(cleaning.dedup_reviews(raw))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.add_labels(cleaning.add_clean_text(kept(spark, sf)))


def enriched(spark: SparkSession, sf: str) -> DataFrame:
    return enrichment.enrich(classifier.fallback_predict(clean(spark, sf)))


def found_pages(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_candidates(tv.review_pages(spark, sf), ("seq", "url"))


def with_body(spark: SparkSession, sf: str) -> DataFrame:
    return pages.page_text(found_pages(spark, sf).where("body is not null"))


def extracted(spark: SparkSession, sf: str) -> DataFrame:
    return pages.review_records(found_pages(spark, sf), ("seq",))


def outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.crawl_outcomes(pages.extracted(found_pages(spark, sf), ("seq",)), MIN_YEAR)


def scanned_listings(spark: SparkSession, sf: str) -> DataFrame:
    return links.page_anchors(tv.listing_pages(spark, sf), ("listing_no", "page_no", "url"))


def all_pages(spark: SparkSession, sf: str) -> DataFrame:
    return io.read_pages(spark, f"{sf}/pages.parquet")


# --- Sources and sinks ---

def read_records(spark: SparkSession, sf: str) -> DataFrame:
    raw = schemas.complete(tv.raw_reviews(spark, sf), schemas.RAW_REVIEW)
    path = scratch_path(spark, "records")
    io.write_records(raw.select(*schemas.RAW_REVIEW.fieldNames()), path, "jsonl")
    back = io.read_records(spark, path, schemas.RAW_REVIEW, "jsonl")
    return back.select("title", "record_id", "company", "rating", "review_text", "raw_url")


def read_robots(spark: SparkSession, sf: str) -> DataFrame:
    """One robots file per page, made from its path."""
    path = urls.url_path(F.col("url"))
    body = F.concat(
        F.lit("# rules\nUser-agent: *\nDisallow: "), path, F.lit("\nAllow: "), path,
        F.lit("/open # part\nSitemap: /map.xml\n\nUser-agent: Own-Bot\nDisallow:\nDisallow: /"),
    )
    files = all_pages(spark, sf).select(
        F.col("page_id").cast("string").alias("origin"), body.alias("body")
    )
    return io.parse_robots(files)


def write_records(spark: SparkSession, sf: str) -> DataFrame:
    path = io.write_records(clean(spark, sf), scratch_path(spark, "clean"))
    back = io.read_records(spark, path)
    return back.select("seq", "record_id", "category", F.size("tokens").alias("n_tokens"))


def write_summaries(spark: SparkSession, sf: str) -> DataFrame:
    raw = tv.raw_reviews(spark, sf)
    summary = cleaning.preprocess_summary(raw, stage(cleaning.clean_reviews(raw), "clean"))
    path = io.write_summary(summary, scratch_path(spark, "summary"))
    return spark.read.schema(summary.schema).json(path)


# --- Pages ---

def page_candidates(spark: SparkSession, sf: str) -> DataFrame:
    return with_body(spark, sf).select(
        "seq", F.col("_h1").alias("h1"), F.col("_body").alias("body"),
        tx.collapse_ws(F.col("_box")).alias("box"),
    )


def page_field(column: Callable, name: str, spark: SparkSession, sf: str) -> DataFrame:
    return with_body(spark, sf).select("seq", column().alias(name))


def page_breadcrumbs(spark: SparkSession, sf: str) -> DataFrame:
    return with_body(spark, sf).select(
        "seq", F.array_join(pages.breadcrumbs(), "|").alias("breadcrumbs")
    )


def page_labeled_field(spark: SparkSession, sf: str) -> DataFrame:
    return with_body(spark, sf).select(
        "seq", pages.labelled_field("Claimed loss").alias("claimed_loss"),
        pages.labelled_field("Desired outcome").alias("desired_outcome"),
    )


def page_reviewer(spark: SparkSession, sf: str) -> DataFrame:
    name, location = pages.reviewer()
    return with_body(spark, sf).select(
        "seq", name.alias("reviewer_name"), location.alias("reviewer_location")
    )


def page_comments(spark: SparkSession, sf: str) -> DataFrame:
    found = found_pages(spark, sf).where("body is not null")
    return found.withColumn("c", pages.comments()).select("seq", F.inline("c")).select(
        "seq", "comment_id", "author_name", "author_location", "posted_at", "text",
        "helpful_count", "is_company_response",
    )


def page_comments_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return extracted(spark, sf).select("seq", F.size("comments").alias("n_comments"))


def page_relevance(spark: SparkSession, sf: str) -> DataFrame:
    return extracted(spark, sf).select(
        "seq", "relevance_score", "is_warranty_return_relevant", "has_return_mention",
        "has_warranty_mention",
    )


def review_records(spark: SparkSession, sf: str) -> DataFrame:
    return extracted(spark, sf).select(
        "seq", "record_id", "source", "company", "category", joined("breadcrumbs"), "title",
        "review_text", "review_date", "review_updated_date", "reviewer_name", "rating",
        "comment_count", "helpful_count", "claimed_loss", "desired_outcome",
        "is_featured_review", F.size("comments").alias("n_comments"), "full_text_with_comments",
        "relevance_score", "raw_url", "discovery_source",
    )


def page_details(spark: SparkSession, sf: str) -> DataFrame:
    """Every rule with optional parts, on pages that have them or not."""
    found = pages.page_candidates(tv.detailed_pages(spark, sf), ("seq", "url"))
    replies = F.transform("comments", lambda c: F.concat_ws(
        "/", c["author_name"], c["author_location"], c["helpful_count"], c["is_company_response"]))
    return pages.review_records(found, ("seq",)).select(
        "seq", "company", "category", joined("breadcrumbs"), "reviewer_name", "reviewer_location", "rating",
        "helpful_count", "desired_outcome", "review_updated_date", "is_featured_review",
        F.array_join(replies, "|").alias("comments"),
    )


def collapse_ws(spark: SparkSession, sf: str) -> DataFrame:
    docs = tv.table(spark, sf, "documents")
    return docs.select("doc_id", tx.collapse_ws(F.col("text")).alias("text"))


# --- Links and crawl ---

def page_links(spark: SparkSession, sf: str) -> DataFrame:
    scanned = links.page_anchors(tv.review_pages(spark, sf), ("seq",))
    return links.page_links(scanned, ("seq",))


def absolute_url(spark: SparkSession, sf: str) -> DataFrame:
    anchors = links.page_anchors(all_pages(spark, sf), ("page_id",))
    absolute = F.transform("anchors", lambda a: urls.absolute_url(tx.trim_ws(a["href"])))
    return anchors.select("page_id", F.posexplode(absolute).alias("pos", "link"))


def item_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    both = tv.reviews(spark, sf).select(F.col("raw_url").alias("url")).unionByName(
        all_pages(spark, sf).select("url")
    )
    return both.groupBy("url").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "is_item", urls.is_item_url(F.col("url"))
    )


def normalize_url(spark: SparkSession, sf: str) -> DataFrame:
    return all_pages(spark, sf).select("page_id", urls.normalize_url(F.col("url")).alias("link"))


def subcategory_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    listed = tv.listing_pages(spark, sf).select("url")
    both = listed.unionByName(all_pages(spark, sf).select("url")).unionByName(
        tv.reviews(spark, sf).select(F.col("raw_url").alias("url"))
    )
    return both.distinct().withColumn("is_subcategory", urls.is_subcategory_url(F.col("url")))


def next_page_link(spark: SparkSession, sf: str) -> DataFrame:
    return links.next_page_link(scanned_listings(spark, sf)).select("url", "next_url")


def subcategory_links(spark: SparkSession, sf: str) -> DataFrame:
    scanned = links.page_anchors(all_pages(spark, sf), ("page_id", "url"))
    found = links.subcategory_links(scanned, 2, 2, "page_id")
    return found.select("page_id", "link")


def hub_links(spark: SparkSession, sf: str) -> DataFrame:
    scanned = links.page_anchors(tv.hub_pages(spark, sf), ("hub_no",))
    return links.subcategory_links(scanned, 2, 2, "hub_no").select("hub_no", "link")


def listing_links(spark: SparkSession, sf: str) -> DataFrame:
    scanned = stage(scanned_listings(spark, sf), "listings")
    starts = scanned.where("page_no = 1").select(F.col("url").alias("listing"))
    return links.listing_links(starts, scanned, max_pages=2)


def frontier(spark: SparkSession, sf: str) -> DataFrame:
    found = scanned_listings(spark, sf).select(
        (F.col("listing_no") - 1).alias("listing_no"), "page_no",
        F.posexplode(links.item_links(F.col("anchors"))).alias("pos", "link"),
    )
    place = (F.col("page_no") - 1).cast("long") * (1 << 31) + F.col("pos")
    found = stage(found.withColumn("ord", place), "links")
    return links.crawl_frontier(
        found.where("listing_no = -1"), found.where("listing_no >= 0"), TARGET_RECORDS
    )


def robots_filter(spark: SparkSession, sf: str) -> DataFrame:
    allowed, skipped = links.robots_filter(all_pages(spark, sf).select("url"), ROBOTS)
    passed = allowed.select("url", F.lit("allowed").alias("status"))
    return passed.unionByName(skipped.select("url", "status"))


def _host_rules(spark: SparkSession, sf: str) -> DataFrame:
    return io.parse_robots(tv.robots_files(spark, sf)).withColumnRenamed("origin", "host")


def robots_by_host(spark: SparkSession, sf: str) -> DataFrame:
    index = robots.rule_index(_host_rules(spark, sf), "review-bot/1.0")
    return robots.judged(tv.hosted_pages(spark, sf).select("seq", "url"), index)


def outcomes_by_host(spark: SparkSession, sf: str) -> DataFrame:
    index = robots.rule_index(_host_rules(spark, sf), "review-bot/1.0")
    visited = tv.hosted_pages(spark, sf).withColumn("fetched", F.col("html").isNotNull())
    keep = ("seq", "fetched", "robots_allowed")
    found = pages.page_candidates(robots.judged(visited, index), (*keep, "url"))
    return crawl.crawl_outcomes(pages.extracted(found, keep), MIN_YEAR)


def crawl_outcomes_by_host(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.crawl_log(outcomes_by_host(spark, sf), MIN_YEAR)


def crawl_extract(spark: SparkSession, sf: str) -> DataFrame:
    """Listings walked, queue filled, queued pages judged, records up to the target."""
    listings = tv.listing_pages(spark, sf).select(
        F.when(F.col("page_no") == 1, F.col("listing_no") - 1).alias("listing_no"), "url", "html"
    )
    given = pipeline.Crawl(_host_rules(spark, sf), listings, "review-bot/1.0", TARGET_RECORDS, search_pages=4)
    stored = tv.review_pages(spark, sf).where("seq % 23 <> 0")
    paths = pipeline.Paths(scratch_path(spark, "crawl"))
    kept = pipeline.extract(stored, paths, "seq", MIN_YEAR, given=given)
    return kept.select("seq", "raw_url", "discovery_source")


def crawl_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    return outcomes(spark, sf).select("seq", "status")


def crawl_log(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.crawl_log(outcomes(spark, sf), MIN_YEAR).select(
        "url", "status", "review_date", "min_year", "review_year"
    )


def recency_filter(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.recency_filter(tv.reviews(spark, sf), MIN_YEAR).select("seq")


def extract_year(spark: SparkSession, sf: str) -> DataFrame:
    return tv.reviews(spark, sf).select(
        "seq", tx.extract_year(F.col("review_date")).alias("review_year"),
        tx.extract_year(F.col("review_updated_date")).alias("updated_year"),
    )


def accept_limit(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.accept_limit(outcomes(spark, sf), 50, "seq").select("seq", "raw_url")


def discovery_source(spark: SparkSession, sf: str) -> DataFrame:
    return all_pages(spark, sf).select(
        "page_id", links.discovery_source(F.col("url")).alias("discovery_source")
    )


def crawl_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return crawl.crawl_status_counts(outcomes(spark, sf))


def crawl_summary(spark: SparkSession, sf: str) -> DataFrame:
    accepted = crawl.accept_limit(outcomes(spark, sf), TARGET_RECORDS, "seq")
    return crawl.crawl_summary(frontier(spark, sf), accepted, TARGET_RECORDS, MIN_YEAR)


# --- Cleaning ---

def normalize_text(spark: SparkSession, sf: str) -> DataFrame:
    return tv.reviews(spark, sf).select(
        "seq", tx.normalize_text(F.col("review_text")).alias("text")
    )


def tokenize(spark: SparkSession, sf: str) -> DataFrame:
    words = lx.default_stopwords("examplereviews")
    text = tx.normalize_text(F.col("review_text"))
    return tv.reviews(spark, sf).select("seq", text.alias("t")).select(
        "seq", F.array_join(tx.tokenize("t", words), " ").alias("tokens")
    )


def stopword_set(spark: SparkSession, sf: str) -> DataFrame:
    """How often each stop word occurs in the documents."""
    stop = list(lx.default_stopwords("examplereviews"))
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))
    used = F.filter(words, lambda w: w.isin(stop))
    return (
        tv.table(spark, sf, "documents")
        .select(F.explode(used).alias("word"))
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def issue_labels(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).select("seq", joined("issue_labels"))


def primary_label(spark: SparkSession, sf: str) -> DataFrame:
    return classifier.with_primary_label(labelled(spark, sf)).select("seq", "label")


def root_cause(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).select("seq", "root_cause_suggestion")


def reliability_score(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).select("seq", "rating", "reliability_score")


def dedup_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.dedup_reviews(tv.raw_reviews(spark, sf)).select("seq", "raw_url")


def fill_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return kept(spark, sf).select(
        "seq", "source", "company", "category", "title", "review_date", "comment_count",
        "is_featured_review", F.size("breadcrumbs").alias("n_breadcrumbs"),
        F.size("comments").alias("n_comments"),
    )


def text_select(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).select("seq", "review_text_normalized")


def mention_flags(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(spark, sf).select("seq", "has_return_mention", "has_warranty_mention")


def surrogate_id(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.dedup_and_number(tv.raw_reviews(spark, sf)).select("seq", "record_id")


def missing_counts(spark: SparkSession, sf: str) -> DataFrame:
    return cleaning.missing_counts(kept(spark, sf))


def preprocess_summary(spark: SparkSession, sf: str) -> DataFrame:
    raw = tv.raw_reviews(spark, sf)
    return cleaning.preprocess_summary(raw, kept(spark, sf))


def clean_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return clean(spark, sf).select(
        "seq", "record_id", "source", "company", "category", "title", "review_text",
        "review_text_normalized", "full_text_with_comments", joined("tokens"), "review_date",
        "review_updated_date", "rating", "comment_count", "has_return_mention",
        "has_warranty_mention", joined("issue_labels"), "root_cause_suggestion",
        "reliability_score", "raw_url",
    )


# --- Features ---

def keyword_hits(spark: SparkSession, sf: str) -> DataFrame:
    text = F.lower("review_text")
    return tv.reviews(spark, sf).select(
        "seq", tx.keyword_hits(text, lx.FEATURE_RETURN_KEYWORDS).alias("return_hits"),
        tx.keyword_hits(text, lx.FEATURE_WARRANTY_KEYWORDS).alias("warranty_hits"),
    )


def record_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.record_features(clean(spark, sf)).select(
        "seq", "feature_token_count", "feature_return_hits", "feature_warranty_hits",
        "feature_focus_score",
    )


def fitted(spark: SparkSession, sf: str, fallback: bool = True):
    docs = stage(tfidf.tokenized(tfidf.corpus(clean(spark, sf), fallback)), "tokens")
    return docs, tfidf.fit(docs)


def indexed(spark: SparkSession, sf: str, fallback: bool = False):
    """Clean records and their search index, both written once."""
    records = staged_clean(spark, sf, *SEARCHED, "company", "title", *search_index.FACETS)
    return records, search_index.build(records, scratch_path(spark, "index"), fallback)


def tfidf_weights(spark: SparkSession, sf: str) -> DataFrame:
    weights = tfidf.tfidf_weights(*fitted(spark, sf))
    return weights.select("seq", "term", "tf", F.round("weight", 6).alias("weight"))


def top_corpus_terms(spark: SparkSession, sf: str) -> DataFrame:
    return tfidf.top_corpus_terms(*fitted(spark, sf))


def corpus_stats(spark: SparkSession, sf: str) -> DataFrame:
    return tfidf.corpus_stats(fitted(spark, sf)[1])


def issue_label_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return features.issue_label_distribution(labelled(spark, sf))


def feature_report(spark: SparkSession, sf: str) -> DataFrame:
    report = reports.feature_report(stage(features.record_features(clean(spark, sf)), "featured"))
    counts = F.transform(F.map_entries("issue_label_distribution"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return report.select(
        "feature_extraction_method", "corpus_features.record_count", "corpus_features.vocabulary_size",
        F.array_join("corpus_features.matrix_shape", "x").alias("matrix_shape"),
        F.array_join("corpus_features.top_corpus_terms.term", "|").alias("top_terms"),
        F.round(F.aggregate("corpus_features.top_corpus_terms", F.lit(0.0),
                            lambda n, t: n + t["avg_tfidf_weight"]), 4).alias("top_weight"),
        F.array_join(F.sort_array(counts), "|").alias("issue_label_distribution"), "avg_token_count",
        "records_with_return_signal", "records_with_warranty_signal",
    )


def feature_summary(spark: SparkSession, sf: str) -> DataFrame:
    return features.feature_summary(features.record_features(clean(spark, sf)))


# --- Search ---

def search_topk(spark: SparkSession, sf: str) -> DataFrame:
    found = search.search_topk(staged_clean(spark, sf, *SEARCHED, "company", "title"), QUERY, 5)
    return found.select("rank", "seq", "company", "title", "similarity")


def search_batch(spark: SparkSession, sf: str) -> DataFrame:
    docs, model = fitted(spark, sf)
    asked = [q for q, _ in lx.EVALUATION_QUERIES]
    return search.search_batch(docs, model, asked, 5)


def index_search_topk(spark: SparkSession, sf: str) -> DataFrame:
    records, index = indexed(spark, sf)
    found = search.search_topk(records, QUERY, 5, index=index)
    return found.select("rank", "seq", "company", "title", "similarity")


def index_search_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Four queries by an index."""
    asked = list(enumerate(q for q, _ in lx.EVALUATION_QUERIES))
    queries = spark.createDataFrame(asked, "query_no int, query string")
    return search_index.search(indexed(spark, sf, True)[1], queries, 5)


def search_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table of queries: the beginning of every twentieth review, against all of them."""
    records, index = indexed(spark, sf, True)
    queries = records.where("seq % 20 = 0").select(
        F.col("seq").alias("query_no"), F.substring("review_text", 1, 120).alias("query")
    )
    return search_index.search(index, queries, 10).drop("query")


def filter_mentions(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_mentions(clean(spark, sf), True, True).select("seq")


def filter_warranty(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_mentions(clean(spark, sf), warranty_only=True).select("seq")


def filter_issue(spark: SparkSession, sf: str) -> DataFrame:
    return filters.filter_issue(clean(spark, sf), "billing_issue").select("seq")


def filter_years(spark: SparkSession, sf: str) -> DataFrame:
    # The column is raw, so the filter comes before the text work.
    where = filters.in_years([1996, 1999], True)
    return cleaning.clean_reviews(tv.raw_reviews(spark, sf), where=where).select("seq", "review_date")


def recent_years(spark: SparkSession, sf: str) -> DataFrame:
    return filters.recent_years(kept(spark, sf), MIN_YEAR)


def filtered_search(spark: SparkSession, sf: str) -> DataFrame:
    found = search.filtered_search(
        staged_clean(spark, sf), FILTERED_QUERY, 10, return_only=True
    )
    return found.select("rank", "seq", "company", "similarity")


def index_filtered_search(spark: SparkSession, sf: str) -> DataFrame:
    return _index_filtered(spark, sf, return_only=True)


def index_filtered_search_issue(spark: SparkSession, sf: str) -> DataFrame:
    return _index_filtered(spark, sf, issue="delivery_issue")


def index_filtered_search_years(spark: SparkSession, sf: str) -> DataFrame:
    return _index_filtered(spark, sf, warranty_only=True, years=[1996, 1999], include_unknown=True)


def _index_filtered(spark: SparkSession, sf: str, **conditions) -> DataFrame:
    records, index = indexed(spark, sf)
    found = search.filtered_search(records, FILTERED_QUERY, 10, index, **conditions)
    return found.select("rank", "seq", "company", "similarity")


def dataset_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return filters.dataset_metrics(clean(spark, sf), issue="support_issue")


def result_view(spark: SparkSession, sf: str) -> DataFrame:
    records = classifier.fallback_predict(staged_clean(spark, sf, *SHOWN))
    view = search.result_view(search.search_topk(records, QUERY, 5))
    return view.select(
        "rank", "seq", "title", "text", "suggestion", "issue_labels", "similarity",
        F.array_join(F.transform("comments", lambda c: F.concat_ws(
            "/", c["author_name"], c["posted_at"], c["text"])), "|").alias("comments"),
    )


def result_card(spark: SparkSession, sf: str) -> DataFrame:
    found = search.search_topk(staged_clean(spark, sf, *SHOWN), QUERY, 5)
    return search.result_card(found).select("rank", "seq", "text", "issue_labels", "suggestion")


def dataset_preview(spark: SparkSession, sf: str) -> DataFrame:
    records = filters.filter_mentions(clean(spark, sf), return_only=True)
    return filters.dataset_preview(records, 100).select("seq", "title", "company", "rating")


# --- Classifier ---

def fallback_predict(spark: SparkSession, sf: str) -> DataFrame:
    return classifier.fallback_predict(labelled(spark, sf)).select(
        "seq", "ai_predicted_issue", "ai_confidence", "ai_root_cause_suggestion"
    )


def _counts(records: DataFrame) -> dict[str, int]:
    return {r.label: r.records for r in classifier.class_counts(records).collect()}


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    records = stage(
        classifier.with_primary_label(labelled(spark, sf)).select("seq", "issue_labels", "label"),
        "labels",
    )
    split = classifier.stratified_split(records, _counts(records))
    return split.groupBy("label").agg(
        F.count_if("is_test").alias("test_rows"), F.count_if(~F.col("is_test")).alias("train_rows")
    )


def fit_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy of a model on the rows it was fitted on, per label."""
    records = staged_clean(spark, sf, *CLASSIFIED)
    rows = classifier.with_primary_label(records).select(
        "seq", tfidf.corpus_text().alias("text"), "label"
    )
    model = classifier.fit_classifier(rows, sorted(_counts(records)))
    scored = classifier.predict_all(classifier.with_primary_label(records), model)
    right = (F.col("label") == F.col("ai_predicted_issue")).cast("int")
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("records"), F.round(F.avg(right), 4).alias("accuracy")
    )


def staged_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """(seq, issue_labels, _tokens) of the clean records: the text is cut once and not kept."""
    docs = clean(spark, sf).select("seq", "issue_labels", tfidf.corpus_text().alias("text"))
    return stage(tfidf.tokenized(docs), "tokens")


def score_by_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Per label: records, those that tables and model judge alike, and the mean probability of the label.

    The fit gives every class the same weight and does not penalise intercepts, so at its optimum each
    label's weighted mean probability is one over the number of labels.
    """
    records = staged_tokens(spark, sf)
    tokens = classifier.with_primary_label(records).select("seq", "_tokens", "label")
    counts = _counts(records)
    model = classifier.fit_classifier(tokens, sorted(counts))
    path = classifier.save_model(classifier.model_tables(model), scratch_path(spark, "model"))
    by_tables = classifier.score_by_tables(tokens.drop("label"), classifier.open_model(spark, path)).select(
        "seq", F.col("ai_predicted_issue").alias("_label"), F.col("ai_confidence").alias("_confidence"),
        "probabilities",
    )
    # Rounding to four places may differ in the last one, as sums run in another order.
    alike = (F.col("_label") == F.col("ai_predicted_issue")) & (
        F.abs(F.col("_confidence") - F.col("ai_confidence")) < 0.00011)
    both = classifier.predict(tokens, model).join(by_tables, "seq")
    sizes = F.create_map(*[F.lit(x) for pair in counts.items() for x in pair])
    weight = F.lit(1.0) / (len(counts) * F.element_at(sizes, F.col("label")))
    counted = both.groupBy("label").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(alike).alias("alike"),
        *[F.sum(weight * F.get("probabilities", F.lit(i))).alias(f"_p{i}") for i in range(len(counts))],
    )
    shares = counted.agg(F.array(*[F.sum(f"_p{i}") for i in range(len(counts))])).scalar()
    place = F.array_position(F.array(*[F.lit(c) for c in sorted(counts)]), F.col("label")).cast("int") - 1
    return counted.select(
        "label", "records", "alike", F.round(F.get(shares, place), 3).alias("mean_probability")
    )


def predict_all(spark: SparkSession, sf: str) -> DataFrame:
    predicted, _ = classifier.train_and_predict(staged_tokens(spark, sf))
    return predicted.select(
        "seq", "ai_predicted_issue", "ai_confidence", "ai_root_cause_suggestion"
    )


def holdout_metrics(spark: SparkSession, sf: str) -> DataFrame:
    _, metrics = classifier.train_and_predict(staged_tokens(spark, sf))
    return metrics.withColumn("labels", F.array_join("labels", "|"))


def label_suggestion(spark: SparkSession, sf: str) -> DataFrame:
    records = classifier.with_primary_label(labelled(spark, sf))
    return records.select("seq", lb.label_suggestion(F.col("label")).alias("suggestion"))


# --- Sentiment, summary, relevance ---

def split_sentences(spark: SparkSession, sf: str) -> DataFrame:
    sentences = tx.split_sentences(F.col("review_text"))
    return tv.reviews(spark, sf).select("seq", F.posexplode(sentences).alias("pos", "sentence"))


def sentiment(spark: SparkSession, sf: str) -> DataFrame:
    return enrichment.add_sentiment(clean(spark, sf)).select(
        "seq", "ai_sentiment", "ai_sentiment_score"
    )


def summary(spark: SparkSession, sf: str) -> DataFrame:
    return enrichment.add_summary(clean(spark, sf)).select("seq", "ai_summary")


def domain_relevance(spark: SparkSession, sf: str) -> DataFrame:
    records = classifier.fallback_predict(labelled(spark, sf))
    return enrichment.add_relevance(records).select("seq", "ai_domain_relevance")


def enrich(spark: SparkSession, sf: str) -> DataFrame:
    return enriched(spark, sf).select(
        "seq", "ai_predicted_issue", "ai_sentiment", "ai_sentiment_score", "ai_summary",
        "ai_domain_relevance",
    )


def sentiment_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return enrichment.sentiment_distribution(enrichment.add_sentiment(clean(spark, sf)))


# --- Evaluation ---

def retrieval_hits(spark: SparkSession, sf: str) -> DataFrame:
    hits = evaluation.retrieval_hits(staged_clean(spark, sf, *SEARCHED, "company"))
    return hits.withColumn("matched_terms", F.array_join("matched_terms", "|"))


def retrieval_hit_rate(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.retrieval_hit_rate(evaluation.retrieval_hits(staged_clean(spark, sf, *SEARCHED, "company")))


def classification_eval(spark: SparkSession, sf: str) -> DataFrame:
    """The label the root-cause rule would pick, judged against the first label."""
    records = labelled(spark, sf)
    picked = [F.when(F.array_contains("issue_labels", name), name) for name in lx.ROOT_CAUSES]
    return evaluation.classification_eval(
        records.withColumn("ai_predicted_issue", F.coalesce(*picked, F.lit("other")))
    )


def ai_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return evaluation.ai_coverage(enriched(spark, sf))


def evaluation_report(spark: SparkSession, sf: str) -> DataFrame:
    records = enrichment.enrich(classifier.fallback_predict(
        staged_clean(spark, sf, *CLASSIFIED, "company", "full_text_with_comments")))
    return evaluation.evaluation_report(records).select(
        "retrieval.queries_evaluated", "retrieval.avg_keyword_hit_rate", F.col("classification.status").alias("status"),
        F.col("classification.accuracy").alias("accuracy"),
        F.col("classification.macro_f1").alias("macro_f1"), "ai_coverage.*",
    )


def evaluation_query_results(spark: SparkSession, sf: str) -> DataFrame:
    """The report's query results, one row per result."""
    hits = stage(evaluation.retrieval_hits(staged_clean(spark, sf, *SEARCHED, "company")), "hits")
    per_query = evaluation.query_results(hits).select(F.inline("query_results"))
    return per_query.select(
        "query", "top_k", "keyword_hit_rate", F.posexplode("top_results").alias("pos", "r")
    ).select(
        "query", "top_k", "keyword_hit_rate", "pos", "r.company", "r.similarity",
        F.array_join("r.matched_terms", "|").alias("matched_terms"),
    )


# --- Summaries ---

def complete_schema(spark: SparkSession, sf: str) -> DataFrame:
    bare = tv.reviews(spark, sf).select("seq", "company", "rating")
    full = insights.complete_schema(bare)
    return full.select(
        "seq", "company", "rating", "reliability_score", F.size("tokens").alias("n_tokens"),
        F.size("issue_labels").alias("n_labels"), "has_return_mention", "has_warranty_mention",
        "review_date",
    )


def eda_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary_row = insights.eda_summary(clean(spark, sf))
    return summary_row.withColumns({
        "avg_rating": F.round("avg_rating", 6),
        "avg_reliability_score": F.round("avg_reliability_score", 6),
    })


def top_issues(spark: SparkSession, sf: str) -> DataFrame:
    return insights.top_issues(labelled(spark, sf))


def top_keywords(spark: SparkSession, sf: str) -> DataFrame:
    return insights.top_keywords(labelled(spark, sf))


def sentiment_counts(spark: SparkSession, sf: str) -> DataFrame:
    return insights.sentiment_counts(enrichment.add_sentiment(clean(spark, sf)))


def insight_rates(spark: SparkSession, sf: str) -> DataFrame:
    return insights.insight_rates(enrichment.add_sentiment(clean(spark, sf)))


def key_findings(spark: SparkSession, sf: str) -> DataFrame:
    records = stage(enrichment.add_sentiment(clean(spark, sf)), "scored")
    return insights.key_findings(records)


def all_insights(spark: SparkSession, sf: str) -> DataFrame:
    records = stage(enrichment.add_sentiment(clean(spark, sf)), "scored")

    def flat(name: str):
        pairs = F.transform(name, lambda e: F.concat_ws("=", e["value"], e["count"]))
        return F.array_join(pairs, "|").alias(name)

    return insights.insights(records).select(
        "total_records", "return_mention_rate", "warranty_mention_rate",
        "negative_sentiment_rate", flat("top_issue_categories"), flat("top_companies"),
        F.array_join("key_findings", "|").alias("key_findings"),
    )


def queries() -> dict[str, Query]:
    own = [
        read_records, read_robots, write_records, write_summaries,
        page_candidates, page_breadcrumbs, page_labeled_field, page_reviewer, page_comments,
        page_comments_dedup, page_relevance, review_records, page_details, collapse_ws,
        page_links, absolute_url, item_url_filter, normalize_url, subcategory_url_filter,
        next_page_link, subcategory_links, hub_links, listing_links, robots_filter, robots_by_host, crawl_outcomes,
        crawl_outcomes_by_host, crawl_extract, crawl_log,
        recency_filter, extract_year, accept_limit, discovery_source, crawl_status_counts,
        crawl_summary,
        normalize_text, tokenize, stopword_set, issue_labels, primary_label, root_cause,
        reliability_score, dedup_reviews, fill_defaults, text_select, mention_flags, surrogate_id,
        missing_counts, preprocess_summary, clean_reviews,
        keyword_hits, record_features, tfidf_weights, top_corpus_terms, corpus_stats,
        issue_label_distribution, feature_summary, feature_report,
        search_topk, search_batch, index_search_topk, index_search_batch, search_table,
        filter_mentions, filter_warranty, filter_issue, filter_years, recent_years,
        filtered_search, index_filtered_search, index_filtered_search_issue, index_filtered_search_years,
        dataset_metrics, result_view, result_card, dataset_preview,
        fallback_predict, stratified_split, fit_classifier, score_by_tables, predict_all, holdout_metrics,
        label_suggestion,
        split_sentences, sentiment, summary, domain_relevance, enrich, sentiment_distribution,
        retrieval_hits, retrieval_hit_rate, classification_eval, ai_coverage, evaluation_report,
        evaluation_query_results,
        complete_schema, eda_summary, top_issues, top_keywords, sentiment_counts, insight_rates,
        key_findings,
    ]
    registered: dict[str, Query] = {fn.__name__: fn for fn in own}
    fields = {
        "page_company": (pages.company, "company"),
        "page_review_date": (pages.review_date, "review_date"),
        "page_category": (lambda: pages.category(pages.breadcrumbs()), "category"),
        "page_comment_count": (pages.comment_count, "comment_count"),
        "page_helpful_count": (lambda: pages.helpful_count(F.col("_box")), "helpful_count"),
        "page_updated_date": (pages.updated_date, "review_updated_date"),
        "page_featured": (
            lambda: F.contains(F.lower("_page"), F.lit("featured review")), "is_featured_review"
        ),
        "page_rating": (pages.rating, "rating"),
        "page_record_id": (lambda: F.md5("url"), "record_id"),
    }
    for name, (column, out) in fields.items():
        registered[name] = partial(page_field, column, out)
    return registered | {
        "read_pages": lambda s, d: all_pages(s, d).select(
            "page_id", "url", F.length("html").alias("n_chars")),
        "page_full_text": lambda s, d: extracted(s, d).select("seq", "full_text_with_comments"),
        "crawl_frontier": frontier,
        "available_years": lambda s, d: filters.available_years(kept(s, d)),
        "issue_values": lambda s, d: filters.issue_values(labelled(s, d)),
        "class_counts": lambda s, d: classifier.class_counts(labelled(s, d)),
        "model_gate": lambda s, d: classifier.model_gate(labelled(s, d)),
        "mention_counts": lambda s, d: insights.mention_counts(labelled(s, d)),
        "top_companies": lambda s, d: insights.top_companies(kept(s, d)),
        "insights": all_insights,
    }
