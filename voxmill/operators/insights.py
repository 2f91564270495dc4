"""Summaries for reports and charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns a summary may find missing, with their types and the values they stand for.
SUMMARY_DEFAULTS = {
    "rating": ("double", None),
    "reliability_score": ("double", 0.0),
    "issue_labels": ("array<string>", []),
    "tokens": ("array<string>", []),
    "has_return_mention": ("boolean", False),
    "has_warranty_mention": ("boolean", False),
    "review_date": ("string", None),
}


def complete_schema(records: DataFrame) -> DataFrame:
    def default(kind, value) -> Column:
        return (F.array() if value == [] else F.lit(value)).cast(kind)

    missing = {n: default(*d) for n, d in SUMMARY_DEFAULTS.items() if n not in records.columns}
    return records.withColumns(missing) if missing else records


def eda_summary(records: DataFrame) -> DataFrame:
    """One row; averages skip missing values."""
    return complete_schema(records).agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if("has_return_mention").alias("records_with_return_mentions"),
        F.count_if("has_warranty_mention").alias("records_with_warranty_mentions"),
        F.avg("rating").alias("avg_rating"),
        F.avg("reliability_score").alias("avg_reliability_score"),
        F.count_distinct("company").alias("company_count"),
    )


def _ranked_values(records: DataFrame, array: str, n: int) -> DataFrame:
    """(value, count, first, place): the most frequent array elements, with where each was first seen.

    Each row emits its elements to count and, once per distinct element, where it was first seen,
    so that one hash aggregation with a small state does it all.
    """
    counted = F.transform(
        array,
        lambda x: F.struct(
            x.alias("value"), F.lit(1).alias("n"),
            F.lit(None).cast("long").alias("first"), F.lit(None).cast("int").alias("place"),
        ),
    )
    seen = F.transform(
        F.array_distinct(array),
        lambda x, i: F.struct(
            x.alias("value"), F.lit(0).alias("n"),
            F.col("seq").cast("long").alias("first"), i.alias("place"),
        ),
    )
    return (
        records.where(F.col(array).isNotNull())
        .select(F.inline(F.concat(counted, seen)))
        .groupBy("value")
        .agg(
            F.sum("n").alias("count"),
            F.min("first").alias("first"),
            F.min_by("place", "first").alias("place"),
        )
        .orderBy(F.desc("count"), "first", "place")
        .limit(n)
    )


def top_values(records: DataFrame, array: str, n: int, name: str) -> DataFrame:
    """The most frequent array elements; ties go to the one seen first."""
    return _ranked_values(records, array, n).select(F.col("value").alias(name), "count")


def top_issues(records: DataFrame, n: int = 10) -> DataFrame:
    return top_values(complete_schema(records), "issue_labels", n, "issue")


def top_keywords(records: DataFrame, n: int = 20) -> DataFrame:
    return top_values(complete_schema(records), "tokens", n, "keyword")


def mention_counts(records: DataFrame) -> DataFrame:
    """Two rows: return_mention and warranty_mention."""
    counts = complete_schema(records).agg(
        F.count_if("has_return_mention").alias("return_mention"),
        F.count_if("has_warranty_mention").alias("warranty_mention"),
    )
    return counts.unpivot([], ["return_mention", "warranty_mention"], "type", "count")


def _ranked_companies(records: DataFrame, n: int) -> DataFrame:
    return (
        records.groupBy(F.coalesce("company", F.lit("unknown")).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"), F.min("seq").alias("first"))
        .orderBy(F.desc("count"), "first")
        .limit(n)
    )


def top_companies(records: DataFrame, n: int = 8) -> DataFrame:
    return _ranked_companies(records, n).select(F.col("value").alias("company"), "count")


def sentiment_counts(records: DataFrame) -> DataFrame:
    """Counts per sentiment that occurs; missing ones count as unknown."""
    sentiment = F.coalesce("ai_sentiment", F.lit("unknown")).alias("sentiment")
    return records.groupBy(sentiment).agg(F.count(F.lit(1)).alias("count"))


def insight_rates(records: DataFrame) -> DataFrame:
    n = F.greatest(F.count(F.lit(1)), F.lit(1))
    returns, warranties = F.count_if("has_return_mention"), F.count_if("has_warranty_mention")
    negatives = F.count_if(F.col("ai_sentiment") == "negative")
    return records.agg(
        F.count(F.lit(1)).alias("total_records"),
        returns.alias("return_mentions"),
        warranties.alias("warranty_mentions"),
        negatives.alias("negative_records"),
        F.round(returns / n, 4).alias("return_mention_rate"),
        F.round(warranties / n, 4).alias("warranty_mention_rate"),
        F.round(negatives / n, 4).alias("negative_sentiment_rate"),
    )


def _packed(ranked: DataFrame, *ties: str) -> Column:
    """A list of a few rows as one array of (value, count), most frequent first."""
    entry = F.struct((-F.col("count")).alias("rank"), *ties, "value", "count")
    ordered = F.array_sort(F.collect_list(entry))
    plain = F.transform(ordered, lambda e: F.struct(e["value"], e["count"]))
    return ranked.agg(plain).scalar()


def insights(records: DataFrame) -> DataFrame:
    """One row: counts, rates, top lists and up to five findings in words."""
    issues = _ranked_values(complete_schema(records), "issue_labels", 8)
    sentiments = sentiment_counts(records).withColumnRenamed("sentiment", "value")
    return insight_rates(records).select(
        "*",
        _packed(issues, "first", "place").alias("top_issue_categories"),
        _packed(_ranked_companies(records, 8), "first").alias("top_companies"),
        _packed(sentiments).alias("sentiment_distribution"),
    ).withColumn("key_findings", _findings())


def _percent(rate: Column) -> Column:
    return F.concat(F.bround(rate * 100, 0).cast("int").cast("string"), F.lit("%"))


def _findings() -> Column:
    issue = F.get("top_issue_categories", F.lit(0))
    company = F.get("top_companies", F.lit(0))
    return F.array_compact(F.array(
        F.when(issue.isNotNull(), F.format_string(
            "The most common issue category is '%s' (%d labeled mentions).",
            issue["value"], issue["count"])),
        F.format_string("%d complaints mention return/refund language (%s of records).",
                        F.col("return_mentions"), _percent(F.col("return_mention_rate"))),
        F.format_string("%d complaints mention warranty/claim language (%s of records).",
                        F.col("warranty_mentions"), _percent(F.col("warranty_mention_rate"))),
        F.format_string("%d records are classified with negative sentiment (%s).",
                        F.col("negative_records"), _percent(F.col("negative_sentiment_rate"))),
        F.when(company.isNotNull(), F.format_string(
            "Most frequent company in dataset: %s (%d records).",
            company["value"], company["count"])),
    ))


def key_findings(records: DataFrame) -> DataFrame:
    """(place, finding), in order."""
    return insights(records).select(F.posexplode("key_findings").alias("place", "finding"))
