"""Sentiment, summary and relevance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.functions import labels as lb
from voxmill.functions import text as tx
from voxmill.functions.once import once


def _opinion_text():
    """The raw review text, or the full text where that is empty."""
    return F.coalesce(
        tx.non_empty(F.col("review_text")), F.col("full_text_with_comments"), F.lit("")
    )


def add_sentiment(records: DataFrame) -> DataFrame:
    """The label uses the unrounded balance; the stored score has four digits."""
    return (
        records.withColumn("_opinion", once(F.lower(_opinion_text())))
        .withColumn("_balance", once(lb.sentiment_balance(F.col("_opinion"))))
        .withColumns({
            "ai_sentiment": lb.sentiment_label(F.col("_balance")),
            "ai_sentiment_score": F.round("_balance", 4),
        })
        .drop("_opinion", "_balance")
    )


def add_summary(records: DataFrame, max_sentences: int = 2) -> DataFrame:
    return (
        records.withColumn("_opinion", _opinion_text())
        .withColumn("_sentences", once(tx.split_sentences(F.col("_opinion"))))
        .withColumn(
            "ai_summary",
            lb.summarize(F.col("_opinion"), F.col("_sentences"), max_sentences=max_sentences),
        )
        .drop("_opinion", "_sentences")
    )


def add_relevance(records: DataFrame) -> DataFrame:
    issue = F.coalesce("ai_predicted_issue", F.lit("other"))
    return records.withColumn("ai_domain_relevance", lb.relevance_note(issue))


def enrich(predicted: DataFrame) -> DataFrame:
    """Sentiment, summary and relevance note for records that carry a predicted issue."""
    return add_relevance(add_summary(add_sentiment(predicted)))


def sentiment_distribution(enriched: DataFrame) -> DataFrame:
    """One row per sentiment, zero included. One pass, no join."""
    names = ["negative", "neutral", "positive"]
    counts = enriched.agg(*[F.count_if(F.col("ai_sentiment") == n).alias(n) for n in names])
    return counts.unpivot([], names, "sentiment", "records")
