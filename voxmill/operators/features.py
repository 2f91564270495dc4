"""Per-record features and corpus statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill import lexicons as lx
from voxmill import schemas
from voxmill.functions import text as tx


def corpus_text():
    """The normalised text, or the review text where that is empty."""
    return F.coalesce(
        tx.non_empty(F.col("review_text_normalized")), F.col("review_text"), F.lit("")
    )


def record_features(clean: DataFrame) -> DataFrame:
    text = corpus_text()
    lowered = F.lower(text)
    return clean.withColumns({
        "feature_token_count": F.when(F.size("tokens") > 0, F.size("tokens"))
        .otherwise(tx.word_count(text)),
        "feature_return_hits": tx.keyword_hits(lowered, lx.FEATURE_RETURN_KEYWORDS),
        "feature_warranty_hits": tx.keyword_hits(lowered, lx.FEATURE_WARRANTY_KEYWORDS),
    }).withColumn(
        "feature_focus_score", F.col("feature_return_hits") + F.col("feature_warranty_hits")
    )


def issue_label_distribution(clean: DataFrame) -> DataFrame:
    return (
        clean.select(F.explode("issue_labels").alias("label"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def feature_summary(featured: DataFrame) -> DataFrame:
    featured = schemas.complete(featured, schemas.FEATURES)
    return featured.agg(
        F.round(F.coalesce(F.avg("feature_token_count"), F.lit(0.0)), 2).alias("avg_token_count"),
        F.count_if(F.col("feature_return_hits") > 0).alias("records_with_return_signal"),
        F.count_if(F.col("feature_warranty_hits") > 0).alias("records_with_warranty_signal"),
    )
