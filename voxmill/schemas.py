"""Record schemas. ``seq`` is the input order; it is a column, never the order of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, B, D = T.StringType(), T.IntegerType(), T.BooleanType(), T.DoubleType()
STRINGS = T.ArrayType(S)


def struct(**fields: T.DataType) -> T.StructType:
    """A struct type from names and types; needs no running session."""
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


COMMENT_TYPE = struct(
    comment_id=S, author_name=S, author_location=S, posted_at=S, text=S, helpful_count=I,
    is_company_response=B,
)
COMMENTS = T.ArrayType(COMMENT_TYPE)

RAW_REVIEW = struct(
    record_id=S, source=S, company=S, category=S, breadcrumbs=STRINGS, title=S, review_text=S,
    review_date=S, review_updated_date=S, reviewer_name=S, reviewer_location=S, rating=D,
    comment_count=I, helpful_count=I, claimed_loss=S, desired_outcome=S, is_featured_review=B,
    comments=COMMENTS, full_text_with_comments=S, has_return_mention=B, has_warranty_mention=B,
    is_warranty_return_relevant=B, relevance_score=I, raw_url=S, discovery_source=S,
    scraped_at=S,
)

CLEAN_REVIEW = struct(
    record_id=S, source=S, company=S, category=S, breadcrumbs=STRINGS, title=S, review_text=S,
    review_text_normalized=S, full_text_with_comments=S, tokens=STRINGS, review_date=S,
    review_updated_date=S, reviewer_name=S, reviewer_location=S, rating=D, comment_count=I,
    helpful_count=I, claimed_loss=S, desired_outcome=S, is_featured_review=B, comments=COMMENTS,
    has_return_mention=B, has_warranty_mention=B, issue_labels=STRINGS, root_cause_suggestion=S,
    reliability_score=D, discovery_source=S, raw_url=S,
)

FEATURES = struct(
    feature_token_count=I, feature_return_hits=I, feature_warranty_hits=I, feature_focus_score=I
)

ENRICHMENT = struct(
    ai_predicted_issue=S, ai_confidence=D, ai_root_cause_suggestion=S, ai_sentiment=S,
    ai_sentiment_score=D, ai_summary=S, ai_domain_relevance=S,
)

PAGE = struct(page_id=T.LongType(), url=S, html=S)


def complete(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the schema's missing columns as typed nulls."""
    missing = {
        f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns
    }
    return df.withColumns(missing) if missing else df
