"""From raw review records to clean, labelled ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill import lexicons as lx
from voxmill import schemas
from voxmill.config import DEFAULT_SITE, Site
from voxmill.functions import labels as lb
from voxmill.functions import text as tx
from voxmill.functions.once import once
from voxmill.operators.numbering import positions
from voxmill.sources.staging import broadcast_if_small, stage


def copy_keys(records: DataFrame, *more: Column) -> DataFrame:
    """(seq, _url, _digest, ...): records that agree on url and digest are copies."""
    return records.select(
        "seq", F.coalesce("raw_url", F.lit("")).alias("_url"),
        F.md5(tx.normalize_text(F.col("review_text"))).alias("_digest"), *more,
    )


def first_of_each(keys: DataFrame) -> DataFrame:
    """(seq) of the first record of each (url, normalised review text), from ``copy_keys``.

    Only urls, digests and numbers are shuffled, and each task sends one row per key, so a group of
    copies that makes up much of the table meets as a handful of rows.
    """
    return keys.groupBy("_url", "_digest").agg(F.min("seq").alias("seq")).select("seq")


def dedup_reviews(records: DataFrame) -> DataFrame:
    """Keep the first record, by ``seq``, of each (url, normalised review text)."""
    return records.join(first_of_each(copy_keys(records)), "seq", "left_semi")


def dedup_and_number(records: DataFrame) -> DataFrame:
    """``dedup_reviews``, with ``record_<position>`` for the rows that have no id.

    ``seq`` is unique and never null. An action: keys, kept and dropped numbers are narrow stage
    tables. While the copies, and the rows without an id, are few, they are broadcast and the
    records themselves are not shuffled; beyond that they are joined by ``seq``.
    """
    own_id = tx.non_empty(F.col("record_id"))
    keys = stage(copy_keys(records, own_id.isNull().alias("_bare")), "keys")
    kept = stage(first_of_each(keys), "kept")
    dropped = stage(keys.select("seq").join(kept, "seq", "left_anti"), "dropped")
    bare = keys.where("_bare").select("seq")
    numbers = stage(positions(kept, "seq", "_position").join(bare, "seq", "left_semi"), "numbers")
    made = F.concat(F.lit("record_"), F.col("_position"))
    return (
        records.join(broadcast_if_small(dropped), "seq", "left_anti")
        .join(broadcast_if_small(numbers), "seq", "left")
        .withColumn("record_id", F.coalesce(own_id, made))
        .drop("_position")
    )


def fill_defaults(records: DataFrame, site: Site = DEFAULT_SITE) -> DataFrame:
    def either(name: str, default: str):
        return F.coalesce(F.col(name), F.lit(default))

    def filled(name: str, default: str):
        return F.coalesce(tx.non_empty(F.col(name)), F.lit(default))

    # A rating that arrives as text may be blank; anything that is no number counts as missing.
    return records.withColumns({
        "source": either("source", site.name),
        "company": filled("company", "unknown"),
        "category": either("category", site.default_category),
        "title": either("title", "unknown"),
        "review_text": either("review_text", ""),
        "full_text_with_comments": F.coalesce("full_text_with_comments", "review_text", F.lit("")),
        "review_date": filled("review_date", "unknown"),
        "rating": F.col("rating").try_cast("double"),
        "comment_count": F.coalesce("comment_count", F.lit(0)),
        "is_featured_review": F.coalesce("is_featured_review", F.lit(False)),
        "breadcrumbs": F.coalesce("breadcrumbs", F.array().cast("array<string>")),
        "comments": F.coalesce("comments", F.array().cast(schemas.COMMENTS)),
        "raw_url": either("raw_url", ""),
    })


def add_clean_text(
    records: DataFrame, stopwords: Sequence[str] | None = None, site: Site = DEFAULT_SITE
) -> DataFrame:
    """Add ``_text`` (normalised full text), ``tokens`` and ``review_text_normalized``."""
    words = lx.default_stopwords(site.name) if stopwords is None else stopwords
    source = F.coalesce(tx.non_empty(F.col("full_text_with_comments")), F.col("review_text"))
    return (
        records.withColumn("_text", once(tx.normalize_text(source)))
        .withColumn("tokens", once(tx.tokenize_normalized("_text", words)))
        .withColumn(
            "review_text_normalized",
            once(F.when(F.size("tokens") > 0, F.array_join("tokens", " "))
                 .otherwise(F.col("_text"))),
        )
    )


def add_labels(records: DataFrame) -> DataFrame:
    """Labels from ``_text``; mention flags from the stop-word filtered text."""
    kept = F.col("review_text_normalized")
    return (
        records.withColumn("issue_labels", once(lb.issue_labels(F.col("_text"))))
        .withColumns({
            "has_return_mention": tx.contains_any(kept, lx.CLEAN_RETURN_KEYWORDS),
            "has_warranty_mention": tx.contains_any(kept, lx.CLEAN_WARRANTY_KEYWORDS),
            "root_cause_suggestion": lb.root_cause(F.col("issue_labels")),
            "reliability_score": lb.reliability_score(F.col("rating"), F.col("issue_labels")),
        })
    )


def clean_reviews(
    records: DataFrame, stopwords: Sequence[str] | None = None, site: Site = DEFAULT_SITE,
    where: Column | None = None,
) -> DataFrame:
    """Deduplicate, fill, normalise and label: ``seq`` plus the 28 clean fields.

    ``where``, a condition on filled raw fields such as ``filters.in_years(...)``, keeps other
    records out of the text work. A filter on the result gives the same rows but runs after it.
    """
    kept = fill_defaults(dedup_and_number(schemas.complete(records, schemas.RAW_REVIEW)), site)
    kept = kept if where is None else kept.where(where)
    cleaned = add_labels(add_clean_text(kept, stopwords, site))
    return cleaned.select("seq", *schemas.CLEAN_REVIEW.fieldNames())


def missing_counts(clean: DataFrame) -> DataFrame:
    """Rows (field, missing) for the fields with unknown values; fields without any are left out."""
    counts = clean.agg(
        F.count_if(F.col("company") == "unknown").alias("company"),
        F.count_if(F.col("review_date") == "unknown").alias("review_date"),
        F.count_if(F.col("rating").isNull()).alias("rating"),
    )
    return counts.unpivot(
        [], ["company", "review_date", "rating"], "field", "missing"
    ).where("missing > 0")


def preprocess_summary(records: DataFrame, clean: DataFrame) -> DataFrame:
    """One row: records in, out and removed, and the missing counts."""
    n_in = records.agg(F.count(F.lit(1))).scalar()
    out = clean.agg(
        F.count(F.lit(1)).alias("total_output_records"),
        F.count_if(F.col("company") == "unknown").alias("missing_company"),
        F.count_if(F.col("review_date") == "unknown").alias("missing_review_date"),
        F.count_if(F.col("rating").isNull()).alias("missing_rating"),
    )
    return out.withColumn("total_input_records", n_in).withColumn(
        "duplicates_removed", F.col("total_input_records") - F.col("total_output_records")
    )
