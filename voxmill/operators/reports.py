"""Whole report payloads: one row each, with nested parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.operators import features, tfidf
from voxmill.sources.staging import stage

METHOD = "tfidf + keyword frequency + token statistics"


def feature_report(featured: DataFrame, top_k: int = 25, model: tfidf.TfidfModel | None = None) -> DataFrame:
    """``feature_summary`` with the struct ``corpus_features`` and the map ``issue_label_distribution``.

    Read ``featured`` from a stage table. The text is cut into tokens once, for the fit and the top terms,
    which are in order of their weight, equal ones in reverse order of the term. An empty corpus has no
    terms and an empty map.
    """
    docs = stage(tfidf.tokenized(tfidf.corpus(featured)), "tokens")
    model = model or tfidf.fit(docs)
    # At most top_k rows here, and one row per label below.
    best = F.sort_array(F.collect_list(F.struct("avg_tfidf_weight", "term")), asc=False)
    terms = tfidf.top_corpus_terms(docs, model, top_k).agg(
        F.transform(best, lambda t: F.struct(t["term"].alias("term"), t["avg_tfidf_weight"].alias("avg_tfidf_weight")))
    ).scalar()
    labels = features.issue_label_distribution(featured).agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "records"))))
    ).scalar()
    corpus = tfidf.corpus_stats(model).select(F.struct(
        "record_count", "vocabulary_size", F.array("matrix_rows", "matrix_columns").alias("matrix_shape"),
    )).scalar()
    parts = features.feature_summary(featured).withColumns({
        "_corpus": corpus, "_terms": terms, "issue_label_distribution": labels,
    })
    return parts.select(
        F.lit(METHOD).alias("feature_extraction_method"),
        F.struct("_corpus.*", F.col("_terms").alias("top_corpus_terms")).alias("corpus_features"),
        "issue_label_distribution", "avg_token_count", "records_with_return_signal",
        "records_with_warranty_signal",
    )
