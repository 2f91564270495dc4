"""Report payloads with all their parts, and the two forms of a result."""

import pytest

from voxmill import lexicons as lx
from voxmill import schemas
from voxmill.operators import classifier, enrichment, evaluation, features, reports, search
from voxmill.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def clean(spark):
    return catalog.staged_clean(spark, SF)


def test_feature_report(spark, clean):
    row = reports.feature_report(features.record_features(clean), top_k=3).first()
    assert row.corpus_features.record_count == clean.count()
    assert row.corpus_features.matrix_shape == [clean.count(), row.corpus_features.vocabulary_size]
    weights = [t.avg_tfidf_weight for t in row.corpus_features.top_corpus_terms]
    assert len(weights) == 3 and weights == sorted(weights, reverse=True)
    counted = {r.label: r.records for r in features.issue_label_distribution(clean).collect()}
    assert row.issue_label_distribution == counted and len(counted) > 2


def test_feature_report_of_nothing(spark, clean):
    row = reports.feature_report(features.record_features(clean.limit(0))).first()
    assert row.corpus_features.record_count == 0 and row.corpus_features.top_corpus_terms == []
    assert row.issue_label_distribution == {} and row.avg_token_count == 0


def test_evaluation_report_names_results(spark, clean):
    records = enrichment.enrich(classifier.fallback_predict(clean))
    row = evaluation.evaluation_report(records).first().retrieval
    assert [q.query for q in row.query_results] == [q for q, _ in lx.EVALUATION_QUERIES]
    for found, (_, expected) in zip(row.query_results, lx.EVALUATION_QUERIES):
        assert len(found.top_results) == found.top_k == 5
        similarities = [r.similarity for r in found.top_results]
        assert similarities == sorted(similarities, reverse=True)
        assert all(set(r.matched_terms) <= set(expected) for r in found.top_results)
        hits = sum(bool(r.matched_terms) for r in found.top_results)
        assert found.keyword_hit_rate == pytest.approx(hits / 5)


def test_result_forms(spark):
    rows = [(1, 1, 0.5, "x" * 900, [], None), (2, 2, 0.4, None, ["a", "b"], "call")]
    frame = spark.createDataFrame(
        rows, "seq long, rank int, similarity double, review_text string, issue_labels array<string>, "
        "root_cause_suggestion string")
    frame = schemas.complete(frame, schemas.CLEAN_REVIEW)
    short = {r.seq: r for r in search.result_view(frame).collect()}
    long = {r.seq: r for r in search.result_card(frame).collect()}
    assert (len(short[1].text), short[2].text) == (700, "")
    assert long[1].text == "x" * 800 + "..." and long[2].text == "..."
    assert (long[1].issue_labels, long[2].issue_labels) == ("N/A", "a, b")
    assert (long[1].suggestion, long[2].suggestion) == ("N/A", "call")
