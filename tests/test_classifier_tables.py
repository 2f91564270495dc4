"""The classifier as tables: the same predictions by join and sum, in Spark and in SQL, and a converged fit."""

import re

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array

from voxmill.operators import classifier, tfidf

WORDS = {
    "billing": ["invoice", "charged", "fee"], "delivery": ["parcel", "late", "courier"],
    "support": ["rude", "agent", "silence"],
}
COMMON = ["shop", "order", "again", "month", "unit"]


def labelled(spark, labels, n=60):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(n):
        label = labels[i % len(labels)] if i % 5 else labels[0]
        own = rng.choice(WORDS[label], 2)
        rows.append((i, " ".join([*own, *rng.choice(COMMON, 4), own[0]]), label))
    return spark.createDataFrame(rows, "seq long, text string, label string")


def fitted(spark, labels):
    train = labelled(spark, labels)
    return train, classifier.fit_classifier(train, labels)


@pytest.mark.parametrize("labels", [["billing", "delivery", "support"], ["billing", "support"]])
def test_tables_score_like_the_model(spark, tmp_path, labels):
    train, model = fitted(spark, labels)
    odd = spark.createDataFrame(
        [(900, ""), (901, None), (902, "zebra quartz"), (903, "invoice " * 500)], "seq long, text string"
    )
    docs = train.select("seq", "text").unionByName(odd)
    path = classifier.save_model(classifier.model_tables(model), str(tmp_path / "model"))
    got = classifier.score_by_tables(docs, classifier.open_model(spark, path)).collect()
    want = {r.seq: r for r in classifier.predict(docs, model).collect()}
    assert sorted(r.seq for r in got) == sorted(want) and len(got) == len(train.collect()) + 4
    for r in got:
        assert r.ai_predicted_issue == want[r.seq].ai_predicted_issue
        assert r.ai_confidence == pytest.approx(want[r.seq].ai_confidence, abs=2e-4)
        assert sum(r.probabilities) == pytest.approx(1)
    # All three texts without a known word get what the intercepts say.
    assert len({tuple(r.probabilities) for r in got if r.seq in (900, 901, 902)}) == 1


def test_tables_in_sql(spark, tmp_path):
    train, model = fitted(spark, ["billing", "delivery", "support"])
    path = classifier.save_model(classifier.model_tables(model), str(tmp_path / "model"))
    tokens = str(tmp_path / "terms")
    tfidf.with_terms(train, model.features.stopwords).write.parquet(tokens)
    rows = duckdb.sql(f"""
      WITH cells AS (
        SELECT seq, t.coefficients, count(*) * t.idf AS x
        FROM (SELECT seq, unnest(_terms) AS term FROM '{tokens}/*.parquet') d
        JOIN '{path}/terms/*.parquet' t USING (term) GROUP BY seq, term, t.coefficients, t.idf),
      norms AS (SELECT seq, sqrt(sum(x * x)) AS norm FROM cells GROUP BY seq),
      margins AS (
        SELECT c.seq, l.label, l.intercept + sum(c.x * c.coefficients[l.position + 1]) / any_value(n.norm) AS m
        FROM cells c JOIN norms n USING (seq), '{path}/labels/*.parquet' l GROUP BY c.seq, l.label, l.intercept)
      SELECT seq, max_by(label, m), max(exp(m)) / sum(exp(m)) FROM margins GROUP BY seq""").fetchall()
    got = {r.seq: r for r in classifier.predict(train, model).collect()}
    assert len(rows) == len(got)
    for seq, label, share in rows:
        assert got[seq].ai_predicted_issue == label
        assert got[seq].ai_confidence == pytest.approx(share, abs=1e-4)


def test_gradient_is_zero_at_the_fit(spark):
    """Loss: mean over rows of weight * log loss, plus half the squared coefficients over c * rows."""
    labels = ["billing", "delivery", "support"]
    train, model = fitted(spark, labels)
    rows = tfidf.weigh(train, model.features).select("label", vector_to_array("_weights").alias("x")).collect()
    x = np.array([r.x for r in rows])
    y = np.array([[r.label == c for c in labels] for r in rows], dtype=float)
    beta, intercept = model.regression.coefficientMatrix.toArray(), np.array(list(model.regression.interceptVector))
    weight = (y @ (len(rows) / (len(labels) * y.sum(0))))[:, None]
    powers = np.exp(x @ beta.T + intercept)
    off = weight * (powers / powers.sum(1, keepdims=True) - y) / weight.sum()
    assert np.abs(off.sum(0)).max() < 1e-3
    assert np.abs(off.T @ x + beta / len(rows)).max() < 1e-3


def test_model_saved_by_training(spark, tmp_path):
    rows = labelled(spark, ["billing", "support"]).selectExpr(
        "seq", "array(concat(label, '_issue')) AS issue_labels", "text AS review_text",
        "text AS review_text_normalized",
    )
    predicted, metrics = classifier.train_and_predict(rows, str(tmp_path / "model"))
    tables = classifier.open_model(spark, str(tmp_path / "model"))
    assert [r.label for r in tables.labels.collect()] == sorted(metrics.first().labels)
    got = classifier.score_by_tables(rows.selectExpr("seq", "review_text AS text"), tables)
    want = {r.seq: r.ai_predicted_issue for r in predicted.collect()}
    assert {r.seq: r.ai_predicted_issue for r in got.collect()} == want


def test_records_with_tokens_in_place_of_the_text(spark):
    rows = labelled(spark, ["billing", "support"]).selectExpr(
        "seq", "array(concat(label, '_issue')) AS issue_labels", "text AS review_text",
        "text AS review_text_normalized",
    )
    cut = tfidf.tokenized(rows.select("seq", "issue_labels", tfidf.corpus_text().alias("text")))
    results = [classifier.train_and_predict(frame) for frame in (rows, cut)]
    want, got = ({r.seq: (r.ai_predicted_issue, r.ai_confidence) for r in p.collect()} for p, _ in results)
    assert got == want and results[0][1].collect() == results[1][1].collect()
    assert "_tokens" not in results[1][0].columns
    few, _ = classifier.train_and_predict(cut.limit(5))
    assert "_tokens" not in few.columns and few.count() == 5


def test_terms_are_shuffled_as_numbers(spark):
    terms = spark.createDataFrame(
        [("alpha", 1.5, [0.5, -0.5]), ("beta", 2.0, [-1.0, 1.0])], "term string, idf double, coefficients array<double>"
    )
    tables = classifier.ModelTables(
        terms, spark.createDataFrame([(0, "x", 0.1), (1, "y", 0.0)], "position int, label string, intercept double")
    )
    docs = spark.createDataFrame(
        [(1, "alpha alpha beta other"), (2, "beta"), (3, "nothing known"), (4, ""), (5, None)], "seq long, text string"
    )
    scored = classifier.score_by_tables(docs, tables, [])
    got = {r.seq: (r.ai_predicted_issue, r.ai_confidence) for r in scored.collect()}
    margin = [0.1 + (3.0 * 0.5 - 2.0) / np.hypot(3, 2), (-1.5 + 2.0) / np.hypot(3, 2)]
    assert got[1] == ("y", pytest.approx(np.exp(margin[1]) / np.exp(margin).sum(), abs=1e-4))
    assert got[2][0] == "y" and {got[k] for k in (3, 4, 5)} == {("x", round(float(1 / (1 + np.exp(-0.1))), 4))}
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(seq" in plan and not re.search(r"hashpartitioning\(seq#\d+L?, term#", plan)
