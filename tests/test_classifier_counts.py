"""The classifier's terms are counted by number in the workers."""

import numpy as np
import pyarrow as pa
import pytest

from voxmill.functions import counting
from voxmill.operators import classifier, tfidf


def test_unit_vectors_are_those_of_the_transformers(spark):
    texts = [f"alpha w{i % 7} w{i % 3} beta" + " alpha" * (i % 4) for i in range(2100)] + ["", "none", "beta alpha"]
    tokens = tfidf.tokenized(spark.createDataFrame(list(enumerate(texts)), "seq long, text string"), [])
    model = tfidf.fit(tokens, [], 12)
    want = {r.seq: r._weights for r in tfidf.weigh(tokens, model).collect()}
    frame = tfidf.weigh_by_number(tokens, model, "features")
    got = {r.seq: r.features for r in frame.collect()}
    assert got.keys() == want.keys()
    for seq, vector in want.items():
        assert got[seq].size == vector.size and list(got[seq].indices) == list(vector.indices)
        assert list(got[seq].values) == pytest.approx(list(vector.values), abs=1e-14)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "zip_with" not in plan


def test_a_document_is_one_row_of_the_shuffle(spark):
    terms = spark.createDataFrame([("alpha", 1.5, [0.5, -0.5]), ("alpha beta", 2.0, [-1.0, 1.0]), ("a b c", 9.0, [5.0, 0.0])],
                                  "term string, idf double, coefficients array<double>")
    tables = classifier.ModelTables(
        terms, spark.createDataFrame([(0, "x", 0.1), (1, "y", 0.0)], "position int, label string, intercept double"))
    # A number that stands twice is one document; one without a known word keeps its row, as does no number.
    docs = spark.createDataFrame([(1, "alpha beta alpha"), (1, "alpha other"), (2, "a b c"), (None, ""), (3, None)],
                                 "seq long, text string")
    scored = classifier.score_by_tables(docs, tables, [])
    got = {r.seq: r.probabilities for r in scored.collect()}
    x = np.array([3 * 1.5, 2.0])
    margin = np.array([0.1, 0.0]) + x @ np.array([[0.5, -0.5], [-1.0, 1.0]]) / np.sqrt(x @ x)
    assert got[1] == pytest.approx(list(np.exp(margin) / np.exp(margin).sum()))
    even = np.exp([0.1, 0.0]) / np.exp([0.1, 0.0]).sum()
    assert got.keys() == {1, 2, 3, None} and all(got[k] == pytest.approx(list(even)) for k in (2, 3, None))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "explode" not in plan and plan.split("Initial Plan")[-1].count("hashpartitioning(seq") == 1


def test_cells_of_a_list(spark):
    batch = pa.RecordBatch.from_arrays([pa.array([["a", "b", "a"], None, ["z"], ["b"]]), pa.array([4, 5, 6, 7])], ["t", "seq"])
    rows = next(iter(counting.document_cells([batch], ["b", "a b", "a"]))).to_pylist()
    assert rows == [{"seq": 4, "place": [0, 1, 2], "n": [1, 1, 2]}, {"seq": 5, "place": [], "n": []},
                    {"seq": 6, "place": [], "n": []}, {"seq": 7, "place": [0], "n": [1]}]
    assert next(iter(counting.document_cells([batch], []))).column("place").to_pylist() == [[], [], [], []]
