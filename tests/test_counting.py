"""Pairs and document frequencies by numbers, against counts by hand."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from voxmill.functions import counting
from voxmill.operators import evaluation, tfidf


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = [*(f"w{i}" for i in range(40)), "été", "слово"]
    return [" ".join(rng.choices(words, [1 / (k + 1) for k in range(42)], k=rng.randint(0, 30))) for _ in range(300)]


def wanted(texts, most):
    total, df = Counter(), Counter()
    for text in texts:
        own = text.split()
        terms = own + [f"{a} {b}" for a, b in zip(own, own[1:])]
        total.update(terms)
        df.update(set(terms))
    best = sorted(total, key=lambda t: (-total[t], t))[:most]
    return {t: (total[t], df[t]) for t in best}


@pytest.mark.parametrize("limit", [tfidf.WORKER_BYTES, -1])
@pytest.mark.parametrize("held", [counting.HELD_PAIRS, 7])
def test_vocabulary_against_counts_by_hand(spark, texts, monkeypatch, limit, held):
    monkeypatch.setattr(tfidf, "WORKER_BYTES", limit)
    monkeypatch.setattr(counting, "HELD_PAIRS", held)
    rows = [(i, t) for i, t in enumerate([*texts, None, ""])] + [(3, texts[3])]
    docs = spark.createDataFrame(rows, "seq long, text string")
    for most in (5, 25, 10**4):
        model = tfidf.fit(docs, (), most)
        got = {r.term: (r.total, r.df) for r in model.vocabulary.collect()}
        assert got == wanted([*texts, texts[3]], most)
        assert model.n_docs == 303


def test_batches_in_small_slices(texts, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(counting, "SLICE_ROWS", 3)
    monkeypatch.setattr(counting, "HELD_PAIRS", 5)
    lists = [None, [], *(t.split() for t in texts[:50]), None]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.string()))], ["t"])
    found = Counter()
    words = pa.array(["w0", "w1", "été"])
    for part in counting.pair_counts([batch], words):
        for row in next(iter(counting.named_pairs([part], words))).to_pylist():
            found[row["a"], row["b"]] += row["total"]
    want = Counter((a, b) for t in lists if t for a, b in zip(t, t[1:]) if {a, b} <= {"w0", "w1", "été"})
    assert found == want


def test_fit_counts_without_rows_per_pair_and_evaluation_splits_once(spark, texts, monkeypatch):
    """Before, the fit made a row for each pair, and the evaluation cut every text into tokens twice."""
    cut, exploded = [], []
    kept = tfidf.tx.index_tokens
    monkeypatch.setattr(tfidf.tx, "index_tokens", lambda *a: cut.append(a[0]) or kept(*a))
    inline = F.inline
    monkeypatch.setattr(tfidf.F, "inline", lambda c: exploded.append(c) or inline(c))
    rows = spark.createDataFrame([(i, "c", t, t) for i, t in enumerate(texts)],
                                 "seq long, company string, review_text_normalized string, review_text string")
    docs = tfidf.tokenized(tfidf.corpus(rows), ()).localCheckpoint()
    cut.clear()
    tfidf.fit(docs, (), 25)
    assert not exploded
    assert evaluation.retrieval_hits(rows, [("w3 w4", ["w3"])], 2).count() == 2
    assert len([c for c in cut if "text" in c]) <= 2  # the records and the query
