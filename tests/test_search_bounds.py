"""Bounds that leave documents out of a search, and weights made in the workers."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voxmill.functions import counting, scoring
from voxmill.operators import search_index, tfidf


def chunk(rng, docs, twice=False):
    """Vectors of length one over 60 terms, as postings in two blocks; with ``twice`` one number has two rows."""
    lists, dense = {}, np.zeros((docs, 60))
    for d in [*range(docs), *([3] if twice else [])]:
        at = rng.choice(60, rng.integers(1, 50), replace=False)
        w = rng.random(at.size) + 0.3
        w /= np.sqrt((w * w).sum())
        dense[d, at] += w
        for i, x in zip(at.tolist(), w.tolist()):
            lists.setdefault((i, d * 2 // docs), []).append((d * 10, x))
    keys = sorted(lists, key=lambda k: (k[1], -k[0]))
    return dense, pa.table({
        "index": pa.array([k[0] for k in keys], pa.int32()),
        "seqs": [[s for s, _ in lists[k]] for k in keys], "weights": [[x for _, x in lists[k]] for k in keys],
    })


@pytest.mark.parametrize("twice", [False, True])
def test_documents_below_a_result_are_left_out_and_no_others(twice):
    rng = np.random.default_rng(5)
    dense, postings = chunk(rng, 400, twice)
    rows, want = [], {}
    for q in range(60):
        at = np.sort(rng.choice(60, rng.integers(1, 40), replace=False))
        w = rng.random(at.size)
        w /= np.sqrt((w * w).sum())
        sims = dense[:, at] @ w
        least = None if q % 7 == 0 else float(np.sort(sims)[-(q % 20) - 1])
        rows += [(q, i, x, least) for i, x in zip(at.tolist(), w.tolist())]
        best = sorted(((round(s, 10), d * 10) for d, s in enumerate(sims) if s > 0), reverse=True)[:8]
        want[q] = [b for b in best if least is None or b[0] >= round(least, 10)]
    rng.shuffle(rows)
    terms = pa.table(dict(zip(("query_no", "index", "query_weight", "least"), map(list, zip(*rows)))))
    got = {}
    for r in scoring.best_of_chunk(postings, terms, 8).to_pylist():
        got.setdefault(int(r["query_no"]), []).append((round(r["sim"], 10), r["seq"]))
    assert {q: sorted(v, reverse=True) for q, v in got.items()} == {q: v for q, v in want.items() if v}
    whole = scoring._Chunk(postings)
    reach = whole.reach(np.array([0.0, 0.9, 0.9]), np.array([5, 5, 40]))
    assert reach[0] == 400
    assert twice or reach[1] < reach[2] <= 400


def test_weights_by_number_are_those_of_the_transformers(spark):
    docs = spark.createDataFrame(
        [(i, f"alpha w{i % 7} w{i % 3} beta" + " alpha" * (i % 4)) for i in range(60)] + [(60, ""), (61, None), (62, "x y")],
        "seq long, text string",
    )
    tokens = tfidf.tokenized(docs, [])
    model = tfidf.fit(tokens, [], 12)
    vector = tfidf.sparse("_weights")
    want = {r.seq: (list(r.i), pytest.approx(list(r.w), abs=1e-14)) for r in tfidf.weigh(tokens, model).select(
        "seq", vector["indices"].alias("i"), vector["values"].alias("w")).collect() if len(r.i)}
    cells = tfidf.weighed_cells(tokens, model)
    assert {r.seq: (r["index"], r.weight) for r in cells.collect()} == want and len(want) == 60
    assert "CountVectorizer" not in (plan := cells._jdf.queryExecution().toString()) and "MapInArrow" in plan


def test_postings_of_a_block():
    vectors = pa.table({
        "seq": [5, 2, 2], "index": pa.array([[0, 3], [3], [3]], pa.list_(pa.int32())), "weight": [[0.6, 0.8], [1.0], [0.5]],
        "block": [7, 7, 7],
    })
    assert counting.postings(vectors).to_pylist() == [
        {"index": 0, "block": 7, "top": 0.6, "seqs": [5], "weights": [0.6]},
        {"index": 3, "block": 7, "top": 1.0, "seqs": [2, 2, 5], "weights": [0.5, 1.0, 0.8]},
    ]


def test_only_the_first_chunk_is_scored_in_full(spark, monkeypatch, tmp_path):
    rows = [(i, " ".join(f"w{(i * k) % 23}" for k in range(1, 6))) for i in range(300)]
    records = spark.createDataFrame(rows, "seq long, review_text string").withColumn(
        "review_text_normalized", F.col("review_text"))
    monkeypatch.setattr(search_index, "BLOCK_DOCS", 16)
    index = search_index.build(records, str(tmp_path / "i"))
    queries = spark.createDataFrame([(i, f"w{i % 23} w{i % 5} w{i % 7}") for i in range(40)], "query_no int, query string")
    want = sorted(map(tuple, search_index.search(index, queries, 3).collect()))
    monkeypatch.setattr(search_index, "MANY_QUERIES", 5)
    monkeypatch.setattr(search_index, "CHUNK_BLOCKS", 4)
    known = []
    kept = search_index._best_of_chunks

    def seen(postings, terms, asked, chunks, *rest):
        known.append((chunks, terms.where("least is not null").count() > 0))
        return kept(postings, terms, asked, chunks, *rest)

    monkeypatch.setattr(search_index, "_best_of_chunks", seen)
    assert sorted(map(tuple, search_index.search(index, queries, 3).collect())) == want
    assert known == [(1, False), (5, True)]
