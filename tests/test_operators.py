"""Operators on small hand-written inputs, against brute force where SQL does not reach."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from voxmill import lexicons as lx
from voxmill import schemas
from voxmill.operators import (
    classifier,
    cleaning,
    evaluation,
    features,
    filters,
    insights,
    links,
    numbering,
    search,
    tfidf,
)
from voxmill.plans import catalog, pipeline
from voxmill.sources import records as io
from voxmill.sources import testviews as tv

SF = "/root/testdata/sf0.001"
WORDS = "door lamp chair table clock shelf motor wheel panel cable".split()


def raw(spark, rows):
    names = "seq long, record_id string, company string, review_text string, raw_url string"
    return spark.createDataFrame(rows, names)


def corpus_rows(n, seed=1):
    rnd = random.Random(seed)
    return [(i, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 12)))) for i in range(n)]


def brute_tfidf(rows, max_features=8000):
    """seq -> term -> weight, straight from the definition."""
    def terms(text):
        ws = [w for w in text.lower().split() if w not in lx.default_stopwords()]
        return ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]

    counts = {seq: Counter(terms(text)) for seq, text in rows}
    total, df = Counter(), Counter()
    for c in counts.values():
        total.update(c)
        df.update(c.keys())
    vocabulary = sorted(total, key=lambda t: (-total[t], t))[:max_features]
    idf = {t: math.log((1 + len(rows)) / (1 + df[t])) + 1 for t in vocabulary}
    out = {}
    for seq, c in counts.items():
        raw_ = {t: n * idf[t] for t, n in c.items() if t in idf}
        norm = math.sqrt(sum(v * v for v in raw_.values()))
        out[seq] = {t: v / norm for t, v in raw_.items()}
    return out, vocabulary


def test_positions_and_running_totals(spark):
    seqs = random.Random(3).sample(range(-50, 5000), 300)
    frame = spark.createDataFrame([(s, s % 7) for s in seqs], "seq long, v long")
    got = numbering.positions(frame, "seq", "p")
    assert [r.seq for r in got.orderBy("p").collect()] == sorted(seqs)
    total, want = 0, {}
    for s in sorted(seqs):
        total += s % 7
        want[s] = total
    for width in (1, 10, 10_000):
        rows = numbering.running_total(frame, "seq", "v", "t", width).collect()
        assert {r.seq: r.t for r in rows} == want


def test_dedup_keeps_the_first_and_numbers_the_rest(spark):
    rows = [(5, None, None, "Same  TEXT", "u"), (3, None, "", "same text!", "u"),
            (9, "", "c", "same text", "v"), (7, "own", "c", "other", "u"), (8, None, "c", None, None)]
    clean = cleaning.clean_reviews(raw(spark, rows).repartition(5)).orderBy("seq").collect()
    assert [(r.seq, r.record_id, r.company) for r in clean] == [
        (3, "record_1", "unknown"), (7, "own", "c"), (8, "record_3", "c"), (9, "record_4", "c")]
    assert clean[2].review_text == "" and clean[2].issue_labels == ["other"]


def test_a_hot_group_of_copies_is_cut_before_the_shuffle(spark):
    plan = cleaning.dedup_reviews(
        tv.raw_reviews(spark, SF))._jdf.queryExecution().executedPlan().toString()
    assert "partial_min(seq" in plan or "partial_min(doc_id" in plan


def test_filters_do_not_repeat_the_text_work(spark):
    kept = catalog.labelled(spark, SF).where(F.array_contains("issue_labels", "billing_issue"))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    # The digest and the label text: once each, however many keywords look at them.
    assert plan.count("http[^") <= 4


def test_missing_text_falls_back(spark):
    clean = cleaning.clean_reviews(raw(spark, [(1, None, None, "the of and", "u")]))
    row = features.record_features(clean).first()
    assert row.tokens == [] and row.review_text_normalized == "the of and"
    assert row.feature_token_count == 3


@pytest.mark.parametrize("cap", [8000, 12, 5])
def test_tfidf_against_brute_force(spark, cap):
    rows = corpus_rows(60)
    want, vocabulary = brute_tfidf(rows, cap)
    docs = spark.createDataFrame(rows, "seq long, text string").repartition(7)
    model = tfidf.fit(docs, max_features=cap)
    assert sorted(r.term for r in model.vocabulary.collect()) == sorted(vocabulary)
    got = {}
    for r in tfidf.tfidf_weights(docs, model).collect():
        got.setdefault(r.seq, {})[r.term] = r.weight
    assert {s for s in want if want[s]} == set(got)
    for seq, weights in got.items():
        assert weights == pytest.approx(want[seq])


def test_search_fills_with_zeros_and_breaks_ties_late_first(spark):
    rows = [(0, "door lamp"), (1, "chair"), (2, "door lamp"), (3, ""), (4, "clock")]
    docs = spark.createDataFrame(rows, "seq long, text string")
    model = tfidf.fit(docs)
    got = search.search_batch(docs, model, ["door", "nothing known", "chair lamp"], 4)
    seqs = {}
    for r in got.orderBy("query_no", "rank").collect():
        seqs.setdefault(r.query_no, []).append(r.seq)
    assert seqs == {0: [2, 0, 4, 3], 1: [4, 3, 2, 1], 2: [1, 2, 0, 4]}
    assert search.search_batch(docs, model, ["door"], 50).count() == 5


def test_search_against_brute_force(spark):
    rows = corpus_rows(80, seed=5)
    want, _ = brute_tfidf(rows)
    docs = spark.createDataFrame(rows, "seq long, text string").repartition(3)
    model = tfidf.fit(docs)
    query = "motor wheel panel"
    idf = {r.term: r.idf for r in model.vocabulary.collect()}
    q = {t: idf[t] for t in ("motor", "wheel", "panel", "motor wheel", "wheel panel") if t in idf}
    norm = math.sqrt(sum(v * v for v in q.values()))
    sims = {s: sum(w.get(t, 0.0) * v / norm for t, v in q.items()) for s, w in want.items()}
    top = sorted(sims, key=lambda s: (-round(sims[s], 10), -s))[:10]
    got = search.search_batch(docs, model, [query], 10).orderBy("rank").collect()
    assert [r.seq for r in got] == top
    assert [r.similarity for r in got] == pytest.approx([sims[s] for s in top], abs=6e-5)


def test_empty_corpus(spark):
    docs = spark.createDataFrame([], "seq long, text string")
    model = tfidf.fit(docs)
    assert search.search_batch(docs, model, ["door"], 3).count() == 0
    blank = spark.createDataFrame([(1, ""), (2, "the")], "seq long, text string")
    got = search.search_batch(blank, tfidf.fit(blank), ["door"], 3).orderBy("rank").collect()
    assert [(r.seq, r.similarity) for r in got] == [(2, 0.0), (1, 0.0)]


def test_weighing_has_no_shuffle(spark):
    docs = spark.createDataFrame(corpus_rows(20), "seq long, text string")
    weighed = tfidf.weigh(docs, tfidf.fit(docs))
    assert "Exchange" not in weighed._jdf.queryExecution().executedPlan().toString()


def test_year_filters(spark):
    rows = [(1, "Jan 5, 2024", None), (2, "unknown", "2020"), (3, "2019-01-01", "May 2, 2021")]
    frame = spark.createDataFrame(rows, "seq int, review_date string, review_updated_date string")

    def kept(*args):
        return sorted(r.seq for r in filters.filter_years(frame, *args).collect())

    assert kept(None) == [1, 2, 3] and kept([]) == [] and kept([], True) == [2]
    assert kept([2024, 2020]) == [1] and kept([2019], True) == [2, 3]
    years = [r.year for r in filters.available_years(frame).collect()]
    assert years == [2024, 2021, 2020, 2019]
    assert [r.year for r in filters.recent_years(frame, 2021).collect()] == [2024, 2021]
    assert [r.year for r in filters.recent_years(frame, 2030).collect()] == years


def test_top_values_ties_go_to_the_first_seen(spark):
    rows = [(2, ["b", "a", "b"]), (1, ["c", "a", "d"]), (3, ["d", "c"])]
    frame = spark.createDataFrame(rows, "seq long, tokens array<string>").repartition(3)
    got = [(r.keyword, r["count"]) for r in insights.top_keywords(frame, 4).collect()]
    assert got == [("c", 2), ("a", 2), ("d", 2), ("b", 2)]


def test_complete_schema_and_findings_of_nothing(spark):
    frame = spark.createDataFrame([], "seq long, company string, ai_sentiment string")
    full = insights.complete_schema(frame)
    row = insights.insights(full).first()
    assert row.total_records == 0 and len(row.key_findings) == 3
    assert insights.eda_summary(frame).first().avg_rating is None


def labelled_rows(spark, per_class):
    rows = []
    for label, n in per_class.items():
        for _ in range(n):
            i = len(rows)
            text = f"{label[:5]} {WORDS[i % 3]} {WORDS[i % 7]} {label[:5]}"
            rows.append((i, [label], text, text))
    return spark.createDataFrame(
        rows, "seq long, issue_labels array<string>, review_text string,"
        "review_text_normalized string"
    )


@pytest.mark.parametrize("counts, trainable", [
    ({"billing_issue": 20, "other": 9}, False), ({"billing_issue": 29, "other": 1}, False),
    ({"billing_issue": 30}, False), ({"billing_issue": 20, "other": 10}, True),
])
def test_model_gate(spark, counts, trainable):
    records = labelled_rows(spark, counts)
    assert classifier.model_gate(records).first().trainable is trainable
    if not trainable:
        predicted, metrics = classifier.train_and_predict(records)
        assert metrics.first().model_used == "fallback_rule_based"
        assert {r.ai_confidence for r in predicted.collect()} == {0.55}


def test_split_has_exact_quotas_and_ignores_partitioning(spark):
    counts = {"a": 101, "b": 7, "c": 2, "d": 40}
    rows = [(i, lb) for i, lb in enumerate(lb for lb, n in counts.items() for _ in range(n))]
    frame = spark.createDataFrame(rows, "seq long, label string")
    quota = classifier.test_quota(counts)
    assert sum(quota.values()) == math.ceil(150 * 0.2)
    drawn = []
    for parts in (1, 6):
        split = classifier.stratified_split(frame.repartition(parts), counts).collect()
        assert len(split) == 150
        drawn.append({r.seq for r in split if r.is_test})
        assert Counter(r.label for r in split if r.is_test) == Counter(quota)
    assert drawn[0] == drawn[1]


def test_trained_model(spark):
    counts = {"billing_issue": 25, "support_issue": 20, "other": 15}
    predicted, metrics = classifier.train_and_predict(labelled_rows(spark, counts))
    m = metrics.first()
    assert (m.model_used, m.train_size, m.test_size) == ("tfidf_logreg", 48, 12)
    assert m.accuracy > 25 / 60 and 0 < m.macro_f1 <= 1 and 0 < m.weighted_f1 <= 1
    rows = predicted.collect()
    assert len(rows) == 60 and all(1 / 3 <= r.ai_confidence <= 1 for r in rows)
    assert set(schemas.ENRICHMENT.fieldNames()[:3]) <= set(predicted.columns)


def test_classification_eval_needs_enough(spark):
    frame = spark.createDataFrame(
        [(["a"], "a"), (["a"], None), ([], "b")], "issue_labels array<string>, ai_predicted_issue string"
    )
    row = evaluation.classification_eval(frame).first()
    assert (row.status, row.records_evaluated, row.accuracy) == ("insufficient_samples", 2, None)


def test_coverage_of_nothing(spark):
    frame = spark.createDataFrame(
        [], "ai_sentiment string, ai_summary string, ai_predicted_issue string")
    row = evaluation.ai_coverage(frame).first()
    assert row.records == 0 and row.summary_coverage is None


def test_frontier_caps_listings_not_links(spark):
    start = spark.createDataFrame([(0, "a"), (1, "b"), (2, "a")], "ord long, link string")
    rows = [(0, 0, "b"), (0, 1, "c"), (1, 0, "d"), (1, 1, "e"), (2, 0, "f")]
    listing = spark.createDataFrame(rows, "listing_no long, ord long, link string")

    def queue(target):
        got = links.crawl_frontier(start, listing, target, light=True)
        return [r.link for r in got.orderBy("listing_no", "ord").collect()]

    assert queue(1) == ["a", "b"]
    assert queue(2) == ["a", "b", "c"]
    assert queue(3) == ["a", "b", "c", "d", "e"]
    assert queue(100) == ["a", "b", "c", "d", "e", "f"]


def test_records_round_trip_in_all_formats(spark, tmp_path):
    frame = schemas.complete(
        spark.createDataFrame([("1", "é\"x\n")], "record_id string, title string"), schemas.RAW_REVIEW
    ).select(*schemas.RAW_REVIEW.fieldNames())
    for fmt in ("parquet", "jsonl"):
        path = io.write_records(frame, str(tmp_path / fmt), fmt)
        got = io.read_records(spark, path, fmt=fmt)
        if fmt == "jsonl":  # JSON input gets its order column
            assert [r.seq for r in got.collect()] == [0]
        assert got.select(frame.columns).collect() == frame.collect()
    array = tmp_path / "records.json"
    array.write_text('[{"record_id": "1", "title": "a"},\n {"record_id": "2"}]', encoding="utf-8")
    got = io.read_records(spark, str(array), fmt="json").orderBy("record_id").collect()
    assert [(r.record_id, r.title) for r in got] == [("1", "a"), ("2", None)]


def test_robots_file(spark, tmp_path):
    (tmp_path / "robots.txt").write_text(
        "User-agent: *\nDisallow: /a/ # no\nAllow: /a/b\n\nUser-agent: x\nUser-agent: y\nDisallow: /\n",
        encoding="utf-8")
    rules = io.read_robots(spark, str(tmp_path / "robots.txt"))
    assert io.agent_rules(rules, "Anything/1.0") == [(False, "/a/"), (True, "/a/b")]
    assert io.agent_rules(rules, "Y/2") == [(False, "/")]
    assert rules.count() == 4


def test_pipeline_end_to_end(spark, tmp_path):
    source = str(tmp_path / "pages")
    tv.review_pages(spark, SF).select(F.col("seq").alias("page_id"), "url", "html").write.parquet(source)
    enriched = pipeline.run(spark, source, str(tmp_path / "out"), min_year=1995)
    n = enriched.count()
    assert n > 30
    names = [*schemas.CLEAN_REVIEW.fieldNames(), *schemas.FEATURES.fieldNames(),
             *schemas.ENRICHMENT.fieldNames()]
    assert set(names) <= set(enriched.columns)
    summary = spark.read.json(str(tmp_path / "out" / "evaluation_report")).first()
    assert summary.ai_coverage.records == n


def test_partitioning_changes_nothing(spark):
    base = tv.raw_reviews(spark, SF)
    results = [
        sorted(map(str, cleaning.clean_reviews(base.repartition(n)).collect())) for n in (1, 5)
    ]
    assert results[0] == results[1]
