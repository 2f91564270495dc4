"""No silent caps, JSON input without an order column, pages in linear time, robots rules per host."""

import json
import time

from voxmill.functions import candidates
from voxmill.operators import classifier, links
from voxmill.sources import records as io


def test_every_class_counts(spark):
    rows = [(i, f"word{i % 1100} again word{i % 1100}", f"c{i % 1100:04d}") for i in range(2200)]
    train = spark.createDataFrame(rows, "seq long, text string, label string")
    labels = sorted({r[2] for r in rows})
    model = classifier.fit_classifier(train, labels, max_iter=1)
    assert model.regression.numClasses == 1100
    split = classifier.stratified_split(train, {c: 2 for c in labels}, percent=50)
    assert split.where("is_test").count() == 1100


def test_summary_keeps_all_rows(spark, tmp_path):
    path = io.write_summary(spark.range(5), str(tmp_path / "s"))
    assert spark.read.json(path).count() == 5


def test_json_without_order_column(spark, tmp_path):
    rows = [{"record_id": str(i), "review_text": f"text {i}"} for i in range(50)]
    (tmp_path / "a.json").write_text(json.dumps(rows[:20]))
    (tmp_path / "b.json").write_text(json.dumps(rows[20:]))
    got = io.read_records(spark, str(tmp_path / "*.json"), fmt="json").orderBy("seq").collect()
    assert [r["record_id"] for r in got] == [str(i) for i in range(50)]
    (tmp_path / "c.jsonl").write_text("\n".join(map(json.dumps, rows)))
    got = io.read_records(spark, str(tmp_path / "c.jsonl"), fmt="jsonl").orderBy("seq").collect()
    assert [r["record_id"] for r in got] == [str(i) for i in range(50)]
    assert len({r["seq"] for r in got}) == 50


def test_pages_in_linear_time():
    def seconds(html):
        start = time.perf_counter()
        candidates.find_links(html)
        return time.perf_counter() - start

    small, large = (seconds("<ul>" + "<li>x" * n) for n in (5_000, 50_000))
    assert large < 40 * small + 1
    small, large = (seconds("<div><h2>t</h2>" * n + "<a href='u'>a</a><a href='v'>b</a>") for n in (2_000, 20_000))
    assert large < 40 * small + 1


def test_robots_rules_of_two_hosts(spark):
    rules = spark.createDataFrame(
        [("a.example", "*", False, "/x"), ("a.example", "*", True, "/x/y*z$"),
         ("b.example", "*", False, "/"), ("b.example", "bot", False, "/only")],
        "host string, agent string, allow boolean, path_pattern string",
    )
    urls = ["http://a.example/x/1", "http://a.example/x/y/z", "http://a.example/q", "http://b.example/x",
            "http://b.example/only/1", "http://c.example/x"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    allowed, skipped = links.robots_filter_by_host(frame, rules, "Bot/1.0")
    assert {r["url"] for r in skipped.collect()} == {urls[0], urls[4]}
    assert {r["url"] for r in allowed.collect()} == set(urls) - {urls[0], urls[4]}
