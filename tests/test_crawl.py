"""Robots rules, walk, queue, outcomes and log wired together."""

from voxmill.plans import catalog, pipeline
from voxmill.sources import records as io

SF = "/root/testdata/sf0.001"
BASE = "https://reviews.example.org"


def page(date="May 2024", text="refund refused"):
    return (f"<div><p itemprop='reviewBody'>{text}</p>"
            f"<time itemprop='datePublished' content='{date}'></time></div>")


def listing(items, following=None):
    more = f'<a href="{following}">Next</a>' if following else ""
    return "".join(f'<a href="/item-c{i}?x=1">i</a>' for i in items) + more


def test_every_status_over_several_hosts(spark):
    out = catalog.outcomes_by_host(spark, SF)
    assert {r.status for r in out.select("status").distinct().collect()} == {
        "skipped_by_robots", "error", "no_review_body", "skipped_not_relevant", "skipped_old_year", "ok_relevant"
    }


def test_crawl_from_listings_to_records(spark, tmp_path):
    listings = spark.createDataFrame([
        (-1, BASE + "/search", listing([1, 2, 2], "/search?page=2")),
        (None, BASE + "/search?page=2", listing([3], "/search?page=3")),
        (None, BASE + "/search?page=3", listing([99])),
        (0, BASE + "/categories/a", listing([2, 4, 5], "/categories/a?page=2")),
        (None, BASE + "/categories/a?page=2", listing([98])),
        (1, BASE + "/categories/b", listing([6])),
        (2, BASE + "/private/c", listing([97])),
    ], "listing_no int, url string, html string")
    rules = spark.createDataFrame(
        [("reviews.example.org", "*", False, "/item-c5$"), ("reviews.example.org", "*", False, "/private/")],
        "host string, agent string, allow boolean, path_pattern string",
    )
    stored = spark.createDataFrame([
        (10, BASE + "/item-c1", page("2010")), (11, BASE + "/item-c2?utm_source=x", page()),
        (12, BASE + "/item-c2", page()), (13, BASE + "/item-c4/", page()), (14, BASE + "/item-c5", page()),
        (15, BASE + "/item-c6", page()), (16, BASE + "/item-c77", page()), (17, BASE + "/item-c6", None),
    ], "page_id long, url string, html string")
    given = pipeline.Crawl(rules, listings, target_records=2)  # a queue of 3, three links come from the search
    paths = pipeline.Paths(str(tmp_path / "small"))
    kept = pipeline.extract(stored, paths, min_year=2020, given=given).collect()
    assert [(r.seq, r.discovery_source) for r in kept] == [(11, "search")]

    given = pipeline.Crawl(rules, listings, target_records=4)
    paths = pipeline.Paths(str(tmp_path / "large"))
    kept = pipeline.extract(stored, paths, min_year=2020, given=given)
    assert sorted((r.seq, r.discovery_source) for r in kept.collect()) == [
        (11, "search"), (13, "category_navigation"), (15, "category_navigation")
    ]
    log = io.read_records(spark, paths.at("crawl_log")).collect()
    status = {r.url.removeprefix(BASE): r.status for r in log if r.status != "listing_scraped"}
    assert status == {
        "/search": "search_seed_complete", "/item-c1": "skipped_old_year", "/item-c2?utm_source=x": "ok_relevant",
        "/item-c3": "error", "/item-c4/": "ok_relevant", "/item-c5": "skipped_by_robots", "/item-c6": "ok_relevant",
    }
    links = {r.url.removeprefix(BASE): r.complaint_links_found for r in log if r.status == "listing_scraped"}
    assert links == {"/search": 3, "/categories/a": 3, "/categories/b": 1}
    seed = [r for r in log if r.status == "search_seed_complete"]
    assert [(r.queued_complaints, r.complaint_links_found) for r in seed] == [(3, None)]


def test_nothing_to_crawl(spark, tmp_path):
    listings = spark.createDataFrame([], "listing_no int, url string, html string")
    stored = spark.createDataFrame([(1, BASE + "/item-c1", page())], "page_id long, url string, html string")
    paths = pipeline.Paths(str(tmp_path))
    assert pipeline.extract(stored, paths, given=pipeline.Crawl(listings=listings)).count() == 0
    assert io.read_records(spark, paths.at("crawl_log")).count() == 0


def test_host_rules_from_files(spark, tmp_path):
    (tmp_path / "A.example").mkdir()
    (tmp_path / "A.example" / "robots.txt").write_text("User-agent: *\nDisallow: /x\n")
    (tmp_path / "b.example.txt").write_text("User-agent: bot\nAllow: /y\n")
    got = io.read_host_rules(spark, str(tmp_path) + "/{A.example/robots.txt,b.example.txt}").collect()
    assert {(r.host, r.agent, r.allow, r.path_pattern) for r in got} == {
        ("a.example", "*", False, "/x"), ("b.example", "bot", True, "/y")
    }
