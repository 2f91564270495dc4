"""Page and link extraction on hand-written, partly broken HTML."""

import hashlib

from pyspark.sql import functions as F

from voxmill.operators import crawl, links, pages

BASE = "https://reviews.example.org"

FULL = """<!DOCTYPE html><html><head><script>var x = "<p itemprop='reviewBody'>no</p>";</script>
<script type="application/ld+json">{"name": "Json Co", "aggregateRating": {"ratingValue": "3.5"}}</script>
<style>p { color: red }</style></head><body>
<nav class="breadcrumb wide"><a href="/">Home</a><a href="/x"> Kitchen  Ware </a><a href="/y">CB</a></nav>
<h1>Fallback title</h1>
<div class="complaint-main__content big"><h2 class="complaint-main__header-name">Acme &amp; Co
  broke (12 comments)</h2>
<div class="complaint-main__user">Bob Stone of NY | Jan 5, 2024</div>
<meta itemprop="ratingValue" content="9"><section><p itemprop="reviewBody">It <b>broke</b>.<br>I want a
refund<!-- hidden --> now</p></section><p>Helpful 7</p>
<p><span>Desired outcome:</span> full refund</p><p>Claimed loss: $20</p>
<span itemprop="datePublished"> Jan 5, 2024 </span></div>
<p>Review updated: Feb 3, 2025</p><p>Featured Review</p>
<div class="comment-item"><p>Short</p><span class="comment-author">Eve Stone</span></div>
<div class="comment-item comment-block"><div class="comment-text">This is a company response of Acme Ltd.</div>
<time content="2024-01-07">x</time> Helpful 2</div>
<div class="comment-item"><p>tiny</p></div>
</body></html>"""

BARE = "<p itemprop='reviewBody'>Unclosed <div>text of the body<p>more"
NONE = "<html><body><h1>Nothing</h1></body></html>"
FALLBACK_COMMENTS = """<section><h3>Comments</h3><ul><li>One long enough comment here</li>
<li>One long enough comment here</li><li>short</li></ul></section><div itemprop="reviewBody">b</div>
<h1>Acme Review : thing</h1>"""


def extracted(spark, *htmls):
    rows = [(i, f"{BASE}/p-c{i}", h) for i, h in enumerate(htmls)]
    frame = spark.createDataFrame(rows, "seq long, url string, html string")
    found = pages.page_candidates(frame, ("seq", "url"))
    return {r.seq: r for r in pages.review_records(found, ("seq",)).collect()}


def test_full_page(spark):
    r = extracted(spark, FULL)[0]
    assert r.record_id == hashlib.md5(f"{BASE}/p-c0".encode()).hexdigest()
    assert r.title == "Acme & Co broke (12 comments)" and r.comment_count == 12
    assert r.review_text == "It broke . I want a refund now"
    assert r.company == "Json Co" and r.rating == 3.5
    assert r.breadcrumbs == ["Home", "Kitchen Ware", "CB"] and r.category == "kitchen-ware"
    assert r.review_date == "Jan 5, 2024" and r.review_updated_date == "Feb 3, 2025"
    assert (r.reviewer_name, r.reviewer_location) == ("Bob Stone", "NY")
    assert r.helpful_count == 7 and r.claimed_loss == "$20" and r.is_featured_review
    # The label's own element holds nothing after it, nor does its line, so the field stays empty.
    assert r.desired_outcome is None
    # Too short a text gives way to the whole block; the second block is found by two rules.
    first, reply = r.comments
    assert (first.text, first.author_name, first.posted_at) == ("Short Eve Stone", "Eve Stone", None)
    assert reply.is_company_response
    assert reply.posted_at == "2024-01-07" and reply.helpful_count == 2
    assert reply.comment_id == hashlib.md5(f"None|2024-01-07|{reply.text}".encode()).hexdigest()
    assert r.relevance_score == 1 and r.has_return_mention and not r.has_warranty_mention


def test_broken_pages(spark):
    got = extracted(spark, BARE, NONE, "", None)
    assert set(got) == {0}
    assert got[0].review_text == "Unclosed text of the body more"
    assert got[0].title == "unknown" and got[0].company == "unknown"
    assert got[0].category == "general-complaints" and got[0].comments == []
    assert got[0].comment_count == 0 and got[0].rating is None and got[0].review_date is None


def test_comments_from_a_section_and_company_from_the_heading(spark):
    r = extracted(spark, FALLBACK_COMMENTS)[0]
    assert [c.text for c in r.comments] == ["One long enough comment here"]
    assert r.company == "Acme"


def scanned(spark, rows):
    frame = spark.createDataFrame(rows, "url string, html string")
    return links.page_anchors(frame)


def test_item_links(spark):
    html = ("<a href=' /a-c1?x=1 '>1</a><a href='#a-c2'>2</a><a href='JavaScript:a-c3'>3</a>"
            "<a href=/b-C4>4</a><a href='https://www.reviews.example.org/c-c5#z'>5</a>"
            "<a href='https://other.example.org/c-c6'>6</a><a href='/a-c1'>7</a><a>8</a>"
            "<!-- <a href='/d-c7'>9</a> --><script>'<a href=\"/e-c8\">'</script>")
    got = links.page_links(scanned(spark, [("u", html)])).orderBy("pos").collect()
    assert [r.link for r in got] == [
        BASE + "/a-c1", BASE + "/b-C4", "https://www.reviews.example.org/c-c5", BASE + "/a-c1"]


def test_next_page(spark):
    rows = [
        (BASE + "/l?page=2", "<a href='/l?page=1'>1</a><a href='/l?page=3'>3</a><a href='/z'>3</a>"),
        (BASE + "/m", "<a href='/m?page=2'>2</a><a href='/n'>Next</a><a href='/o'>»</a>"),
        (BASE + "/s", "<a href='/s'>Next</a>"),
    ]
    got = {r.url: r.next_url for r in links.next_page_link(scanned(spark, rows)).collect()}
    assert got == {BASE + "/l?page=2": BASE + "/z", BASE + "/m": BASE + "/n"}


def test_listing_walk_stops_at_seen_pages(spark):
    def page(item, following):
        return f"<a href='/i-c{item}'>i</a><a href='/i-c1'>i</a><a href='{following}'>Next</a>"

    rows = [(BASE + "/a", page(1, "/b")), (BASE + "/b", page(2, "/a")), (BASE + "/c", page(3, "/gone"))]
    frame = scanned(spark, rows)
    starts = spark.createDataFrame([(BASE + "/a",), (BASE + "/c",)], "listing string")
    got = links.listing_links(starts, frame, max_pages=5).orderBy("listing", "ord").collect()
    assert [(r.listing[-1], r.link[-1]) for r in got] == [
        ("a", "1"), ("a", "2"), ("c", "3"), ("c", "1")]


def test_subcategory_cards_and_fallback(spark):
    hub = ("<div><h2>A</h2><a href='/p'>p</a><a href='/q'>q</a><a href='/r'>r</a></div>"
           "<section><strong>B</strong><a href='/p'>p</a><a href='/login'>Go to  category</a>"
           "<a href='/s'>s</a><a href='/t'>t</a></section><a href='/u'>u</a>")
    few = "<div><h3>A</h3><a href='/login'>a</a><a href='/x-c1'>b</a></div><a href='/v'>v</a><a href='/w'>w</a>"
    frame = scanned(spark, [("hub", hub), ("few", few)])
    got = {}
    for r in links.subcategory_links(frame, 2, 2).orderBy("url", "ord").collect():
        got.setdefault(r.url, []).append(r.link.removeprefix(BASE))
    assert got["hub"] == ["/p", "/q", "/login", "/s"]
    assert got["few"] == ["/v", "/w"]


def test_outcomes_in_order(spark):
    def page(text, date):
        return (f"<div><p itemprop='reviewBody'>{text}</p>"
                f"<time itemprop='datePublished' content='{date}'></time></div>")

    rows = [(0, BASE + "/no/a-c1", page("refund", "2024")), (1, BASE + "/b", NONE),
            (2, BASE + "/c", page("nice", "2024")), (3, BASE + "/d", page("refund", "2010")),
            (4, BASE + "/e", page("refund", "soon")), (5, BASE + "/f", page("refund", "May 2024"))]
    frame = spark.createDataFrame(rows, "seq long, url string, html string")
    found = pages.extracted(pages.page_candidates(frame, ("seq", "url")), ("seq",))
    out = crawl.crawl_outcomes(found, 2020, [(False, "/no/")])
    got = [r.status for r in out.orderBy("seq").collect()]
    assert got == ["skipped_by_robots", "no_review_body", "skipped_not_relevant",
                   "skipped_old_year", "skipped_old_year", "ok_relevant"]
    assert crawl.accept_limit(out, 5, "seq").count() == 1
    log = crawl.crawl_log(out, 2020).where(F.col("status") == "ok_relevant").first()
    assert log.review_year == 2024 and log.min_year is None
