"""Links of stored pages and the order in which a crawl takes them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill import schemas
from voxmill.config import DEFAULT_SITE, Site
from voxmill.functions import text as tx
from voxmill.functions import urls
from voxmill.functions.candidates import find_links
from voxmill.operators import robots
from voxmill.operators.numbering import running_total
from voxmill.operators.pages import scan
from voxmill.sources.staging import stage

NEXT_TEXTS = ("Next", "›", "»")

_ANCHOR = schemas.struct(href=schemas.S, text=schemas.S)
_CARD = schemas.struct(start=schemas.I, n=schemas.I)
_LINKS = schemas.struct(anchors=T.ArrayType(_ANCHOR), cards=T.ArrayType(_CARD))


def page_anchors(pages: DataFrame, keep: Sequence[str] = ("url",)) -> DataFrame:
    """Every page's anchors (href, text), in page order, and its cards."""
    return scan(pages, keep, _LINKS, find_links)


def item_links(anchors: Column, site: Site = DEFAULT_SITE) -> Column:
    """The normalised item URLs that links lead to, in page order."""
    hrefs = F.filter(
        F.transform(anchors, lambda a: tx.trim_ws(a["href"])),
        lambda h: (h != "") & ~h.startswith("#") & ~F.lower(h).startswith("javascript:"),
    )
    own = F.filter(
        F.transform(hrefs, lambda h: urls.absolute_url(h, site)),
        lambda u: (urls.url_host(u) == site.host) & urls.is_item_url(u, site),
    )
    return F.transform(own, urls.normalize_url)


def page_links(
    scanned: DataFrame, keep: Sequence[str] = ("url",), site: Site = DEFAULT_SITE
) -> DataFrame:
    """(…, pos, link): item links in page order, repeated ones included."""
    return scanned.select(
        *keep, F.posexplode(item_links(F.col("anchors"), site)).alias("pos", "link")
    )


def next_page(url: Column, visited: Column, anchors: Column, site: Site = DEFAULT_SITE) -> Column:
    """The first unvisited "Next" link, else the last link numbered one above this page."""
    number = tx.non_empty(F.regexp_extract(url, r"[?&]page=(\d+)", 1)).try_cast("int")
    following = (F.coalesce(number, F.lit(1)) + 1).cast("string")
    texts = F.transform(
        anchors,
        lambda a: F.struct(tx.trim_ws(a["href"]).alias("href"), tx.collapse_ws(a["text"]).alias("text")),
    )
    leading = F.filter(
        texts, lambda a: a["text"].isin(list(NEXT_TEXTS)) | (a["text"] == following)
    )
    fresh = F.filter(
        F.transform(
            leading,
            lambda a: F.struct(urls.absolute_url(a["href"], site).alias("url"), a["text"].alias("text")),
        ),
        lambda a: (a["url"] != url) & ~F.array_contains(visited, a["url"]),
    )
    named = F.filter(fresh, lambda a: a["text"].isin(list(NEXT_TEXTS)))
    numbered = F.filter(fresh, lambda a: a["text"] == following)
    return F.coalesce(
        F.get(named, F.lit(0))["url"], F.try_element_at(numbered, F.lit(-1))["url"]
    )


def next_page_link(scanned: DataFrame, site: Site = DEFAULT_SITE) -> DataFrame:
    """(url, next_url) for pages that lead on; ``visited`` may be one of the columns."""
    if "visited" not in scanned.columns:
        scanned = scanned.withColumn("visited", F.array("url"))
    follow = next_page(F.col("url"), F.col("visited"), F.col("anchors"), site)
    return scanned.withColumn("next_url", follow).where("next_url is not null")


def listing_links(
    listings: DataFrame, scanned: DataFrame, max_pages: int, site: Site = DEFAULT_SITE
) -> DataFrame:
    """(listing, ord, link): distinct item links on up to ``max_pages`` pages of each listing.

    ``listings`` is (listing) with start URLs. Each step joins the current pages of all listings
    with the stored pages; a walk ends where the next page is missing or was seen before.
    """
    stored = scanned.select(F.col("url").alias("at"), "anchors")
    walk = listings.select(
        "listing", F.col("listing").alias("at"), F.array("listing").alias("visited")
    )
    found = None
    for step in range(max_pages):
        # Each step is written, so that the plan of a long walk does not repeat the steps before.
        here = stage(walk.join(stored, "at"), "walk")
        links = here.select(
            "listing",
            F.posexplode(item_links(F.col("anchors"), site)).alias("pos", "link"),
        ).withColumn("ord", F.lit(step).cast("long") * (1 << 31) + F.col("pos"))
        found = links if found is None else found.unionByName(links)
        follow = next_page(F.col("at"), F.col("visited"), F.col("anchors"), site)
        walk = (
            here.withColumn("next", follow)
            .where("next is not null")
            .select("listing", F.col("next").alias("at"),
                    F.array_append("visited", F.col("next")).alias("visited"))
        )
    return found.groupBy("listing", "link").agg(F.min("ord").alias("ord"))


def subcategory_links(
    scanned: DataFrame, max_categories: int, max_per_category: int, keep: str = "url",
    site: Site = DEFAULT_SITE,
) -> DataFrame:
    """(…, ord, link): subcategory links of each hub page.

    The first cards give up to ``max_per_category`` new links each; links count as seen across
    cards. A page that gives fewer than ``max_categories`` links is filled from all its links, up
    to ``max_categories * max_per_category``.
    """
    total = max_categories * max_per_category
    trimmed = F.transform(
        "anchors",
        lambda a: F.struct(tx.trim_ws(a["href"]).alias("href"), a["text"].alias("text")),
    )
    ready = F.transform(
        trimmed,
        lambda a, i: F.struct(
            urls.absolute_url(a["href"], site).alias("link"), a["href"].alias("href"),
            F.lower(tx.collapse_ws(a["text"])).alias("text"), i.alias("pos"),
        ),
    )
    pages = scanned.select(keep, "cards", ready.alias("_links"))
    whole = F.struct(F.lit(0).alias("start"), F.size("_links").alias("n"))
    cards = F.when(F.size("cards") > 0, F.slice("cards", 1, max_categories)).otherwise(
        F.array(whole)
    )
    in_cards = (
        pages.select(keep, "_links", F.posexplode(cards).alias("card", "at"))
        .select(keep, "card", F.inline(F.slice("_links", F.col("at.start") + 1, F.col("at.n"))))
        .where(F.col("href") != "")
        .where((F.col("text") == "go to category") | urls.is_subcategory_url(F.col("link"), site))
    )
    # First place of every link on its page, then the first few of each card. Groups are pages.
    first = in_cards.groupBy(keep, "link").agg(
        F.min(F.col("card").cast("long") * (1 << 31) + F.col("pos")).alias("ord")
    )
    per_card = W.partitionBy(keep, F.shiftright("ord", 31)).orderBy("ord")
    placed = first.withColumn("_taken", F.row_number().over(per_card) <= max_per_category)
    taken = F.count_if("_taken").over(W.partitionBy(keep))
    placed = placed.withColumn("_n", taken)
    listed = pages.select(keep, F.inline("_links")).where(
        urls.is_subcategory_url(F.col("link"), site)
    )
    rest = listed.groupBy(keep, "link").agg(F.min("pos").cast("long").alias("pos"))
    per_page = placed.groupBy(keep).agg(F.max("_n").alias("_n"))
    extra = (
        rest.join(placed.select(keep, "link"), [keep, "link"], "left_anti")
        .join(per_page, keep, "left")
        .withColumn("_n", F.coalesce("_n", F.lit(0)))
        .where(F.col("_n") < max_categories)
        .withColumn("_rank", F.row_number().over(W.partitionBy(keep).orderBy("pos")))
        .where(F.col("_rank") + F.col("_n") <= total)
        .select(keep, (F.col("pos") + (1 << 60)).alias("ord"), "link")
    )
    return placed.where("_taken").select(keep, "ord", "link").unionByName(extra)


def crawl_frontier(
    search_links: DataFrame, listing_links: DataFrame, target_records: int, light: bool = True
) -> DataFrame:
    """(link, listing_no, ord, source): distinct links, search links first.

    ``search_links`` is (ord, link); ``listing_links`` is (listing_no, ord, link) with listings
    numbered from 0. No further listing is added once the queue holds the cap.
    """
    cap = int(target_records * (1.5 if light else 3))
    both = search_links.select(
        F.lit(-1).cast("long").alias("listing_no"), F.col("ord").cast("long").alias("ord"), "link"
    ).unionByName(listing_links.select(
        F.col("listing_no").cast("long").alias("listing_no"), F.col("ord").cast("long").alias("ord"),
        "link",
    ))
    # The smallest (listing, place) per link, in two numbers so that the sums stay in hash maps.
    first = both.groupBy("link", "listing_no").agg(F.min("ord").alias("ord")).groupBy("link").agg(
        F.min("listing_no").alias("listing_no"), F.min_by("ord", "listing_no").alias("ord")
    )
    sizes = first.groupBy("listing_no").agg(F.count(F.lit(1)).alias("n"))
    queued = running_total(stage(sizes, "queue"), "listing_no", "n", "upto")
    # The search links always count; a listing counts while the queue before it is under the cap.
    open_ = queued.where((F.col("listing_no") < 0) | (F.col("upto") - F.col("n") < cap))
    source = F.when(F.col("listing_no") < 0, "search").otherwise("category_navigation")
    return first.join(open_.select("listing_no"), "listing_no", "left_semi").select(
        "link", "listing_no", "ord", source.alias("source")
    )


def robots_filter(
    links: DataFrame, rules: Sequence[tuple[bool, str]], url: str = "url"
) -> tuple[DataFrame, DataFrame]:
    """(allowed rows, log rows of skipped ones)"""
    allowed = urls.robots_allowed(F.col(url), rules)
    skipped = links.where(~allowed).select(
        F.col(url).alias("url"), F.lit("skipped_by_robots").alias("status"),
        F.lit("robots_disallow").alias("reason"),
    )
    return links.where(allowed), skipped


def robots_filter_by_host(
    links: DataFrame, rules: DataFrame, agent: str, url: str = "url"
) -> tuple[DataFrame, DataFrame]:
    """``robots_filter`` for many sites. ``rules``: host, agent, allow, path_pattern."""
    judged = robots.judged(links, robots.rule_index(rules, agent), url)
    skipped = judged.where("not robots_allowed").select(
        F.col(url).alias("url"), F.lit("skipped_by_robots").alias("status"),
        F.lit("robots_disallow").alias("reason"),
    )
    return judged.where("robots_allowed").select(links.columns), skipped


def discovery_source(url: Column) -> Column:
    """By the URL alone. Normalised URLs have no query, so prefer ``source`` of the frontier."""
    return F.when(F.contains(url, F.lit("search=warranty")), "search").otherwise(
        "category_navigation"
    )
