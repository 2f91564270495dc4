"""The two input views the tests and registered queries use, derived from the supplied tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.schemas import COMMENTS

# Opening sentences by n_chars modulo 12 (10 and 11 have none).
OPENINGS = [
    "Warranty claim denied by the agent. The broken unit was never replaced! "
    "See http://example.org/a for proof.",
    "I returned the parcel and the refund was delayed. They refused to answer my letters.",
    "Late delivery of a defective door. Shipping took ages and the box arrived damaged.",
    "Support was rude and unhelpful. The representative ignored every single message sent.",
    "I was charged twice and the invoice shows a hidden fee. Awful billing practice.",
    "Issue resolved and the item was fixed. Thank you, the claim was approved quickly.",
    "Repair covered by the guarantee. Replacement honored, satisfied with the outcome.",
    "Chargeback filed. This is fraud and a scam, the worst shop, totally unacceptable.",
    "The repair stopped the malfunction and everything is working again, thanks.",
    "Extended coverage was a guarantee on paper only. The claim cannot proceed.",
]


# Columns in use; with a schema, reading a table needs no look at its files first.
SCHEMAS = {
    "documents": "doc_id long, text string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "orders": "o_orderkey long, o_orderdate timestamp_ntz",
    "conversations": "conv_id long, turn long, text string",
    "supplier": "s_suppkey long, s_name string",
    "part": "p_size int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document. Every join but the supplier one is on doc_id, so one shuffle serves all.

    The shuffle is asked for by name: it also spreads the text of a table that comes in few large
    row groups over all cores before the work on it starts.
    """
    doc_id = F.col("doc_id")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    docs = docs.repartition("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_id"), "o_orderdate"
    )
    talks = (
        table(spark, sf_dir, "conversations")
        .groupBy(F.col("conv_id").alias("doc_id"))
        .agg(
            F.count(F.lit(1)).alias("n_turns"),
            F.max(F.when(F.col("turn") == 1, F.col("text"))).alias("reply"),
        )
    )
    # At most ten suppliers can match n_chars % 10, so this side is bounded and broadcast.
    suppliers = (
        table(spark, sf_dir, "supplier")
        .where("s_suppkey between 0 and 9")
        .select(F.col("s_suppkey").alias("digit"), "s_name")
    )
    joined = (
        docs.join(labels, "doc_id", "left")
        .join(orders, "doc_id", "left")
        .join(talks, "doc_id", "left")
        .withColumn("digit", F.col("n_chars") % 10)
        .join(F.broadcast(suppliers), "digit", "left")
    )
    year = F.year("o_orderdate")
    opening = F.lit("")
    for i, sentence in enumerate(OPENINGS):
        opening = F.when(F.col("n_chars") % 12 == i, sentence).otherwise(opening)
    return joined.select(
        doc_id.alias("seq"),
        F.when(doc_id % 29 != 0, F.md5(doc_id.cast("string"))).alias("record_id"),
        F.when(doc_id % 11 != 0, F.col("s_name")).alias("company"),
        F.when(doc_id % 3 == 0, "appliances")
        .when(doc_id % 3 == 1, "electronics")
        .otherwise("home-garden")
        .alias("category"),
        F.format_string("Case %d (%d comments)", doc_id, F.coalesce("n_turns", F.lit(0)))
        .alias("title"),
        F.concat(opening, F.lit(" "), F.col("text")).alias("review_text"),
        F.col("reply").alias("comment_text"),
        F.when(F.col("quality") == 1, 4.5)
        .when(F.col("quality") == 0, F.lit(1.0) + F.col("toxic"))
        .alias("rating"),
        F.when(doc_id % 13 == 0, None)
        .when(doc_id % 17 == 0, "unknown")
        .when(
            F.col("o_orderdate").isNotNull(),
            F.format_string("Mar %d, %d", F.dayofmonth("o_orderdate"), year),
        )
        .alias("review_date"),
        F.when((doc_id % 5 == 0) & F.col("o_orderdate").isNotNull(),
               F.format_string("Apr 2, %d", year + 1))
        .alias("review_updated_date"),
        F.format_string("https://reviews.example.org/item-c%d", F.col("n_chars")).alias("raw_url"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``reviews`` in record form: the reply becomes a comment and part of the full text."""
    comment = F.struct(
        F.md5("comment_text").alias("comment_id"),
        F.lit("Guest").alias("author_name"),
        F.lit(None).cast("string").alias("author_location"),
        F.lit(None).cast("string").alias("posted_at"),
        F.col("comment_text").alias("text"),
        F.lit(None).cast("int").alias("helpful_count"),
        F.lit(False).alias("is_company_response"),
    )
    return (
        reviews(spark, sf_dir)
        .withColumn("full_text_with_comments", F.concat_ws(" ", "review_text", "comment_text"))
        .withColumn(
            "comments",
            F.when(F.col("comment_text").isNotNull(), F.array(comment)).cast(COMMENTS),
        )
        .drop("comment_text")
    )


def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One HTML page per review, with the review's values embedded."""

    def escaped(name: str):
        return F.replace(F.replace(F.col(name), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))

    def part(name: str, *pieces):
        return F.when(F.col(name).isNull(), "").otherwise(F.concat(*pieces))

    lit = F.lit
    html = F.concat(
        lit('<html><body><div class="breadcrumbs"><a href="/">Home</a>'
            '<a href="/c">Home Garden</a></div><h1>'),
        F.coalesce("company", lit("unknown")), lit(" review: "), F.col("title"),
        lit('</h1><div class="complaint-main__content"><span itemprop="author">Ann</span>'),
        part("review_date", lit('<time itemprop="datePublished" content="'),
             F.col("review_date"), lit('"></time>')),
        part("rating", lit('<meta itemprop="ratingValue" content="'),
             F.col("rating").cast("string"), lit('">')),
        lit('<p itemprop="reviewBody">'), escaped("review_text"),
        lit("</p><p>Claimed loss: $"), F.col("seq").cast("string"), lit("</p></div>"),
        part("comment_text", lit('<div itemprop="comment"><p itemprop="commentText">'),
             escaped("comment_text"), lit("</p></div>")),
        lit('<a href="/next-c'), (F.col("seq") + 1).cast("string"),
        lit('?utm_source=x">n</a></body></html>'),
    )
    bare = lit("<html><body><h1>Not a review</h1></body></html>")
    return reviews(spark, sf_dir).select(
        "seq", F.col("raw_url").alias("url"),
        F.when(F.col("seq") % 19 == 0, bare).otherwise(html).alias("html"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages that link to the reviews: ten items a page, four pages a listing.

    Even listings have "Next" links, odd ones only page numbers.
    """
    docs = table(spark, sf_dir, "documents").select(
        F.expr("doc_id div 40").alias("listing_no"),
        F.expr("(doc_id div 10) % 4 + 1").alias("page_no"),
        F.struct(
            "doc_id",
            F.format_string('<p><a href="/item-c%d?from=list">item</a></p>', F.col("n_chars"))
            .alias("link"),
        ).alias("item"),
    )
    # A page collects at most ten rows.
    pages = docs.groupBy("listing_no", "page_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("item")), lambda x: x["link"]), "")
        .alias("items")
    )
    base = F.format_string("/categories/l%d?page=", "listing_no")
    numbers = F.concat(*[
        F.concat(F.lit('<a href="'), base, F.lit(f'{n}">{n}</a>')) for n in (1, 2, 3, 4)
    ])
    following = F.when(
        (F.col("listing_no") % 2 == 0) & (F.col("page_no") < 4),
        F.concat(F.lit('<a href="'), base, (F.col("page_no") + 1).cast("string"),
                 F.lit('">Next</a>')),
    ).otherwise("")
    return pages.select(
        "listing_no", "page_no",
        F.concat(F.lit("https://reviews.example.org"), base, F.col("page_no").cast("string"))
        .alias("url"),
        F.concat(F.lit("<html><body><h2>List</h2>"), "items", numbers, following,
                 F.lit("</body></html>")).alias("html"),
    )


CRAWL_HOSTS = ("reviews.example.org", "m.example.org", "shop.example.net")


def hosted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``review_pages`` on three hosts; every 23rd page was not fetched."""
    host = F.element_at(F.array(*[F.lit(h) for h in CRAWL_HOSTS]), (F.col("seq") % 3 + 1).cast("int"))
    return review_pages(spark, sf_dir).select(
        "seq", F.replace(F.col("url"), F.lit(CRAWL_HOSTS[0]), host).alias("url"),
        F.when(F.col("seq") % 23 != 0, F.col("html")).alias("html"),
    )


def robots_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(origin, body) of two of the hosts, made from the part sizes: one rule per size.

    The first host's rules are prefixes, the second's begin and end. Sizes divisible by 7 are disallowed.
    """
    rule = F.concat(
        F.when(F.col("p_size") % 7 == 0, "Disallow: ").otherwise("Allow: "),
        F.lit("/item-"), F.when(F.col("host") == CRAWL_HOSTS[0], "c").otherwise("*"),
        F.col("p_size").cast("string"), F.when(F.col("host") == CRAWL_HOSTS[1], "$").otherwise(""),
    )
    sizes = table(spark, sf_dir, "part").select("p_size").distinct()  # 50 sizes
    hosts = F.array(*[F.lit(h) for h in CRAWL_HOSTS[:2]])
    return sizes.select("p_size", F.explode(hosts).alias("host")).groupBy(F.col("host").alias("origin")).agg(
        F.concat(F.lit("User-agent: *\n"), F.array_join(F.sort_array(F.collect_list(rule)), "\n")).alias("body")
    )


def detailed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose optional parts come and go with ``seq``: every page rule has several outcomes."""
    seq = F.col("seq")

    def some(condition, template: str, *values):
        return F.when(condition, F.format_string(template, *values)).otherwise("")

    lit = F.lit
    reply = F.format_string(
        '<div itemprop="comment"><span itemprop="author">Guest %d</span>'
        '<p itemprop="commentText">the same reply was sent</p></div>', seq % 3)
    second = F.format_string(
        '<div itemprop="comment"><span itemprop="author">Other</span>'
        '<p itemprop="commentText">another reply %d of NY, US company response</p>'
        '<span>Helpful %d</span></div>', seq % 5, seq % 8)
    html = F.concat(
        some(seq % 2 == 0, '<html><body><div class="breadcrumbs"><a href="/">Home</a>'
                           '<a href="/c">Cat Number %d</a></div>', seq % 4),
        some(seq % 2 == 1, '<html><body><nav class="breadcrumb"><a href="/c">Side %d</a></nav>', seq % 3),
        lit("<h1>Notes</h1><div class='complaint-main__content'>"),
        some(seq % 3 == 0, '<span itemprop="name">Shop %d</span>', seq % 6),
        some(seq % 3 == 1, '<span itemprop="name">CB</span>'),
        some(seq % 4 != 3, '<div class="complaint-main__user">Ann Lee of TX, US | user %d</div>', seq),
        lit('<p itemprop="reviewBody">'),
        F.replace(F.replace(F.col("review_text"), lit("&"), lit("&amp;")), lit("<"), lit("&lt;")), lit("</p>"),
        some(seq % 2 == 0, "<p>Desired outcome: Outcome %d</p>", seq % 5),
        some(seq % 3 != 0, "<p>Helpful %d</p>", seq % 9),
        some(seq % 4 == 0, "<p>Featured review</p>"),
        some(seq % 5 == 0, "<p>Review updated: Apr %d, 2020</p>", seq % 28 + 1),
        lit("</div>"),
        some(seq % 3 != 2, '<script type="application/ld+json">{"name": "Firm %d", '
                           '"reviewRating": {"ratingValue": "%d"}}</script>', seq % 7, seq % 6 + 1),
        F.when(seq % 3 == 0, F.concat(reply, reply, second)).when(seq % 3 == 1, F.concat(second, reply))
        .otherwise(""),
        lit("</body></html>"),
    )
    return reviews(spark, sf_dir).select("seq", F.col("raw_url").alias("url"), html.alias("html"))


def hub_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hub pages of four cards with three links each; every third hub repeats one link in its first cards."""
    doc_id = F.col("doc_id")
    hub, card = F.expr("doc_id div 12"), F.expr("doc_id div 3") % 4
    path = (
        F.when(doc_id % 11 == 0, "/login")
        .when((hub % 3 == 0) & (card < 2), "/categories/k0")
        .otherwise(F.format_string("/categories/k%d", F.col("n_chars") % 7))
    )
    text = F.when(doc_id % 13 == 0, "Go to category").otherwise("open")
    links = table(spark, sf_dir, "documents").select(
        hub.alias("hub_no"), card.alias("card"),
        F.struct("doc_id", F.concat(F.lit('<a href="'), path, F.lit('">'), text, F.lit("</a>")).alias("a")).alias("l"),
    )

    def in_order(column: str, part: str):
        return F.array_join(F.transform(F.array_sort(F.collect_list(column)), lambda x: x[part]), "")

    # Three links a card and four cards a hub.
    cards = links.groupBy("hub_no", "card").agg(
        F.concat(F.lit("<div><h2>t</h2>"), in_order("l", "a"), F.lit("</div>")).alias("html")
    )
    return cards.select("hub_no", F.struct("card", "html").alias("c")).groupBy("hub_no").agg(
        F.concat(F.lit("<html><body>"), in_order("c", "html"), F.lit("</body></html>")).alias("html")
    )
