"""From stored pages to review records.

``page_candidates`` runs the HTML helper over Arrow batches and returns strings and positions. All
rules on top of it are Column expressions, and a page never leaves its row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill import lexicons as lx
from voxmill import schemas
from voxmill.config import DEFAULT_SITE, Site
from voxmill.functions import text as tx
from voxmill.functions.candidates import find_review
from voxmill.functions.once import once
from voxmill.sources.shipping import ship_package

# Crumbs that name no category, month names and the way a place is given.
NON_CATEGORY_CRUMBS = ("home", "complaints", "companies", "cb")
MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec"
LOCATION = tx.BOUNDARY + r"of\s+([A-Z]{2,3}|[A-Za-z][A-Za-z\s]+)" + tx.BOUNDARY

_SPAN = schemas.struct(start=schemas.I, n=schemas.I)
_BLOCK = schemas.struct(
    text=_SPAN, block=_SPAN, author=_SPAN, date=_SPAN, date_content=schemas.S
)
_FOUND = schemas.struct(
    strings=schemas.STRINGS, body=_SPAN, box=_SPAN, title=_SPAN, h1=_SPAN, name=_SPAN,
    box_date=_SPAN, box_date_content=schemas.S, page_date=_SPAN, page_date_content=schemas.S,
    author=_SPAN, meta=_SPAN, date_block=_SPAN, rating=_SPAN, rating_content=schemas.S,
    crumbs=T.ArrayType(T.ArrayType(_SPAN)), ld_json=schemas.STRINGS,
    labelled=T.MapType(schemas.S, schemas.STRINGS), blocks=T.ArrayType(_BLOCK),
)


#: Pages that a worker holds as Python objects at a time.
SLICE = 64


def page_candidates(pages: DataFrame, keep: Sequence[str] = ("url",)) -> DataFrame:
    """Parse ``html``: the page's strings and the positions of everything the rules need."""
    return scan(pages, keep, _FOUND, find_review)


def scan(pages: DataFrame, keep: Sequence[str], found: T.StructType, find) -> DataFrame:
    """Apply ``find`` (html -> dict) to every page, next to the columns to keep."""
    from pyspark.sql.pandas.types import to_arrow_schema

    ship_package(pages.sparkSession)
    kept = pages.select(*keep, "html")
    schema = T.StructType([*[kept.schema[name] for name in keep], *found.fields])
    arrow = to_arrow_schema(schema)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):  # only a slice is held as Python objects
                rows = []
                for row in batch.slice(at, SLICE).to_pylist():
                    html = row.pop("html")
                    rows.append(row | find(html))
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)

    return kept.mapInArrow(parse, schema)


def _at(span: Column) -> Column:
    """The collapsed text at a position; null where the page has no such element."""
    return tx.collapse_ws(
        F.array_join(F.slice(F.col("strings"), span["start"] + 1, span["n"]), " ")
    )


def _group(text: Column, pattern: str, group: int = 1) -> Column:
    return tx.non_empty(F.regexp_extract(text, pattern, group))


def _in_range(raw: Column) -> Column:
    """A rating above 0 and up to 5; anything else is null."""
    number = F.when(
        raw.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), raw.try_cast("double")
    )
    return F.when((number > 0) & (number <= 5), number)


def _valid_json(c: Column) -> Column:
    return F.try_parse_json(c).isNotNull()


def page_text(found: DataFrame) -> DataFrame:
    """Add the texts that several rules share."""
    return found.withColumns({
        "_page": once(F.array_join("strings", " ")),
        "_title": once(F.coalesce(_at(F.col("title")), F.lit("unknown"))),
        "_h1": once(_at(F.col("h1"))),
        "_body": once(_at(F.col("body"))),
        "_box": F.array_join(
            F.slice(F.col("strings"), F.col("box.start") + 1, F.col("box.n")), " "
        ),
    })


def company() -> Column:
    heading = F.trim(_group(F.col("_h1"), r"(?i)^(.+?)\s+review\s*:"))
    name = tx.non_empty(_at(F.col("name")))
    ld = F.get("ld_json", F.lit(0))
    ld_name = F.when(_valid_json(ld), F.get_json_object(ld, "$.name"))
    return F.coalesce(
        heading,
        F.when(F.upper(name) != "CB", name),
        tx.non_empty(tx.collapse_ws(ld_name)),
        F.lit("unknown"),
    )


def review_date() -> Column:
    choices = []
    for where in ("box_date", "page_date"):
        choices.append(tx.non_empty(tx.trim_ws(F.col(f"{where}_content"))))
        choices.append(tx.non_empty(_at(F.col(where))))
    return F.coalesce(*choices)


def breadcrumbs() -> Column:
    texts = F.transform(
        "crumbs", lambda spans: F.filter(F.transform(spans, _at), lambda t: t != "")
    )
    found = F.filter(texts, lambda t: F.size(t) > 0)
    return F.coalesce(F.get(found, F.lit(0)), F.array().cast("array<string>"))


def category(crumbs: Column) -> Column:
    specific = F.filter(crumbs, lambda c: ~F.lower(c).isin(list(NON_CATEGORY_CRUMBS)))
    last = F.lower(F.try_element_at(specific, F.lit(-1)))
    return F.coalesce(F.replace(last, F.lit(" "), F.lit("-")), F.lit("general-complaints"))


def comment_count() -> Column:
    in_title = _group(F.col("_title"), r"(?i)\(\s*(\d+)\s*comments?\s*\)")
    in_page = _group(F.col("_page"), r"(?i)(\d+)\s+comments?")
    return F.coalesce(in_title.try_cast("int"), in_page.try_cast("int"), F.lit(0))


def helpful_count(text: Column) -> Column:
    return _group(text, r"(?i)Helpful\s+(\d+)").try_cast("int")


def labelled_field(label: str) -> Column:
    """The text after a label: next to the label's element first, then on any line of the page."""
    pattern = rf"(?is){label}\s*:?\s*(.*)$"

    def values(texts: Column) -> Column:
        after = F.transform(
            texts, lambda t: F.trim(F.regexp_extract(tx.collapse_ws(t), pattern, 1))
        )
        return F.get(F.filter(after, lambda v: v != ""), F.lit(0))

    lines = F.filter(
        F.split(F.array_join("strings", "\n"), tx.LINE_BREAK),
        lambda line: F.contains(F.lower(line), F.lit(label.lower())),
    )
    return F.coalesce(values(F.element_at("labelled", F.lit(label))), values(lines))


def reviewer() -> tuple[Column, Column]:
    """(name, location)"""
    author = _at(F.col("author"))
    meta = F.coalesce(
        tx.non_empty(_at(F.col("meta"))), tx.non_empty(_at(F.col("date_block")))
    )
    stops = r"|\s*".join(MONTHS.split())
    by_meta = _group(
        meta, rf"^([A-Za-z][A-Za-z .'-]+?)(?:\s+of\s+[A-Z]{{2,3}}|\s*\||\s*{stops})"
    )
    name = F.coalesce(tx.non_empty(author), F.trim(by_meta), author)
    return name, F.trim(_group(meta, LOCATION))


def updated_date() -> Column:
    return _group(
        F.col("_page"), r"(?i)Review updated:\s*([A-Za-z]{3,9}\s+\d{1,2},\s+\d{4})"
    )


def comments() -> Column:
    """Comments of the page: blocks with enough text, the first of those with the same id."""

    def parsed(b: Column) -> Column:
        own, whole = F.coalesce(_at(b["text"]), F.lit("")), _at(b["block"])
        posted = F.when(
            b["date"].isNotNull(),
            F.coalesce(tx.non_empty(tx.trim_ws(b["date_content"])), _at(b["date"])),
        )
        return F.struct(
            F.when(F.length(own) >= 8, own).when(F.length(whole) >= 12, whole).alias("text"),
            _at(b["author"]).alias("author"), posted.alias("posted"),
            helpful_count(whole).alias("helpful"),
        )

    def record(c: Column) -> Column:
        none = F.lit("None")
        source = F.concat_ws(
            "|", F.coalesce(c["author"], none), F.coalesce(c["posted"], none),
            F.substring(c["text"], 1, 120),
        )
        return F.struct(
            F.md5(source).alias("comment_id"), c["author"].alias("author_name"),
            F.trim(_group(c["text"], LOCATION)).alias("author_location"),
            c["posted"].alias("posted_at"), c["text"].alias("text"),
            c["helpful"].alias("helpful_count"),
            F.contains(F.lower(c["text"]), F.lit("company response"))
            .alias("is_company_response"),
        )

    enough = F.filter(F.transform("blocks", parsed), lambda c: c["text"].isNotNull())
    return F.transform(enough, record)


def first_of_each(records: Column, ids: Column) -> Column:
    return F.filter(
        records, lambda c, i: F.array_position(ids, c["comment_id"]) == i + 1
    ).cast(schemas.COMMENTS)


def rating() -> Column:
    tag = _in_range(tx.trim_ws(F.coalesce(tx.non_empty(F.col("rating_content")),
                                          _at(F.col("rating")))))

    def items(ld: Column) -> Column:
        many = F.from_json(ld, "array<string>")
        whole = F.when(F.ltrim(ld).startswith("["), many).otherwise(F.array(ld))
        return F.when(_valid_json(ld), whole).otherwise(F.array().cast("array<string>"))

    def value(item: Column) -> Column:
        own = F.get_json_object(item, "$.reviewRating")
        own = F.when(~own.isin("", "{}", "[]", "0", "false"), own)
        block = F.coalesce(own, F.get_json_object(item, "$.aggregateRating"))
        return _in_range(F.trim(F.get_json_object(block, "$.ratingValue")))

    listed = F.array_compact(F.transform(F.flatten(F.transform("ld_json", items)), value))
    return F.coalesce(tag, F.get(listed, F.lit(0)))


def review_records(
    found: DataFrame, keep: Sequence[str] = (), site: Site = DEFAULT_SITE
) -> DataFrame:
    """Records of the pages that have a review body, in the raw schema."""
    return extracted(found, keep, site).where("has_body").drop("has_body")


def extracted(
    found: DataFrame, keep: Sequence[str] = (), site: Site = DEFAULT_SITE
) -> DataFrame:
    """One row per page in the raw schema, with ``has_body``.

    ``found`` comes from ``page_candidates``; ``discovery_source`` may be one of its columns.
    """
    if "discovery_source" not in found.columns:
        found = found.withColumn("discovery_source", F.lit("unknown"))
    name, location = reviewer()
    staged = page_text(found).withColumns({
        "_crumbs": once(breadcrumbs()),
        "_comments": once(comments()),
        "_desired": once(labelled_field("Desired outcome")),
        "_date": once(review_date()),
        "_updated": once(updated_date()),
    })
    staged = staged.withColumn(
        "_comments",
        once(first_of_each(
            F.col("_comments"), F.transform("_comments", lambda c: c["comment_id"])
        )),
    )
    full = F.concat_ws(
        " ", F.array(F.col("_body"), F.col("_desired")),
        F.transform("_comments", lambda c: c["text"]),
    )
    staged = staged.withColumn("_full", once(tx.collapse_ws(full)))
    staged = staged.withColumn("_lower", once(F.lower("_full")))
    hits = tx.keyword_hits(F.col("_lower"), lx.PAGE_FOCUS_KEYWORDS)
    columns = {
        "record_id": F.md5("url"),
        "source": F.lit(site.name),
        "company": company(),
        "category": category(F.col("_crumbs")),
        "breadcrumbs": F.col("_crumbs"),
        "title": F.col("_title"),
        "review_text": F.col("_body"),
        "review_date": F.col("_date"),
        "review_updated_date": F.col("_updated"),
        "reviewer_name": name,
        "reviewer_location": location,
        "rating": rating(),
        "comment_count": comment_count(),
        "helpful_count": helpful_count(F.col("_box")),
        "claimed_loss": labelled_field("Claimed loss"),
        "desired_outcome": F.col("_desired"),
        "is_featured_review": F.contains(F.lower("_page"), F.lit("featured review")),
        "comments": F.col("_comments"),
        "full_text_with_comments": F.col("_full"),
        "has_return_mention": tx.contains_any(F.col("_lower"), lx.PAGE_RETURN_KEYWORDS),
        "has_warranty_mention": tx.contains_any(F.col("_lower"), lx.PAGE_WARRANTY_KEYWORDS),
        "is_warranty_return_relevant": hits > 0,
        "relevance_score": hits,
        "raw_url": F.col("url"),
        "discovery_source": F.col("discovery_source"),
        "scraped_at": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
    }
    return staged.select(
        *keep, F.col("body").isNotNull().alias("has_body"),
        *[c.alias(n) for n, c in columns.items()],
    )
