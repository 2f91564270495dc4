"""Where a review page keeps what: runs in the Python workers, on top of the HTML helper."""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from voxmill.functions import htmlscan as hs

# Labels and class names of the pages, most specific place first.
LABELS = ("Claimed loss", "Desired outcome")
CONTAINER_CLASS = "complaint-main__content"
TITLE_CLASS = "complaint-main__header-name"
META_CLASSES = (
    "complaint-main__user", "complaint-main__info", "review-author", "complaint-author",
)


def find_review(html: str) -> dict:
    page = hs.Outline(html or "")
    h1 = page.one(hs.tags("h1"))
    found = {"strings": page.strings, "h1": page.span(h1)}
    body = page.one(hs.prop("reviewBody"))
    if body is None:
        return found
    box = page.ancestor(body, hs.cls(CONTAINER_CLASS))
    box = page.elements[body].parent if box is None else box
    both = (box, -1)
    title = page.one(hs.cls(TITLE_CLASS), scopes=(box,))
    dates = hs.prop("datePublished")
    box_date, page_date = page.one(dates, scopes=(box,)), page.one(dates)
    near_date = page_date if box_date is None else box_date
    rating = page.one(hs.prop("ratingValue"), scopes=both)
    json_scripts = page.all(
        lambda e: e.tag == "script" and e.attrs.get("type") == "application/ld+json"
    )
    crumb_lists = (
        page.within(hs.cls("breadcrumbs"), hs.link),
        page.within(hs.cls("breadcrumb", "nav"), hs.link),
        page.within(hs.prop("breadcrumb"), hs.link),
    )

    def content(i):
        return None if i is None else page.elements[i].attrs.get("content")

    return found | {
        "body": page.span(body),
        "box": page.span(box),
        "title": page.span(h1 if title is None else title),
        "name": page.span(page.one(hs.prop("name", "span"))),
        "box_date": page.span(box_date),
        "box_date_content": content(box_date),
        "page_date": page.span(page_date),
        "page_date_content": content(page_date),
        "author": page.span(page.one(hs.prop("author"), scopes=both)),
        "meta": page.span(page.one(*[hs.cls(c) for c in META_CLASSES], scopes=both)),
        "date_block": None if near_date is None else page.span(page.elements[near_date].parent),
        "rating": page.span(rating),
        "rating_content": content(rating),
        "crumbs": [[page.span(i) for i in crumbs] for crumbs in crumb_lists],
        "ld_json": [page.unseen_text.get(i, "") for i in json_scripts],
        "labelled": [
            (label, [page.text(at) for text, at in page.nodes if label.lower() in text.lower()])
            for label in LABELS
        ],
        "blocks": [_comment(page, i) for i in _comment_blocks(page)],
    }


def _comment_blocks(page: hs.Outline) -> list[int]:
    in_list = page.within(hs.cls("comments-list"), hs.cls("comment"))
    in_other = page.within(hs.cls("comment-list"), hs.cls("comment"))
    blocks = [
        *page.all(hs.prop("comment")), *page.all(hs.cls("complaint-comment")),
        *page.all(hs.cls("comment-item")), *in_list, *in_other,
        *page.all(hs.cls("comment", "article")), *page.all(hs.cls("comment-block")),
    ]
    if blocks:
        return blocks
    at = next((at for text, at in page.nodes if "comment" in text.lower()), -1)
    if at >= 0:
        holder = hs.tags("section", "div", "article")
        section = at if holder(page.elements[at]) else page.ancestor(at, holder)
        if section is not None:
            test = hs.either(hs.tags("article", "li"), hs.cls("comment"), hs.cls("reply"))
            return page.all(test, section)
    return []


def _comment(page: hs.Outline, block: int) -> dict:
    here = (block,)
    text = page.one(hs.prop("commentText"), hs.cls("comment-text"), hs.cls("comment-body"),
                    hs.tags("p"), scopes=here)
    author = page.one(hs.prop("author"), hs.cls("comment-author"), scopes=here)
    date = page.one(hs.prop("datePublished"), hs.tags("time"), scopes=here)
    return {
        "text": page.span(text), "block": page.span(block), "author": page.span(author),
        "date": page.span(date),
        "date_content": None if date is None else page.elements[date].attrs.get("content", ""),
    }


def find_links(html: str) -> dict:
    """Every anchor with a link, in page order, and the cards: blocks with a heading and two links.

    A card's anchors are neighbours in page order, so a card is a range of anchors.
    """
    page = hs.Outline(html or "")
    anchors = page.all(hs.link)
    headings = page.all(hs.either(hs.tags("h2", "h3", "strong"), hs.cls("h3")))
    cards = []
    for block in page.all(hs.tags("section", "article", "div")):
        end = page.elements[block].end
        start = bisect_right(anchors, block)
        n = bisect_left(anchors, end) - start
        if n >= 2 and bisect_right(headings, block) < bisect_left(headings, end):
            cards.append({"start": start, "n": n})
    return {
        "anchors": [
            {"href": page.elements[i].attrs["href"], "text": page.text(i)} for i in anchors
        ],
        "cards": cards,
    }
