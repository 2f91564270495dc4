"""URL rules as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxmill.config import DEFAULT_SITE, Site

# Paths that are site pages, not categories.
NON_CATEGORY_PATHS = [
    "/login", "/signup", "/about", "/contact", "/terms", "/privacy", "/faq", "/business",
]


SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"


def absolute_url(href: Column, site: Site = DEFAULT_SITE) -> Column:
    """Resolve a link, without white space around it, against the site's root."""
    h = href
    root = site.base_url.rstrip("/")
    path = F.concat(F.lit("/"), F.regexp_replace(F.regexp_extract(h, "^[^?#]*", 0), "^/", ""))
    tail = F.regexp_extract(h, r"[?#].*$", 0)
    return (
        F.when(h.rlike(SCHEME), h)
        .when(h.startswith("//"), F.concat(F.lit(root.split("//", 1)[0]), h))
        .when(h.rlike("^([?#]|$)"), F.concat(F.lit(root), h))
        .otherwise(F.concat(F.lit(root), _without_dots(path), tail))
    )


def _without_dots(path: Column) -> Column:
    """Apply ``.`` and ``..`` steps; paths without any stay as they are."""
    steps = F.split(F.concat(path, F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")), "/")
    walked = F.aggregate(
        F.slice(steps, F.lit(2), F.size(steps)),
        F.array().cast("array<string>"),
        lambda done, step: F.when(step == ".", done)
        .when(step == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.array_append(done, step)),
    )
    resolved = F.concat(F.lit("/"), F.array_join(walked, "/"))
    return F.when(path.rlike(r"/\.\.?(/|$)"), resolved).otherwise(path)


def without_query(url: Column) -> Column:
    """Drop query, fragment and the parameters of the last step."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), ";[^/]*$", "")


def url_host(url: Column) -> Column:
    """Host and port, without ``www.``."""
    netloc = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)
    return F.replace(netloc, F.lit("www."), F.lit(""))


def url_path(url: Column) -> Column:
    return F.regexp_replace(without_query(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/]*)?", "")


def is_item_url(url: Column, site: Site = DEFAULT_SITE) -> Column:
    return url_path(url).rlike("(?i)" + site.item_path)


def normalize_url(url: Column) -> Column:
    """scheme://host/path, without query, fragment and trailing slash."""
    bare = without_query(url)
    scheme = F.lower(F.regexp_extract(bare, SCHEME, 0))
    return F.rtrim(F.concat(scheme, F.regexp_replace(bare, SCHEME, "")), F.lit("/"))


def is_subcategory_url(url: Column, site: Site = DEFAULT_SITE) -> Column:
    path = F.rtrim(F.lower(url_path(url)), F.lit("/"))
    listed = ~path.isin(NON_CATEGORY_PATHS) & ~is_item_url(url, site)
    slug = listed & ~F.contains(path, F.lit(site.item_marker))
    return ~path.isin("/categories", "") & (path.startswith("/categories/") | slug)


def robots_allowed(url: Column, rules: Sequence[tuple[bool, str]]) -> Column:
    """Longest matching rule decides, allow wins a tie, no match means allowed (RFC 9309)."""
    target = F.regexp_replace(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//[^/?#]*|#.*$", "")
    target = F.when(target.startswith("/"), target).otherwise(F.concat(F.lit("/"), target))

    def best(allow: bool) -> Column:
        lengths = [
            F.when(target.rlike(robots_regex(pattern)), len(pattern)).otherwise(-1)
            for is_allow, pattern in rules
            if is_allow == allow and pattern
        ]
        return F.array_max(F.array(F.lit(-1), *lengths))

    return best(True) >= best(False)


def robots_regex(pattern: str) -> str:
    """``*`` stands for any run of characters, a final ``$`` for the end of the path."""
    anchored = pattern.endswith("$")
    special = set(r"\.[]{}()+?^|$")
    body = "".join(
        ".*" if ch == "*" else "\\" + ch if ch in special else ch
        for ch in (pattern[:-1] if anchored else pattern)
    )
    return "^" + body + ("$" if anchored else "")
