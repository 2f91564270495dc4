"""Main text of web pages by equivalence classes of template tokens.

A token is an element's place in the page (its path of names, classes and ids; words with digits and the ids
of articles belong to a page and are left out). Pages of one host are
compared by occurrence vectors: how often a token occurs on each page. Tokens with the same vector
form a class; vectors are compared by an additive hash, so a host with any number of pages needs
one small sum per token and task. A class is valid if at least ``SUPPORT`` of the host's pages hold it (and
two, if the host has two), any number of times, and it has two tokens or a named one (``article``, ``main``).
The valid classes nest by path. Their elements are slots: the named ones, and those that hold most of the
unlinked text of the pages that have them. A host with several layouts, or with optional parts, has
slots of several classes. A page is cut at the best slot that it has itself: a named one, the outermost first,
else the deepest. Elements that are never part of an article are left out, and the blocks of text remain.

Null and empty html gives an empty text. A null URL, or a URL without host, counts as the host ''.
A page that lacks its host's slots, or has none below ``body``, falls back on its own ``article``, ``main`` or ``body``.
"""

from __future__ import annotations

import html as entities
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill.llm.rows import map_slices
from voxmill.llm.url_filter import host_and_path
from voxmill.sources.staging import stage

#: Bytes of the hosts' slots that may be broadcast. More are joined.
BROADCAST_BYTES = 32_000_000
#: Share of a host's pages that must hold a class.
SUPPORT = 0.05
#: Elements that can be a slot without a name; paragraphs, lists and headings are parts of an article.
_CONTAINERS = "html|body|div|section|td|center|fieldset|details"
#: Share of the unlinked text that a slot without a name must hold.
DENSE = 0.7

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?>[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)>|<[!?][^>]*>", re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_RAW = {
    name: re.compile(rf"</{name}\s*>", re.I)
    for name in ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math")
}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section "
    "summary table tbody td tfoot th thead tr ul head".split()
)
#: A start tag on the left ends an open element on the right, within the nearest barrier.
_ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "option": {"option"},
}
_BARRIER = frozenset("ul ol dl table body article section div main td th".split())
_NOISE_TAGS = frozenset(
    "nav header footer aside form menu dialog button select option label input script style noscript template "
    "textarea iframe svg math head title object".split()
)
_NOISE_WORDS = frozenset(
    "nav navbar navigation menu sidebar footer ad ads advert adverts advertisement advertising sponsor sponsored promo "
    "promotion banner cookie cookies consent notice gdpr comment comments disqus respond share sharing "
    "social newsletter subscribe subscription signup login breadcrumb breadcrumbs related recommended "
    "popup modal overlay widget pagination toolbar masthead skip".split()
)
_MAIN_ROLES = frozenset({"main", "articlebody"})
_WORDS = re.compile(r"[a-z]+")
_DIGIT = re.compile(r"\d")

Node = tuple  # (path, noise, in_link)


def _name(tag: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """(step of the path, noise by tag or role, noise by a class or id, whether it is a named main element)"""
    noise, soft, main, label = tag in _NOISE_TAGS, False, tag in ("article", "main"), ""
    if attributes:
        for kind, a, b, c in _ATTRIBUTE.findall(attributes):
            value = (a or b or c).lower()
            if kind.lower() in ("class", "id"):
                if kind.lower() == "class" or tag not in ("article", "main"):
                    label += "".join("." + w for w in value.split() if not _DIGIT.search(w))
                soft = soft or not _NOISE_WORDS.isdisjoint(_WORDS.findall(value))
            else:
                main = main or value in _MAIN_ROLES
                noise = noise or value in ("navigation", "banner", "complementary", "contentinfo", "search")
    return tag + label, noise, soft and not main and tag not in ("html", "body"), main


def walk(html: str, free: frozenset = frozenset(), root: str | None = None):
    """Events in page order: ("open", path, noise, main, softs, hard), ("text", path, noise, in_link, raw,
    softs, hard), ("break",). ``softs``: places of the elements around that are noise by a class word only;
    those in ``free`` are not noise. ``hard``: within noise by tag or role. Noise is judged below ``root``.
    """
    stack: list[tuple] = []  # tag, path, noise, main, link, softs, hard
    top = ("", "", False, False, False, (), False)
    at, size = 0, len(html)
    find = _TAG.search
    while at < size:
        m = find(html, at)
        start = m.start() if m else size
        if start > at:
            _, path, noise, _, link, softs, hard = stack[-1] if stack else top
            yield "text", path, noise, link, html[at:start], softs, hard
        if not m:
            return
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:  # end tag
            if tag in _BLOCK:
                yield ("break",)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if tag not in _BLOCK and stack[i][0] in _BLOCK:
                    break
            continue
        if tag == "br":
            _, path, noise, _, link, softs, hard = stack[-1] if stack else top
            yield "text", path, noise, link, " ", softs, hard
            continue
        if tag in _BLOCK:
            yield ("break",)
            if tag not in ("td", "th", "tr"):
                for i in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph
                    if stack[i][0] == "p":
                        del stack[i:]
                        break
                    if stack[i][0] in _BLOCK:
                        break
            ends = _ENDS.get(tag)
            if ends:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] in ends:
                        del stack[i:]
                        break
                    if stack[i][0] in _BARRIER:
                        break
        attributes = m[3] if m[3] is not None else m[6] or ""
        step, own_hard, own_soft, main = _name(tag, attributes)
        above = stack[-1] if stack else top
        path = f"{above[1]}>{step}" if tag in _BLOCK else above[1]
        softs = (*above[5], at) if own_soft else above[5]
        hard = own_hard or above[6]
        noise = own_hard or own_soft and at not in free or above[2]
        if tag in _BLOCK and path == root:
            noise = False
        yield "open", path if tag in _BLOCK else "", noise, main, softs, hard
        if tag in _VOID:
            continue
        if tag in _RAW:
            closed = _RAW[tag].search(html, at)
            at = closed.end() if closed else size
            continue
        if not attributes.endswith("/"):
            stack.append((tag, path, noise, main or above[3], above[4] or tag == "a", softs, hard))


def wrappers(html: str) -> frozenset:
    """Places of elements whose class word tells a state of the page, not noise: those around the named main
    element that has the fewest of them, else those that hold nine tenths of the unlinked text."""
    around, held, total = None, {}, 0
    for event in walk(html):
        if event[0] == "break" or event[-1]:
            continue
        if event[0] == "open":
            if event[3] and (around is None or len(event[4]) < len(around)):
                around = event[4]
        elif not event[3]:
            size = len(event[4].strip())
            total += size
            for place in event[5]:
                held[place] = held.get(place, 0) + size
    if around is not None:
        return frozenset(around)
    return frozenset(place for place, size in held.items() if size * 10 >= total * 9)


TOKENS = T.StructType([
    T.StructField("host", T.StringType()), T.StructField("page", T.LongType()),
    T.StructField("path", T.StringType()), T.StructField("times", T.LongType()),
    T.StructField("main", T.BooleanType()), T.StructField("noise", T.BooleanType()),
    T.StructField("chars", T.LongType()), T.StructField("all_chars", T.LongType()),
])


def tokens_of(html: str) -> dict[str, list]:
    """path -> [times, named main, noise, characters of unlinked text inside]"""
    found: dict[str, list] = {}
    for event in walk(html, wrappers(html)):
        if event[0] == "open" and event[1]:
            own = found.setdefault(event[1], [0, event[3], event[2], 0])
            own[0] += 1
        elif event[0] == "text" and not event[2] and not event[3]:
            size, path = len(event[4]), event[1]
            while path:
                if path in found:
                    found[path][3] += size
                path = path.rpartition(">")[0]
    return found


def templates(pages: DataFrame) -> DataFrame:
    """host, tokens: the paths of the host's valid classes. ``pages``: host, page, html."""
    def work(hosts, keys, texts):
        for host, page, text in zip(hosts, keys, texts):
            tokens = tokens_of(text or "")
            whole = max((t[3] for t in tokens.values()), default=0)
            for path, (times, main, noise, chars) in tokens.items():
                yield host, page, path, times, main, noise, chars, whole

    tokens = map_slices(pages.select("host", "page", "html"), TOKENS, work)
    vectors = stage(
        tokens.groupBy("host", "path").agg(
            F.count("*").alias("pages"), F.sum("times").alias("times"),
            F.sum(F.pmod(F.xxhash64("page", "times"), F.lit(1 << 31))).alias("vector"),
            F.max("main").alias("main"), F.sum("chars").alias("chars"), F.sum("all_chars").alias("all_chars"),
            (F.count_if("noise") * 2 > F.count("*")).alias("noise"),
        ),
        "html-vectors",
    )
    totals = vectors.groupBy("host").agg(F.max("pages").alias("of"))
    enough = F.greatest(F.least(F.lit(2), F.col("of")), F.ceil(F.col("of") * SUPPORT))
    classes = (
        vectors.join(totals, "host")
        .where(F.col("pages") >= enough)
        .groupBy("host", "vector")
        .agg(F.collect_list(F.struct("path", "main", "noise", "chars", "all_chars")).alias("tokens"))
        .where((F.size("tokens") >= 2) | F.exists("tokens", lambda t: t["main"]))
    )
    # bounded: as each token is on a share of the pages, there are 1 / SUPPORT times those of a page
    return classes.groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("tokens"))


def main_slots(found: DataFrame) -> DataFrame:
    """host, main: the paths of the elements that may hold the article, best first."""
    useful = F.filter("tokens", lambda t: ~t["noise"])
    depth = lambda t: F.size(F.split(t["path"], ">"))
    named = F.array_sort(F.transform(
        F.filter(useful, lambda t: t["main"]),
        lambda t: F.struct(depth(t).alias("depth"), (-t["chars"]).alias("less"), t["path"].alias("path")),
    ))
    dense = F.array_sort(F.transform(
        F.filter(
            useful, lambda t: ~t["main"] & t["path"].rlike(f">({_CONTAINERS})(\\.[^>]*)?$")
            & (t["chars"] >= t["all_chars"] * DENSE) & (t["chars"] > 0),
        ),
        lambda t: F.struct((-depth(t)).alias("deep"), (-t["chars"]).alias("less"), t["path"].alias("path")),
    ))
    return found.select("host", F.concat(named["path"], dense["path"]).alias("main"))


def _blocks(html: str, free: frozenset, root: str | None) -> list[str]:
    """Blocks of text under ``root``, or of the whole page."""
    blocks, parts = [], []
    under = None if root is None else root + ">"
    for event in walk(html, free, root):
        if event[0] == "text":
            if not event[2] and (root is None or event[1] == root or event[1].startswith(under)):
                parts.append(event[4])
        elif event[0] == "break" and parts:
            blocks.append("".join(parts))
            parts = []
    blocks.append("".join(parts))
    plain = (" ".join(entities.unescape(b).split()) for b in blocks)
    return [b for b in plain if b]


def main_text(html: str | None, slots: list[str] | None) -> str:
    """Blocks of the first of ``slots`` that the page has, joined by an empty line."""
    if not html:
        return ""
    free = wrappers(html)
    opened = [e for e in walk(html, free) if e[0] == "open" and e[1]]
    held, named = {e[1] for e in opened}, {e[1] for e in opened if e[3] and not e[2]}
    main = next((p for p in slots or () if p in held), None)
    own = min(named, key=lambda p: (p.count(">"), p), default=None)
    step = main.rpartition(">")[2].partition(".")[0] if main else None
    if own is not None and step in ("html", "body"):
        main = own
    blocks = [] if main is None else _blocks(html, free, main)
    if not blocks and (own != main or own is None):
        blocks = _blocks(html, free, own)
    return "\n\n".join(blocks)


def extract(pages: DataFrame, keep: list[str], url: str = "url", html: str = "html") -> DataFrame:
    """Columns ``keep`` plus ``text``: the main text of every page."""
    host, _ = host_and_path(F.col(url))
    rows = pages.select(
        *(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), host.alias("host"), F.col(html).alias("html")
    )
    keys = pages.select(host.alias("host"), F.xxhash64(*keep, F.col(url)).alias("page"), F.col(html).alias("html"))
    slots = stage(main_slots(templates(keys)), "html-slots")
    size = F.octet_length(F.concat_ws("", "main")) + F.octet_length("host") + 64
    few = (slots.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES
    joined = rows.join(F.broadcast(slots) if few else slots, "host", "left")
    inner = [T.StructField(f"_{i}", pages.schema[c].dataType) for i, c in enumerate(keep)]

    def work(*columns):
        for *left, source, main in zip(*columns):
            yield (*left, main_text(source, main))

    out = map_slices(
        joined.select(*(f.name for f in inner), "html", "main"),
        T.StructType([*inner, T.StructField("text", T.StringType())]), work,
    )
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "text")


def query(pages: DataFrame) -> DataFrame:
    return extract(pages, ["page_id", "url"]).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )
