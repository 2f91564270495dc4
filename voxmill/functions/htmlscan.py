"""The one thing SQL cannot do here: find where elements start and end in messy HTML.

``outline`` turns a page into its visible strings and a list of elements, each with the range of
strings and of elements inside it. Rules about the text are Column expressions elsewhere.
"""

from __future__ import annotations

from dataclasses import dataclass
from html.parser import HTMLParser

# Fixed values of HTML: elements without content, and elements whose text is not page text.
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen link "
    "menuitem meta nextid param source spacer track wbr".split()
)
UNSEEN = frozenset("script style template rt rp".split())


@dataclass(slots=True)
class Element:
    tag: str
    attrs: dict
    parent: int  # index of the parent element, -1 for the page itself
    first: int  # range of visible strings inside
    last: int = 0
    end: int = 0  # elements from this one's index up to here are inside it

    def has_class(self, name: str) -> bool:
        return name in (self.attrs.get("class") or "").split()


class Outline(HTMLParser):
    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.strings: list[str] = []
        self.elements: list[Element] = []
        self.nodes: list[tuple[str, int]] = []  # every string, unseen ones too, with its parent
        self.unseen_text: dict[int, str] = {}
        self._open = [-1]
        self._open_tags: dict[str, int] = {}  # how many elements of each name are open
        self._unseen = 0
        self._pending: list[str] = []
        self.feed(html)
        self.close()
        self._flush()
        while len(self._open) > 1:
            self._shut()

    def _flush(self, seen: bool = True) -> None:
        text, self._pending = "".join(self._pending), []
        if not text:
            return
        at = self._open[-1]
        self.nodes.append((text, at))
        if seen and not self._unseen:
            if text.strip():
                self.strings.append(text.strip())
        elif seen:
            self.unseen_text[at] = self.unseen_text.get(at, "") + text

    def _shut(self) -> None:
        element = self.elements[self._open.pop()]
        element.last, element.end = len(self.strings), len(self.elements)
        self._open_tags[element.tag] -= 1
        self._unseen -= element.tag in UNSEEN

    def handle_starttag(self, tag, attrs):
        self._flush()
        attrs = {k: v or "" for k, v in attrs}
        self.elements.append(Element(tag, attrs, self._open[-1], len(self.strings)))
        self._open.append(len(self.elements) - 1)
        self._open_tags[tag] = self._open_tags.get(tag, 0) + 1
        self._unseen += tag in UNSEEN
        if tag in VOID:
            self._shut()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._shut()

    def handle_endtag(self, tag):
        self._flush()
        if self._open_tags.get(tag):
            while self.elements[self._open[-1]].tag != tag:
                self._shut()
            self._shut()

    def handle_data(self, data):
        self._pending.append(data)

    def handle_comment(self, data):
        self._flush()
        self._pending.append(data)
        self._flush(seen=False)

    def handle_decl(self, decl):
        self._flush()

    unknown_decl = handle_pi = handle_decl

    # Queries. ``scope`` is an element index, -1 for the whole page.

    def inside(self, scope: int) -> range:
        return range(scope + 1, len(self.elements) if scope < 0 else self.elements[scope].end)

    def all(self, test, scope: int = -1) -> list[int]:
        return [i for i in self.inside(scope) if test(self.elements[i])]

    def one(self, *tests, scopes=(-1,)) -> int | None:
        """First element for the first test that finds any; each test tries every scope in turn."""
        for test in tests:
            for scope in scopes:
                for i in self.inside(scope):
                    if test(self.elements[i]):
                        return i
        return None

    def within(self, outer, inner) -> list[int]:
        """Elements that pass ``inner`` below one that passes ``outer``, in page order."""
        found = set()
        for i in self.all(outer):
            found.update(self.all(inner, i))
        return sorted(found)

    def ancestor(self, i: int, test) -> int | None:
        i = self.elements[i].parent
        while i >= 0 and not test(self.elements[i]):
            i = self.elements[i].parent
        return i if i >= 0 else None

    def span(self, i: int | None):
        if i is None:
            return None
        if i < 0:
            return {"start": 0, "n": len(self.strings)}
        e = self.elements[i]
        return {"start": e.first, "n": e.last - e.first}

    def text(self, i: int) -> str:
        if i in self.unseen_text:
            return self.unseen_text[i].strip()
        at = self.span(i)
        return " ".join(self.strings[at["start"]:at["start"] + at["n"]])


def prop(name: str, tag: str | None = None):
    return lambda e: e.attrs.get("itemprop") == name and tag in (None, e.tag)


def cls(name: str, tag: str | None = None):
    return lambda e: e.has_class(name) and tag in (None, e.tag)


def tags(*names: str):
    return lambda e: e.tag in names


def either(*tests):
    return lambda e: any(test(e) for test in tests)


def link(e: Element) -> bool:
    return e.tag == "a" and "href" in e.attrs
