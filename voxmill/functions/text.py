"""Text rules as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxmill.functions.plain import plain_words

# All Unicode white space: Java's class leaves out the non-breaking spaces and next line.
SPACE = r"\p{javaWhitespace}\x{85}\x{a0}\x{2007}\x{202f}"
#: The same, one by one.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
    "\u200a\u2028\u2029\u202f\u205f\u3000"
)
# A word boundary with letters and digits of all scripts, whatever the regex engine's default.
_WORD = r"[\p{L}\p{N}_]"
BOUNDARY = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def trim_ws(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def collapse_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"[{SPACE}]+", " "))


def non_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def normalize_text(c: Column) -> Column:
    """Lower case, no links, only a-z and 0-9 words, single spaces."""
    lowered = F.lower(F.coalesce(c, F.lit("")))
    return plain_words(F.regexp_replace(lowered, f"http[^{SPACE}]+", " "))


def tokenize(text: str, stopwords: Sequence[str]) -> Column:
    """Runs of a-z and 0-9 longer than two characters that are not stop words.

    This and the functions below take a column's name: a long word list is cheapest as SQL text.
    """
    words = f"regexp_extract_all(lower({text}), '[a-z0-9]+', 0)"
    return _drop_stopwords(words, stopwords, longer_than=2)


def tokenize_normalized(text: str, stopwords: Sequence[str]) -> Column:
    """Same as ``tokenize`` for text that went through ``normalize_text``, with a plain split."""
    return _drop_stopwords(f"split({text}, ' ')", stopwords, longer_than=2)


def index_tokens(text: str, stopwords: Sequence[str]) -> Column:
    """Tokens of the search index: Unicode words of two or more characters, no stop words."""
    words = f"regexp_extract_all(lower({text}), r'[\\p{{L}}\\p{{N}}_]{{2,}}', 0)"
    return _drop_stopwords(words, stopwords)


def _drop_stopwords(words: str, stopwords: Sequence[str], longer_than: int = 0) -> Column:
    tests = [f"length(w) > {longer_than}"] if longer_than else []
    if stopwords:
        # The optimizer turns a long IN list into a hash lookup.
        listed = ", ".join("'" + word.replace("'", "\\'") + "'" for word in stopwords)
        tests.append(f"w NOT IN ({listed})")
    return F.expr(f"filter({words}, w -> {' AND '.join(tests) or 'true'})")


def bigrams(tokens: Column) -> Column:
    """Neighbouring pairs. Stop words are gone already, so pairs bridge them."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.zip_with(
        F.slice(tokens, F.lit(1), pairs),
        F.slice(tokens, F.lit(2), pairs),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def contains_any(lowered: Column, keywords: Sequence[str]) -> Column:
    test = F.lit(False)
    for keyword in keywords:
        test = test | F.contains(lowered, F.lit(keyword))
    return test


def keyword_hits(lowered: Column, keywords: Sequence[str]) -> Column:
    """How many different keywords occur, as substrings."""
    hits = F.lit(0)
    for keyword in dict.fromkeys(keywords):
        hits = hits + F.contains(lowered, F.lit(keyword)).cast("int")
    return hits


def extract_year(c: Column) -> Column:
    """First stand-alone 19xx or 20xx; null when there is none."""
    return F.regexp_extract(c, BOUNDARY + r"(19|20)\d{2}" + BOUNDARY, 0).try_cast("int")


def split_sentences(c: Column) -> Column:
    """Cut after . ! ? and white space; keep pieces longer than 20 characters.

    Trimming the text first leaves every piece trimmed.
    """
    pieces = F.split(trim_ws(F.coalesce(c, F.lit(""))), f"(?<=[.!?])[{SPACE}]+")
    return F.filter(pieces, lambda s: F.length(s) > 20)


def word_count(c: Column) -> Column:
    """White-space separated words; 0 for blank text."""
    return F.regexp_count(c, F.lit(f"[^{SPACE}]+"))


def ellipsis(c: Column, limit: int) -> Column:
    return F.concat(
        F.substring(c, 1, limit), F.when(F.length(c) > limit, "...").otherwise("")
    )
