"""Benchmark decontamination: one Aho-Corasick automaton over the normalised test texts.

Normalised text: ``A-Z`` lower-cased, words are runs of digits, ``a-z`` and non-ASCII characters,
joined by one space. Each window of ten consecutive item words is a pattern with a space on either
side; an item with fewer words is one pattern. A document is scanned once, and word numbers lead
back to the offsets of its own text.

Null and empty texts have no words and no hits. Items without words are ignored. Repeated items
and repeated rows count each on their own; null item ids never appear in a result.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill.llm.rows import map_slices

WINDOW = 10
#: Bytes of patterns in one automaton. More benchmark text means more automata, built one after
#: another in the same task, so that memory stays bounded for any benchmark.
AUTOMATON_BYTES = 32 * 1024 * 1024

_WORD_BYTES = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b in _WORD_BYTES else 0x20 for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("item_ids", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    ]))),
])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TABLE).split()


def patterns_of(items: list[tuple], window: int) -> dict[str, tuple[int, tuple[str, ...]]]:
    """pattern -> (its number of words, ids of the items that hold it)"""
    found: dict[str, tuple[int, set]] = {}
    for item_id, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for at in range(len(words) - size + 1 if size else 0):
            key = f" {b' '.join(words[at:at + size]).decode('latin-1')} "
            ids = found.setdefault(key, (size, set()))[1]
            if item_id is not None:
                ids.add(str(item_id))
    return {k: (n, tuple(sorted(ids))) for k, (n, ids) in found.items()}


def parts_of(patterns: dict, limit: int) -> list[list[tuple]]:
    parts, size = [[]], 0
    for key, value in patterns.items():
        if size + len(key) > limit and parts[-1]:
            parts.append([])
            size = 0
        parts[-1].append((key, *value))
        size += len(key)
    return parts


@lru_cache(maxsize=1)
def _automaton(shared, part: int):
    made = ahocorasick.Automaton()
    for key, size, ids in shared.value[part]:
        made.add_word(key, (size, ids))
    if len(made):
        made.make_automaton()
    return made


def scan(texts: list[str | None], automata) -> list[tuple]:
    """(n_words, n_hit, item ids, spans) for each text; spans are code point offsets."""
    found: list[dict] = [{} for _ in texts]
    words = [words_of(t) for t in texts]
    lines = [f" {b' '.join(w).decode('latin-1')} " for w in words]
    for automaton in automata:
        if not len(automaton):
            continue
        for line, mine in zip(lines, found):
            for end, (size, ids) in automaton.iter(line):
                mine.setdefault(end, []).append((size, ids))
    return [
        _hits(text, own, line, mine) if mine else (len(own), 0, [], [])
        for text, own, line, mine in zip(texts, words, lines, found)
    ]


def _hits(text: str, words: list[bytes], line: str, matches: dict) -> tuple:
    # The space at offset e of the line ends word number (spaces before e) - 1.
    spaces = np.cumsum(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    change = np.zeros(len(words) + 1, np.int64)
    ids: set[str] = set()
    for end, several in matches.items():
        last = int(spaces[end]) - 1
        for size, names in several:
            change[last - size] += 1
            change[last] -= 1
            ids.update(names)
    hit = np.cumsum(change[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    raw = text.encode("utf-8", "surrogatepass")
    places = [m.span() for m in _WORD.finditer(raw.translate(_TABLE))]
    points = np.concatenate(
        ([0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80))
    )  # code points before each byte
    spans = [
        {"start": int(points[places[a][0]]), "end": int(points[places[b - 1][1]])}
        for a, b in zip(edges[::2], edges[1::2])
    ]
    return len(words), int(hit.sum()), sorted(ids), spans


def find_leaks(
    docs: DataFrame, items: DataFrame, keep: list[str], *, text: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Columns ``keep`` of every row of ``docs`` plus ``n_words, n_hit, item_ids, spans``.

    No shuffle: the patterns go to the tasks as a broadcast variable. They grow with the benchmark
    only, never with the documents; above ``automaton_bytes`` they are scanned part by part.
    """
    context = docs.sparkSession.sparkContext
    rows = [tuple(r) for r in items.select(item_id, item_text).toLocalIterator()]
    parts = parts_of(patterns_of(rows, window), automaton_bytes)
    shared = context.broadcast(parts)
    count = len(parts)

    def work(*columns):
        hits = scan(columns[-1], (_automaton(shared, i) for i in range(count)))
        yield from (left + hit for left, hit in zip(zip(*columns[:-1]), hits))

    fields = [docs.schema[c] for c in keep]
    inner = [T.StructField(f"_{i}", f.dataType) for i, f in enumerate(fields)]
    picked = docs.select(
        *(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col(text).alias("_text")
    )
    out = map_slices(picked, T.StructType([*inner, *HITS.fields]), work)
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), *HITS.names)


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    found = find_leaks(docs, items, ["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with all their columns."""
    return find_leaks(docs, items, docs.columns).where("n_hit = 0").select(docs.columns)


ORACLE = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
pats AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
         array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS pat
  FROM iw, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS r(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM pats),
wins AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS pat
  FROM dw, sizes, unnest(range(1, len(w) - size + 2)) AS r(i)),
hits AS (SELECT doc_id, i, wins.size, item_id FROM wins JOIN pats USING (pat)
         WHERE wins.size = pats.size),
words AS (SELECT doc_id, count(DISTINCT k) AS n FROM
          (SELECT DISTINCT doc_id, i, size FROM hits), unnest(range(i, i + size)) AS r(k)
          GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS s FROM
        (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
