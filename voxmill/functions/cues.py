"""Which cues stand in texts, as substrings: looked up in the Python workers, where a search costs least."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from voxmill.sources.shipping import ship_package

SLICE_ROWS = 256


def values(column: pa.Array) -> Iterator:
    """The values of ``column``; few of them are Python objects at a time."""
    for at in range(0, len(column), SLICE_ROWS):
        yield from column.slice(at, SLICE_ROWS).to_pylist()


def hits(lowered: Column, *lists: Sequence[str]) -> Column:
    """How many different keywords of each of ``lists`` occur, as an array; null for a null text."""
    ship_package(SparkSession.active())
    wanted = [tuple(dict.fromkeys(keywords)) for keywords in lists]

    def count(texts: pa.Array) -> pa.Array:
        return pa.array(
            [None if t is None else [sum([k in t for k in ks]) for ks in wanted] for t in values(texts)],
            pa.list_(pa.int32()),
        )

    return F.arrow_udf(count, "array<int>")(lowered)


def found(texts: Column, *lists: Sequence[str]) -> Column:
    """Whether any keyword of each of ``lists`` occurs, as an array; null for a null text."""
    ship_package(SparkSession.active())
    # A keyword that holds another one of its list tells nothing more.
    wanted = [
        tuple(k.encode() for k in dict.fromkeys(keywords) if not any(o in k for o in keywords if o != k))
        for keywords in lists
    ]

    def look(column: pa.Array) -> pa.Array:
        return pa.array(
            [None if t is None else [any(k in t for k in ks) for ks in wanted] for t in values(column.cast(pa.binary()))],
            pa.list_(pa.bool_()),
        )

    return F.arrow_udf(look, "array<boolean>")(texts)


def sentence_ranks(lowered: Column, focus_terms: Sequence[str]) -> Column:
    """For each sentence of an array minus its points: two a focus term, one per ten of its first 40 words.

    ``str.split`` cuts at the white space of ``text.SPACE``.
    """
    ship_package(SparkSession.active())
    terms = tuple(dict.fromkeys(focus_terms))

    def rank(sentence: str | None) -> int | None:
        if sentence is None:
            return None
        return -(2 * sum([t in sentence for t in terms]) + min(len(sentence.split()), 40) // 10)

    def ranks(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else [rank(s) for s in t] for t in values(texts)], pa.list_(pa.int32()))

    return F.arrow_udf(ranks, "array<int>")(lowered)
