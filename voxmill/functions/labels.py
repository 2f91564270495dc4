"""Issue labels, scores and sentences derived from labels, as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxmill import lexicons as lx
from voxmill.functions import cues
from voxmill.functions import text as tx


def issue_labels(lowered: Column, taxonomy: Mapping[str, Sequence[str]] = lx.ISSUE_TAXONOMY):
    """Every label one of whose keywords occurs, in taxonomy order; ``other`` when none does."""
    any_of = cues.found(lowered, *taxonomy.values())
    found = F.array_compact(
        F.array(*[F.when(F.get(any_of, F.lit(i)), F.lit(lb)) for i, lb in enumerate(taxonomy)])
    )
    return F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(lx.OTHER_LABEL)))


def primary_label(labels: Column) -> Column:
    return F.coalesce(F.get(labels, F.lit(0)), F.lit(lx.OTHER_LABEL))


def root_cause(labels: Column, causes: Mapping[str, str] = lx.ROOT_CAUSES) -> Column:
    first = [F.when(F.array_contains(labels, lb), F.lit(text)) for lb, text in causes.items()]
    return F.coalesce(*first, F.lit(lx.ROOT_CAUSE_DEFAULT))


def reliability_score(rating: Column, labels: Column) -> Column:
    """100 minus penalties for a low rating, many labels, and two serious labels; 0 to 100."""
    low_rating = F.greatest(F.lit(0.0), (F.lit(5.0) - rating.cast("double")) * 12)
    many_labels = F.least(F.lit(30), (F.size(labels) - 1) * 8)
    score = (
        F.lit(100.0)
        - F.coalesce(low_rating, F.lit(0.0))
        - many_labels
        - F.when(F.array_contains(labels, "defective_product"), 8).otherwise(0)
        - F.when(F.array_contains(labels, "warranty_claim_issue"), 6).otherwise(0)
    )
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), score)), 2)


def _lookup(label: Column, table: Mapping[str, str]) -> Column:
    pairs = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[label], F.lit(table[lx.OTHER_LABEL]))


def label_suggestion(label: Column) -> Column:
    return _lookup(label, lx.LABEL_SUGGESTIONS)


def relevance_note(label: Column) -> Column:
    return _lookup(label, lx.RELEVANCE_NOTES)


def sentiment_balance(
    lowered: Column,
    positive: Sequence[str] = lx.POSITIVE_CUES,
    negative: Sequence[str] = lx.NEGATIVE_CUES,
) -> Column:
    """(pos - neg) / (pos + neg) over distinct cues; 0 when there are none."""
    found = cues.hits(lowered, positive, negative)
    pos, neg = F.get(found, F.lit(0)), F.get(found, F.lit(1))
    return (pos - neg) / F.greatest(pos + neg, F.lit(1))


def sentiment_label(balance: Column, threshold: float = 0.15) -> Column:
    return (
        F.when(balance > threshold, "positive")
        .when(balance < -threshold, "negative")
        .otherwise("neutral")
    )


def summarize(
    text: Column,
    sentences: Column,
    focus_terms: Sequence[str] = lx.SUMMARY_FOCUS_TERMS,
    max_sentences: int = 2,
) -> Column:
    """The best sentences, in rank order; the start of the text when there is none."""
    ranks = cues.sentence_ranks(F.transform(sentences, F.lower), focus_terms)
    numbered = F.transform(ranks, lambda r, i: F.struct(r.alias("rank"), i.alias("i")))
    best = F.slice(F.array_sort(numbered), 1, max_sentences)
    summary = F.array_join(F.transform(best, lambda r: F.get(sentences, r["i"])), " ")
    opening = tx.collapse_ws(F.coalesce(text, F.lit("")))
    return F.when(F.size(sentences) == 0, tx.ellipsis(opening, 280)).otherwise(
        tx.ellipsis(summary, 400)
    )
