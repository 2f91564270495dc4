"""Ranked search over a fitted corpus."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxmill.functions import text as tx
from voxmill.operators import filters, search_index, tfidf
from voxmill.sources.staging import stage

QUERIES_PER_PASS = 32


def query_weights(
    spark: SparkSession, model: tfidf.TfidfModel, queries: Sequence[str]
) -> tuple[dict[int, dict[int, float]], list[str]]:
    """Query number -> vocabulary index -> weight, and the words the queries match by.

    Both depend on the queries only.
    """
    rows = F.array(*[F.struct(F.lit(i).alias("no"), F.lit(q).alias("text"))
                     for i, q in enumerate(queries)])
    asked = tfidf.weigh(spark.range(1).select(F.inline(rows)), model)
    vector = tfidf.sparse("_weights")
    weights = {
        r.no: dict(zip(r.indices, r["values"]))
        for r in asked.select("no", vector["indices"].alias("indices"),
                              vector["values"].alias("values")).collect()
    }
    used = sorted({i for terms in weights.values() for i in terms})
    terms = model.vocabulary.where(F.col("index").isin(used)).select("term").collect() if used else []
    return weights, sorted({r.term.split(" ")[0] for r in terms})


def _similar(
    docs: DataFrame, model: tfidf.TfidfModel, weights: dict[int, dict[int, float]],
    words: list[str],
) -> DataFrame:
    """(query_no, seq, sim) of documents that share a term with a query.

    A document without any of the query words cannot match and is dropped before it is split into
    terms; the rest is scored row by row.
    """
    if "_tokens" in docs.columns:
        listed = F.array(*map(F.lit, words)).cast("array<string>")
        hits = docs.where(F.arrays_overlap("_tokens", listed))
    else:
        hits = docs.where(tx.contains_any(F.lower("text"), words))
    vector = tfidf.sparse("_weights")
    ready = tfidf.weigh(hits, model).select(
        "seq", vector["indices"].alias("_at"), vector["values"].alias("_w")
    )

    def dot(terms: dict[int, float]):
        parts = [
            F.coalesce(F.get("_w", F.array_position("_at", F.lit(i)).cast("int") - 1), F.lit(0.0)) * w
            for i, w in terms.items()
        ]
        return reduce(add, parts, F.lit(0.0))

    scores = F.array(*[F.struct(F.lit(no).alias("query_no"), dot(terms).alias("sim"))
                       for no, terms in weights.items()])
    return ready.select("seq", F.inline(scores)).where(F.round("sim", 10) > 0)


def search_batch(
    docs: DataFrame, model: tfidf.TfidfModel, queries: Sequence[str], top_k: int = 5
) -> DataFrame:
    """(query_no, query, rank, seq, similarity): min(top_k, documents) rows for every query.

    Ties go to the later document. Documents without a common term have similarity 0 and fill up
    the list: fewer than ``top_k`` documents match in that case, so the last ``2 * top_k``
    documents hold enough others.
    """
    spark = docs.sparkSession
    weights, words = query_weights(spark, model, queries)
    best = W.partitionBy("query_no").orderBy(F.desc(F.round("sim", 10)), F.desc("seq"))
    numbers = F.array(*[F.lit(i) for i in range(len(queries))])
    found = (
        docs.select("seq")
        .orderBy(F.desc("seq"))
        .limit(2 * top_k)
        .select(F.explode(numbers).alias("query_no"), "seq", F.lit(0.0).alias("sim"))
    )
    numbered = sorted(no for no, terms in weights.items() if terms)
    for at in range(0, len(numbered), QUERIES_PER_PASS):
        part = {no: weights[no] for no in numbered[at:at + QUERIES_PER_PASS]}
        scored = _similar(docs, model, part, words)
        ranked = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_k)
        found = found.unionByName(ranked.drop("rank"))
    text = F.lit(None).cast("string")
    for i, query in enumerate(queries):
        text = F.when(F.col("query_no") == i, query).otherwise(text)
    return (
        found.groupBy("query_no", "seq")
        .agg(F.max("sim").alias("sim"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top_k)
        .select("query_no", text.alias("query"), "rank", "seq",
                F.round("sim", 4).alias("similarity"))
    )


def with_records(results: DataFrame, records: DataFrame) -> DataFrame:
    """Attach the records. ``results`` has at most top_k rows per query, so it is the broadcast side."""
    return F.broadcast(results).join(records, "seq")


def search_topk(
    records: DataFrame,
    query: str,
    top_k: int = 5,
    model: tfidf.TfidfModel | None = None,
    index: search_index.SearchIndex | None = None,
) -> DataFrame:
    """Records by similarity to the query, with ``rank`` and ``similarity``.

    With an ``index`` of ``records`` only the postings of the query's terms are read, and the found
    records. Else, without a fitted ``model``, one is fitted on ``records``. Read ``records`` from a stage
    table, as the search goes over them more than once.
    """
    if index:
        queries = records.sparkSession.createDataFrame([(0, query)], "query_no int, query string")
        found = search_index.search(index, queries, top_k).drop("query_no", "query")
        return with_records(found, records).orderBy("rank")
    docs = stage(tfidf.tokenized(tfidf.corpus(records, fallback=False), model and model.stopwords), "tokens")
    model = model or tfidf.fit(docs)
    results = search_batch(docs, model, [query], top_k).drop("query_no", "query")
    return with_records(results, records).orderBy("rank")


def filtered_search(
    records: DataFrame, query: str, top_k: int = 10, index: search_index.SearchIndex | None = None, **conditions
) -> DataFrame:
    """Filter first, then fit on what is left: similarities depend on the filters.

    With an ``index`` of ``records`` the fit reads its totals and tokens instead of the texts.
    """
    if index and query.strip():
        found = search_index.filtered_search(index, query.strip(), top_k, **conditions)
        return with_records(found, records).orderBy("rank")
    kept = filters.apply_filters(records, **conditions)
    if not query.strip():
        empty = kept.where(F.lit(False))
        return empty.select("*", F.lit(0).alias("rank"), F.lit(0.0).alias("similarity"))
    return search_topk(kept, query.strip(), top_k)


def result_card(results: DataFrame) -> DataFrame:
    """The longer form of a result: 800 characters and dots, "N/A" where there is no label or suggestion."""
    view = result_view(results, 800)
    return view.withColumns({
        "issue_labels": F.coalesce(tx.non_empty(F.col("issue_labels")), F.lit("N/A")),
        "suggestion": F.coalesce("suggestion", F.lit("N/A")),
        "text": F.concat("text", F.lit("...")),
    })


def result_view(results: DataFrame, text_limit: int = 700) -> DataFrame:
    """What a result page shows: cut texts, the first five comments, the better suggestion."""
    for name in ("ai_root_cause_suggestion", "root_cause_suggestion"):
        if name not in results.columns:
            results = results.withColumn(name, F.lit(None).cast("string"))
    first_comments = F.transform(
        F.slice("comments", 1, 5),
        lambda c: F.struct(
            F.coalesce(c["author_name"], F.lit("Anonymous")).alias("author_name"),
            F.coalesce(c["posted_at"], F.lit("unknown")).alias("posted_at"),
            F.substring(F.coalesce(c["text"], F.lit("")), 1, 300).alias("text"),
        ),
    )
    shown = [
        c for c in (
            "seq", "rank", "similarity", "company", "title", "reviewer_name", "reviewer_location",
            "review_date", "review_updated_date", "rating", "helpful_count", "comment_count",
            "is_featured_review", "claimed_loss", "desired_outcome", "ai_predicted_issue",
            "ai_confidence", "ai_sentiment", "ai_sentiment_score", "ai_summary",
            "ai_domain_relevance", "raw_url",
        ) if c in results.columns
    ]
    return results.select(
        *shown,
        F.array_join("breadcrumbs", " > ").alias("breadcrumbs"),
        F.array_join("issue_labels", ", ").alias("issue_labels"),
        F.coalesce("ai_root_cause_suggestion", "root_cause_suggestion").alias("suggestion"),
        F.substring(F.coalesce("review_text", F.lit("")), 1, text_limit).alias("text"),
        first_comments.alias("comments"),
    )
