"""Quality of search results, predicted issues and enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill import lexicons as lx
from voxmill.operators import search, tfidf
from voxmill.sources.staging import stage


def retrieval_hits(
    records: DataFrame,
    queries: Sequence[tuple[str, Sequence[str]]] = lx.EVALUATION_QUERIES,
    top_k: int = 5,
    model: tfidf.TfidfModel | None = None,
) -> DataFrame:
    """Each query's results with the expected terms that their text contains."""
    docs = stage(tfidf.tokenized(tfidf.corpus(records), model and model.stopwords), "tokens")
    model = model or tfidf.fit(docs)
    found = search.search_batch(docs, model, [q for q, _ in queries], top_k)
    expected = F.lit(None).cast("array<string>")
    for i, (_, terms) in enumerate(queries):
        expected = F.when(F.col("query_no") == i, F.array(*[F.lit(t) for t in terms])).otherwise(
            expected
        )
    text = F.lower(tfidf.corpus_text())
    shown = records.select("seq", "company", text.alias("_text"))
    return (
        search.with_records(found, shown)
        .withColumn("matched_terms", F.filter(expected, lambda t: F.contains(F.col("_text"), t)))
        .select("query_no", "query", "rank", "seq", "company", "similarity", "matched_terms")
    )


def retrieval_hit_rate(hits: DataFrame, top_k: int = 5) -> DataFrame:
    """Per query: results with a match divided by ``top_k``, even where fewer rows came back."""
    return hits.groupBy("query_no", "query").agg(
        F.round(F.count_if(F.size("matched_terms") > 0) / top_k, 4).alias("keyword_hit_rate")
    )


def retrieval_summary(hits: DataFrame, top_k: int = 5) -> DataFrame:
    rate = F.count_if(F.size("matched_terms") > 0) / top_k
    per_query = hits.groupBy("query_no").agg(rate.alias("rate"))
    return per_query.agg(
        F.count(F.lit(1)).alias("queries_evaluated"),
        F.round(F.avg("rate"), 4).alias("avg_keyword_hit_rate"),
    )


def query_results(hits: DataFrame, top_k: int = 5) -> DataFrame:
    """One row with ``query_results``: per query its hit rate and what was found, best first.

    There are at most ``top_k`` hits per query, and as many queries as the caller listed.
    """
    shown = F.struct("rank", "company", "similarity", "matched_terms")
    per_query = hits.groupBy("query_no", "query").agg(
        F.round(F.count_if(F.size("matched_terms") > 0) / top_k, 4).alias("keyword_hit_rate"),
        F.array_sort(F.collect_list(shown)).alias("_found"),
    )
    found = F.transform("_found", lambda h: F.struct(
        h["company"].alias("company"), h["similarity"].alias("similarity"),
        h["matched_terms"].alias("matched_terms"),
    ))
    row = F.struct("query", F.lit(top_k).alias("top_k"), "keyword_hit_rate", found.alias("top_results"))
    placed = F.array_sort(F.collect_list(F.struct("query_no", row.alias("row"))))
    return per_query.agg(F.transform(placed, lambda q: q["row"]).alias("query_results"))


def class_scores(pairs: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(label, support, f1) over the union of true and predicted labels.

    Counting pairs first leaves classes x classes rows.
    """
    cells = pairs.groupBy(F.col(truth).alias("t"), F.col(predicted).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit = (F.col("t") == F.col("p")).cast("int")
    sides = F.array(
        F.struct(F.col("t").alias("label"), (F.col("n") * hit).alias("tp"),
                 (F.col("n") * (1 - hit)).alias("fn"), F.lit(0).cast("long").alias("fp")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("tp"),
                 F.lit(0).cast("long").alias("fn"), (F.col("n") * (1 - hit)).alias("fp")),
    )
    totals = cells.select(F.inline(sides)).groupBy("label").agg(
        F.sum("tp").alias("tp"), F.sum("fn").alias("fn"), F.sum("fp").alias("fp")
    )
    # 2tp + fn + fp is positive for every label that occurs on either side.
    f1 = 2 * F.col("tp") / (2 * F.col("tp") + F.col("fn") + F.col("fp"))
    return totals.select("label", (F.col("tp") + F.col("fn")).alias("support"), f1.alias("f1"))


def classification_eval(records: DataFrame) -> DataFrame:
    """One row: status, rows, accuracy and macro F1 against the first label."""
    judged = records.where(F.size("issue_labels") > 0).select(
        F.get("issue_labels", F.lit(0)).alias("truth"),
        F.coalesce("ai_predicted_issue", F.lit("other")).alias("predicted"),
    )
    overall = judged.agg(
        F.count(F.lit(1)).alias("records_evaluated"),
        F.count_distinct("truth").alias("classes"),
        F.avg((F.col("truth") == F.col("predicted")).cast("int")).alias("accuracy"),
    )
    macro = class_scores(judged, "truth", "predicted").agg(F.avg("f1")).scalar()
    enough = (F.col("records_evaluated") >= 5) & (F.col("classes") >= 2)
    return overall.select(
        F.when(enough, "ok").otherwise("insufficient_samples").alias("status"),
        "records_evaluated",
        F.when(enough, F.round("accuracy", 4)).alias("accuracy"),
        F.when(enough, F.round(macro, 4)).alias("macro_f1"),
    )


def ai_coverage(records: DataFrame) -> DataFrame:
    """Shares of records with sentiment, summary and prediction; null shares without records."""
    def share(condition):
        n = F.count(F.lit(1))
        return F.round(F.when(n > 0, F.count_if(condition) / n), 4)

    def present(name):
        return F.coalesce(F.col(name), F.lit("")) != ""

    return records.agg(
        F.count(F.lit(1)).alias("records"),
        share(present("ai_sentiment")).alias("sentiment_coverage"),
        share(present("ai_summary")).alias("summary_coverage"),
        share(present("ai_predicted_issue")).alias("classification_coverage"),
        share(F.col("ai_sentiment") == "negative").alias("negative_sentiment_rate"),
    )


def evaluation_report(records: DataFrame, top_k: int = 5) -> DataFrame:
    """One row with the structs ``retrieval``, ``classification`` and ``ai_coverage``."""
    hits = stage(retrieval_hits(records, top_k=top_k), "hits")
    results = query_results(hits, top_k).scalar()
    parts = {
        "retrieval": retrieval_summary(hits, top_k).withColumn("query_results", results),
        "classification": classification_eval(records),
        "ai_coverage": ai_coverage(records),
    }
    report = records.sparkSession.range(1)
    return report.select(
        *[part.select(F.struct("*")).scalar().alias(name) for name, part in parts.items()]
    )
