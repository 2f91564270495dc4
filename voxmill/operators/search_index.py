"""A search index on disk: fitted once, read by every search after that.

Tables under the index's folder:

- ``tokens``: seq, the words of the document, and what filters look at;
- ``vocabulary``: index, term, total, df, idf, at most ``max_features`` rows;
- ``postings``: for each term and block of documents their numbers and weights, and the largest weight,
  sorted by term. A block holds ``BLOCK_DOCS`` documents, so a term that every document has is many rows;
- ``word_totals``: how often each word occurs by what filters look at.

A search reads the postings of its terms and no text. Largest weights bound what a block can give: the
blocks that promise most are scored first, and only those that can beat their results after that. With
many queries bounds hold few blocks back, and a row per query and block, or document, would fill the disk:
then a task scores all queries against a chunk of blocks and passes on ``top_k`` rows of each query, those
documents only that can beat the results of the first chunk.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxmill import lexicons as lx
from voxmill.functions import counting, scoring
from voxmill.functions import text as tx
from voxmill.operators import filters, numbering, tfidf
from voxmill.sources.shipping import ship_package
from voxmill.sources.staging import broadcast_if_small, stage

BLOCK_DOCS = 1024
#: Blocks a query that are scored before the others are bounded by the result.
SEED_BLOCKS = 4
#: Different terms up to which a search names them in the scan of the postings.
NAMED_TERMS = 1000
#: Queries from which on chunks of documents are scored in full instead of blocks by their bounds.
MANY_QUERIES = 256
#: Blocks of a chunk, and queries that meet it in one task.
CHUNK_BLOCKS, CHUNK_QUERIES = 32, 200_000
#: Queries that meet the first chunk in one task, where no document is left out.
FIRST_QUERIES = 4000
#: Parts in which the best rows of a query are found before the best of all.
SPREAD = 64
#: Bounds and similarities are sums of the same numbers in another order.
SLACK = 1e-9
#: What filters look at; the date is kept as its year.
FACETS = ("has_return_mention", "has_warranty_mention", "issue_labels", "review_date")


@dataclass(frozen=True)
class SearchIndex:
    tokens: DataFrame
    vocabulary: DataFrame
    postings: DataFrame
    word_totals: DataFrame
    stopwords: tuple[str, ...]
    max_features: int


def build(
    records: DataFrame, path: str, fallback: bool = False, stopwords: Sequence[str] | None = None,
    max_features: int = tfidf.MAX_FEATURES,
) -> SearchIndex:
    """Fit on clean records and write the index to the folder ``path``."""
    spark = records.sparkSession
    words = tuple(lx.default_stopwords() if stopwords is None else stopwords)
    facets = [c for c in FACETS if c in records.columns]
    year = tx.extract_year(F.col("review_date")).cast("string").alias("review_date")
    docs = records.select(
        "seq", tfidf.text_of(fallback).alias("text"), *(year if c == "review_date" else c for c in facets)
    )
    tfidf.tokenized(docs, words).write.parquet(f"{path}/tokens")
    tokens = spark.read.parquet(f"{path}/tokens")
    tfidf.word_totals(tokens, *facets).write.parquet(f"{path}/word_totals")
    counted = spark.read.parquet(f"{path}/word_totals")
    model = tfidf.fit(
        tokens, words, max_features, counted.groupBy("term").agg(F.sum("total").alias("total"))
    )
    model.vocabulary.write.parquet(f"{path}/vocabulary")
    vectors = stage(tfidf.weighed_cells(tokens, model).where("seq is not null"), "vectors")
    # Only numbers are ranked: a bucket of a million documents meets in one task, without their vectors.
    blocks = numbering.positions(vectors.select("seq"), "seq", "_pos").select(
        "seq", F.floor((F.col("_pos") - 1) / BLOCK_DOCS).cast("long").alias("block")
    )  # rows of one number share a position
    # Positions go up with the numbers: where a block starts, two numbers for each, tells the block of a document.
    first = blocks.groupBy("block").agg(F.min("seq").alias("seq")).orderBy("block").collect()
    starts = spark.sparkContext.broadcast(np.array([[r.seq, r.block] for r in first], np.int64).reshape(-1, 2).T)
    placed = vectors.mapInArrow(
        lambda batches: counting.in_blocks(batches, *starts.value), f"{_ddl(vectors)}, block long"
    )
    listed = placed.groupBy("block").applyInArrow(  # at most BLOCK_DOCS different numbers a group
        counting.postings, "index int, block long, top double, seqs array<long>, weights array<double>"
    )
    listed.repartitionByRange("index", "block").sortWithinPartitions("index", "block").write.parquet(f"{path}/postings")
    spark.range(1).select(
        F.lit(max_features).alias("max_features"), F.array(*map(F.lit, words)).cast("array<string>").alias("stopwords")
    ).write.parquet(f"{path}/settings")
    return open_index(spark, path)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def open_index(spark: SparkSession, path: str) -> SearchIndex:
    settings = spark.read.parquet(f"{path}/settings").first()
    tables = (spark.read.parquet(f"{path}/{t}") for t in ("tokens", "vocabulary", "postings", "word_totals"))
    return SearchIndex(*tables, tuple(settings["stopwords"]), settings["max_features"])


def query_terms(index: SearchIndex, queries: DataFrame) -> DataFrame:
    """(query_no, index, query_weight) of ``queries`` (query_no, query), each query scaled to length one."""
    tokens = queries.select("query_no", tx.index_tokens("query", index.stopwords).alias("_tokens"))
    terms = tokens.select("query_no", F.explode(tfidf.terms_of(F.col("_tokens"))).alias("term"))
    counted = terms.groupBy("query_no", "term").agg(F.count(F.lit(1)).alias("_n"))
    # The vocabulary's size is checked when it is fitted.
    raw = counted.join(F.broadcast(index.vocabulary.select("term", "index", "idf")), "term").withColumn(
        "_raw", F.col("_n") * F.col("idf")
    )
    size = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(W.partitionBy("query_no")))
    return raw.select("query_no", "index", (F.col("_raw") / size).alias("query_weight"))


def _best(rows: DataFrame, order: list[Column], k: int, spread: str = "block") -> DataFrame:
    """The ``k`` first rows of each query, with ``rank``: in ``SPREAD`` parts first, so that no task ranks all."""
    part = F.pmod(F.xxhash64(spread), F.lit(SPREAD))
    first = F.row_number().over(W.partitionBy("query_no", part).orderBy(*order))
    few = rows.withColumn("rank", first).where(F.col("rank") <= k)
    last = F.row_number().over(W.partitionBy("query_no").orderBy(*order))
    return few.withColumn("rank", last).where(F.col("rank") <= k)


def _by_similarity() -> list[Column]:
    return [F.desc(F.round("sim", 10)), F.desc("seq")]


def similar(index: SearchIndex, queries: DataFrame, top_k: int) -> DataFrame:
    """(query_no, seq, sim) of the best documents that share a term with a query of the table ``queries``."""
    terms = stage(query_terms(index, queries), "query-terms")
    asked = terms.agg(F.count_distinct("query_no")).first()[0]
    if asked > MANY_QUERIES:
        return _similar_to_many(index, terms, asked, top_k)
    named = [r["index"] for r in terms.select("index").distinct().limit(NAMED_TERMS + 1).collect()]
    postings = index.postings
    if len(named) <= NAMED_TERMS:
        postings = postings.where(F.col("index").isin(named))  # reaches the scan
    met = postings.join(broadcast_if_small(terms), "index")
    bounds = met.groupBy("query_no", "block").agg(F.sum(F.col("top") * F.col("query_weight")).alias("bound"))
    bounds = stage(bounds, "search-bounds")

    def scored(blocks: DataFrame) -> DataFrame:
        cells = F.arrays_zip(F.col("seqs").alias("seq"), F.col("weights").alias("weight"))
        own = met.join(blocks.select("query_no", "block"), ["query_no", "block"], "left_semi")
        parts = own.select("query_no", "block", "query_weight", F.inline(cells))
        return parts.groupBy("query_no", "block", "seq").agg(
            F.sum(F.col("weight") * F.col("query_weight")).alias("sim")
        )

    seeds = _best(bounds, [F.desc("bound"), F.asc("block")], SEED_BLOCKS)
    found = _best(scored(seeds), _by_similarity(), top_k)
    least = found.groupBy("query_no").agg(
        F.when(F.count(F.lit(1)) == top_k, F.min("sim")).alias("least")
    )
    chosen = bounds.join(least, "query_no", "left").where(F.col("bound") >= F.coalesce("least", F.lit(0.0)) - SLACK)
    best = _best(scored(chosen).where(F.round("sim", 10) > 0), _by_similarity(), top_k)
    return best.select("query_no", "seq", "sim")


def _similar_to_many(index: SearchIndex, terms: DataFrame, asked: int, top_k: int) -> DataFrame:
    """``similar`` for the staged ``terms`` of many queries: work on pairs is done within tasks.

    The first chunk of documents is scored in full. What a query's last result has there, the results of all
    chunks must have, so most documents of the others are left out by a bound.
    """
    terms = terms.where("query_no is not null")
    chunks = index.postings.agg(F.coalesce(F.max("block"), F.lit(0))).first()[0] // CHUNK_BLOCKS + 1
    none = terms.withColumn("least", F.lit(None).cast("double"))
    if chunks == 1:
        return _best_of_chunks(index.postings, none, asked, 1, CHUNK_QUERIES, top_k)
    start = index.postings.where(F.col("block") < CHUNK_BLOCKS)
    found = _best_of_chunks(start, none, asked, 1, FIRST_QUERIES, top_k)
    least = stage(found.groupBy("query_no").agg(
        F.when(F.count(F.lit(1)) == top_k, F.min("sim")).alias("least")
    ), "search-least")
    known = terms.join(broadcast_if_small(least), "query_no", "left")
    return _best_of_chunks(index.postings, known, asked, chunks, CHUNK_QUERIES, top_k)


def _best_of_chunks(
    postings: DataFrame, terms: DataFrame, asked: int, chunks: int, together: int, top_k: int
) -> DataFrame:
    """(query_no, seq, sim): the best documents that ``postings`` have for the queries of ``terms``.

    A task holds a chunk of documents and the terms of a part of the queries, about ``together`` of them; only
    the best rows of each query and chunk are shuffled.
    """
    ship_package(terms.sparkSession)
    parts = -(-asked // together)
    all_parts = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    used = terms.select("index").distinct()  # at most the vocabulary
    chunk = F.expr(f"block div {CHUNK_BLOCKS}").alias("chunk")
    cells = postings.join(F.broadcast(used), "index", "left_semi").select(
        all_parts, chunk, "index", "seqs", "weights")
    part = F.pmod(F.xxhash64("query_no"), F.lit(parts)).cast("int").alias("part")
    dealt = terms.select(
        part, F.explode(F.expr(f"sequence(0L, {chunks - 1}L)")).alias("chunk"),
        "query_no", "index", "query_weight", "least",
    )
    kind = terms.schema["query_no"].dataType.simpleString()
    scored = cells.groupBy("part", "chunk").cogroup(dealt.groupBy("part", "chunk")).applyInArrow(
        lambda docs, asking: scoring.best_of_chunk(docs, asking, top_k),
        f"query_no {kind}, seq long, sim double",
    )
    rank = F.row_number().over(W.partitionBy("query_no").orderBy(*_by_similarity()))  # top_k rows a chunk
    return scored.withColumn("rank", rank).where(F.col("rank") <= top_k).select("query_no", "seq", "sim")


def with_others(found: DataFrame, queries: DataFrame, docs: DataFrame, top_k: int) -> DataFrame:
    """(query_no, query, rank, seq, similarity): min(top_k, documents) rows for every query.

    Ties go to the later document. Documents without a common term have similarity 0 and fill up the list:
    fewer than ``top_k`` documents match in that case, so the last ``2 * top_k`` hold enough others.
    """
    last = [r.seq for r in docs.select("seq").orderBy(F.desc("seq")).limit(2 * top_k).collect()]
    others = queries.select(
        "query_no", F.explode(F.array(*map(F.lit, last)).cast("array<long>")).alias("seq"), F.lit(0.0).alias("sim")
    )
    all_ = found.unionByName(others).groupBy("query_no", "seq").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(W.partitionBy("query_no").orderBy(*_by_similarity()))  # 3 * top_k rows at most
    return all_.withColumn("rank", rank).where(F.col("rank") <= top_k).join(queries, "query_no").select(
        "query_no", "query", "rank", "seq", F.round("sim", 4).alias("similarity")
    )


def search(index: SearchIndex, queries: DataFrame, top_k: int = 5) -> DataFrame:
    """The best documents for every row of ``queries`` (query_no, query), in one pass over the postings."""
    return with_others(similar(index, queries, top_k), queries, index.tokens, top_k)


def filtered_search(index: SearchIndex, query: str, top_k: int = 10, **conditions) -> DataFrame:
    """(rank, seq, similarity) among the documents that meet ``conditions``, as if fitted on them alone.

    Word counts come from the totals by what the filters look at, pairs and weights from the tokens of the
    documents that are left: no text is read.
    """
    spark = index.tokens.sparkSession
    where = filters.condition(**conditions)
    tokens = stage(index.tokens.where(where).select("seq", "_tokens"), "filtered-tokens")
    totals = index.word_totals.where(where).groupBy("term").agg(F.sum("total").alias("total"))
    model = tfidf.fit(tokens, index.stopwords, index.max_features, totals)
    queries = spark.createDataFrame([(0, query)], "query_no int, query string")
    own = SearchIndex(tokens, model.vocabulary, index.postings, totals, index.stopwords, index.max_features)
    asked = query_terms(own, queries).join(F.broadcast(model.vocabulary.select("index", "term")), "index")
    weights = {r["index"]: r.query_weight for r in asked.collect()}  # the terms of one query
    words = sorted({r.term.split(" ")[0] for r in asked.select("term").collect()})
    vector = tfidf.sparse("_weights")
    hits = tokens.where(F.arrays_overlap("_tokens", F.array(*map(F.lit, words)).cast("array<string>")))
    ready = tfidf.weigh(hits, model).select("seq", vector["indices"].alias("_at"), vector["values"].alias("_w"))
    sim = sum((
        F.coalesce(F.get("_w", F.array_position("_at", F.lit(i)).cast("int") - 1), F.lit(0.0)) * w
        for i, w in sorted(weights.items())
    ), F.lit(0.0))
    scored = ready.select(F.lit(0).alias("query_no"), "seq", sim.alias("sim")).where(F.round("sim", 10) > 0)
    best = _best(scored, _by_similarity(), top_k, "seq").select("query_no", "seq", "sim")
    return with_others(best, queries, tokens, top_k).select("rank", "seq", "similarity")
