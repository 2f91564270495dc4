"""TF-IDF over single words and word pairs.

Text is split once, into a token table (``tokenized``); fitting and weighing read the tokens. A pair
cannot be more frequent than either of its words, so only pairs of words frequent enough for the
vocabulary are counted; the long tail of rare pairs never reaches the shuffle. The result is exact.

Weighting is done row by row with the ML transformers: counting, scaling and normalising a document
needs nothing but the document and the vocabulary, so there is no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill import lexicons as lx
from voxmill.functions import counting
from voxmill.functions import text as tx
from voxmill.operators.features import corpus_text
from voxmill.sources.shipping import ship_package
from voxmill.sources.staging import stage

MAX_FEATURES = 8000
KEY_LENGTH = 64
#: Words whose pairs are counted that go to every worker; beyond that they are joined by a shuffle.
WORKER_BYTES = 16 * 1024 * 1024
# The vocabulary goes to the driver and to every executor.
VOCABULARY_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class TfidfModel:
    """``vocabulary`` is (index, term, total, df, idf), at most ``max_features`` rows.

    ``pipeline`` turns the column ``_terms`` into ``_counts`` and the unit-length ``_weights``.
    """

    vocabulary: DataFrame
    pipeline: PipelineModel
    n_docs: int
    stopwords: tuple[str, ...]


def text_of(fallback: bool = True) -> Column:
    """The text to index; with ``fallback`` the review text stands in for missing text."""
    return corpus_text() if fallback else F.coalesce("review_text_normalized", F.lit(""))


def corpus(records: DataFrame, fallback: bool = True) -> DataFrame:
    """(seq, text) to index."""
    return records.select("seq", text_of(fallback).alias("text"))


def terms_of(tokens: Column) -> Column:
    return F.concat(tokens, tx.bigrams(tokens))


def tokenized(docs: DataFrame, stopwords: Sequence[str] | None = None) -> DataFrame:
    """``docs`` with ``_tokens`` in place of ``text`` (null: no tokens); a token table stays as it is.

    Stage it, and no later step splits the text again. It goes with models of the same stop words.
    """
    if "_tokens" in docs.columns:
        return docs
    words = lx.default_stopwords() if stopwords is None else stopwords
    return docs.withColumn("_tokens", tx.index_tokens("coalesce(text, '')", words)).drop("text")


def with_terms(docs: DataFrame, stopwords: Sequence[str]) -> DataFrame:
    """Add ``_terms``: the words of the document and their neighbouring pairs."""
    return tokenized(docs, stopwords).withColumn("_terms", terms_of(F.col("_tokens"))).drop("_tokens")


def _key(word: Column) -> Column:
    """A join key of bounded length: a long word is replaced by a digest."""
    digest = F.concat(F.lit("#"), F.substring(F.sha2(word, 256), 1, KEY_LENGTH - 1))
    return F.when(F.length(word) <= KEY_LENGTH, word).otherwise(digest)


def word_totals(tokens: DataFrame, *by: str) -> DataFrame:
    """(term, *by, total): how often each word occurs."""
    words = tokens.select(F.explode("_tokens").alias("term"), *by)
    return words.groupBy("term", *by).agg(F.count(F.lit(1)).alias("total"))


def _sent(spark: SparkSession, words: list[str]) -> Broadcast:
    """``words`` as an Arrow array, for the workers."""
    ship_package(spark)
    return spark.sparkContext.broadcast(pa.array(words, pa.string()))


def _frequent_terms(tokens: DataFrame, max_features: int, words: DataFrame | None) -> DataFrame:
    """(term, total) of the ``max_features`` most frequent terms, ties in term order."""
    total = F.count(F.lit(1)).alias("total")
    words = stage(word_totals(tokens) if words is None else words, "words")
    order = [F.desc("total"), F.asc("term")]
    best = words.orderBy(*order).limit(max_features)
    floor, found = best.agg(F.min("total"), F.count(F.lit(1))).first()
    counted = None
    if found == max_features and floor > 1:
        # Words that tie with the last one of the vocabulary stay in.
        frequent = words.where(F.col("total") >= floor)
        rows, size = frequent.agg(F.count(F.lit(1)), F.sum(F.octet_length("term"))).first()
        if rows * 16 + size <= WORKER_BYTES:
            listed = _sent(tokens.sparkSession, [r.term for r in frequent.select("term").collect()])
            keys = tokens.mapInArrow(lambda batches: counting.pair_counts(batches, listed.value), "key long, n long")
            # ``best`` is full of words that are as frequent as the floor, so rarer pairs have no place.
            counted = keys.groupBy("key").agg(F.sum("n").alias("total")).where(F.col("total") >= floor).mapInArrow(
                lambda batches: counting.named_pairs(batches, listed.value), "a string, b string, total long")
    if counted is None:
        pairs = tokens.select(
            F.inline(F.zip_with(
                F.slice("_tokens", F.lit(1), F.greatest(F.size("_tokens") - 1, F.lit(0))),
                F.slice("_tokens", F.lit(2), F.greatest(F.size("_tokens") - 1, F.lit(0))),
                lambda a, b: F.struct(a.alias("a"), b.alias("b")),
            ))
        )
        if found == max_features and floor > 1:
            keys = frequent.select(_key(F.col("term")).alias("key"))
            for side in ("a", "b"):
                pairs = pairs.withColumn("key", _key(F.col(side))).join(keys, "key", "left_semi")
            pairs = pairs.select("a", "b")
        counted = pairs.groupBy("a", "b").agg(total)
    joined = counted.select(F.concat_ws(" ", "a", "b").alias("term"), "total")
    return best.unionByName(joined).orderBy(*order).limit(max_features)


def fit(
    docs: DataFrame,
    stopwords: Sequence[str] | None = None,
    max_features: int = MAX_FEATURES,
    totals: DataFrame | None = None,
) -> TfidfModel:
    """Vocabulary and smoothed idf of (seq, text) or of a staged token table. An action.

    ``totals``: (term, total) of the words of ``docs``, if they have been counted already.
    """
    words = tuple(lx.default_stopwords() if stopwords is None else stopwords)
    if "_tokens" not in docs.columns:
        docs = stage(tokenized(docs.select("text"), words), "tokens")
    frequent = stage(_frequent_terms(docs.select("_tokens"), max_features, totals), "terms")
    size = frequent.agg(F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()[0]
    if size > VOCABULARY_BYTES:
        raise ValueError(f"the vocabulary takes {size} bytes; lower max_features")
    totals = {r.term: r.total for r in frequent.orderBy(F.desc("total"), "term").collect()}
    terms = list(totals)
    counter = CountVectorizerModel.from_vocabulary(terms or [" "], inputCol="_terms", outputCol="_counts")
    n_docs, df = docs.count(), [0] * max(len(terms), 1)
    if size:
        known = _sent(docs.sparkSession, terms)
        seen = docs.select("_tokens").mapInArrow(
            lambda batches: counting.document_counts(batches, known.value.to_pylist()), "i int, n long"
        )
        for row in seen.groupBy("i").agg(F.sum("n").alias("n")).collect():  # a row per term
            df[row.i] = row.n
    idf = [math.log((1.0 + n_docs) / (1.0 + n)) + 1.0 for n in df]
    vocabulary = docs.sparkSession.createDataFrame(pa.table({
        "index": pa.array(range(len(terms)), pa.int32()),
        "term": pa.array(terms, pa.string()),
        "total": pa.array([totals[t] for t in terms], pa.int64()),
        "df": pa.array(df[:len(terms)], pa.int64()),
        "idf": pa.array(idf[:len(terms)], pa.float64()),
    }))
    scaler = ElementwiseProduct(
        scalingVec=Vectors.dense(idf), inputCol="_counts", outputCol="_scaled"
    )
    unit = Normalizer(p=2.0, inputCol="_scaled", outputCol="_weights")
    return TfidfModel(vocabulary, PipelineModel([counter, scaler, unit]), n_docs, words)


def weigh(docs: DataFrame, model: TfidfModel) -> DataFrame:
    """Add the vectors ``_counts`` and ``_weights`` in place of text or tokens; one row in, one row out."""
    weighed = model.pipeline.transform(with_terms(docs, model.stopwords))
    return weighed.drop("_terms", "_scaled")


def _sent_model(spark: SparkSession, model: TfidfModel) -> tuple[Broadcast, Broadcast]:
    counter, scaler, _ = model.pipeline.stages
    return _sent(spark, counter.vocabulary), spark.sparkContext.broadcast(scaler.getScalingVec().toArray())


def weighed_cells(tokens: DataFrame, model: TfidfModel) -> DataFrame:
    """(seq, index, weight): the terms of a token table's documents by number, those without any left out.

    The weights of ``weigh`` as arrays, made in the workers without a string for each pair.
    """
    terms, idf = _sent_model(tokens.sparkSession, model)
    kind = tokens.schema["seq"].dataType.simpleString()
    return tokens.select("_tokens", "seq").mapInArrow(
        lambda batches: counting.document_weights(batches, terms.value.to_pylist(), idf.value),
        f"seq {kind}, index array<int>, weight array<double>",
    )


def weigh_by_number(docs: DataFrame, model: TfidfModel, to: str) -> DataFrame:
    """Add the vector ``_weights`` of ``weigh`` as ``to``, made in the workers, in place of text or tokens."""
    terms, idf = _sent_model(docs.sparkSession, model)

    def vectors(tokens: pa.Array) -> pa.Array:
        return counting.unit_vectors(tokens, terms.value.to_pylist(), idf.value)

    cut = tokenized(docs, model.stopwords)
    return cut.withColumn(to, F.arrow_udf(vectors, VectorUDT())("_tokens")).drop("_tokens")


def term_counts(docs: DataFrame, terms: list[str], stopwords: Sequence[str]) -> DataFrame:
    """(seq, place, n) of documents or a token table: arrays of the places in ``terms`` and the counts."""
    known = _sent(docs.sparkSession, terms)
    kind = docs.schema["seq"].dataType.simpleString()
    return tokenized(docs, stopwords).select("_tokens", "seq").mapInArrow(
        lambda batches: counting.document_cells(batches, known.value.to_pylist()),
        f"seq {kind}, place array<int>, n array<long>",
    )


def sparse(vector: str) -> Column:
    """The ``indices`` and ``values`` of a sparse vector as a struct of arrays."""
    return F.unwrap_udt(vector)


def tfidf_weights(docs: DataFrame, model: TfidfModel) -> DataFrame:
    """(seq, term, tf, weight), every document's weights scaled to length one."""
    cells = F.arrays_zip(
        sparse("_weights")["indices"].alias("index"),
        sparse("_counts")["values"].alias("tf"),
        sparse("_weights")["values"].alias("weight"),
    )
    # The vocabulary's size is checked when it is fitted.
    terms = F.broadcast(model.vocabulary.select("index", "term"))
    return (
        weigh(docs, model)
        .select("seq", F.inline(cells))
        .join(terms, "index")
        .select("seq", "term", F.col("tf").cast("int").alias("tf"), "weight")
    )


def top_corpus_terms(docs: DataFrame, model: TfidfModel, top_k: int = 25) -> DataFrame:
    """Terms with the highest mean weight over all documents, those without the term included."""
    n = max(model.n_docs, 1)
    cells = F.arrays_zip(
        sparse("_weights")["indices"].alias("index"), sparse("_weights")["values"].alias("weight")
    )
    means = (
        weigh(docs, model)
        .select(F.inline(cells))
        .groupBy("index")
        .agg((F.sum("weight") / n).alias("mean"))
    )
    return (
        means.join(F.broadcast(model.vocabulary.select("index", "term")), "index")
        .orderBy(F.desc(F.round("mean", 10)), F.desc("term"))
        .limit(top_k)
        .select("term", F.round("mean", 6).alias("avg_tfidf_weight"))
    )


def corpus_stats(model: TfidfModel) -> DataFrame:
    return model.vocabulary.agg(F.count(F.lit(1)).alias("vocabulary_size")).select(
        F.lit(model.n_docs).cast("long").alias("record_count"),
        "vocabulary_size",
        F.lit(model.n_docs).cast("long").alias("matrix_rows"),
        F.col("vocabulary_size").alias("matrix_columns"),
    )
