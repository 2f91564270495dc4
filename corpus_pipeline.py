"""From raw documents to token ids: each stage works on what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voxmill.llm import bpe, decontaminate, near_join, queries, repeats, toxicity
from voxmill.llm.rows import read
from voxmill.sources.staging import stage

#: Words of the shortest passage that must not stand in two places, whatever its bytes.
REPEATED_WORDS = 51


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, read(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_join.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeats.cut(docs, REPEATED_WORDS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.query(docs, queries.TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("repeats", cut_repeats),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]

#: SQL cannot express the fitted classifier of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
