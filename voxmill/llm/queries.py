"""The operators of this subpackage as registered queries over the given tables."""

from __future__ import annotations

import public_tokenizers

from voxmill.llm import (
    bpe, decontaminate, fill_middle, fingerprints, html_templates, merkle, near_join, repeats,
    sharding, token_files, toxicity, url_filter, warc,
)
from voxmill.llm.rows import read

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark, sf_dir):
    return toxicity.query(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_url_filter(spark, sf_dir):
    return url_filter.query(read(spark, sf_dir, "pages"))


def op3_token_files(spark, sf_dir):
    return token_files.query(read(spark, sf_dir, "documents"), TOKENIZER)


def op4_repeats(spark, sf_dir):
    return repeats.query(read(spark, sf_dir, "documents"))


def op5_html_main_text(spark, sf_dir):
    return html_templates.query(read(spark, sf_dir, "pages"))


def op6_shards(spark, sf_dir):
    return sharding.query(read(spark, sf_dir, "documents"))


def op7_near_join(spark, sf_dir):
    return near_join.query(read(spark, sf_dir, "documents"))


def op8_decontaminate(spark, sf_dir):
    return decontaminate.query(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op9_bpe(spark, sf_dir):
    return bpe.query(read(spark, sf_dir, "documents"), TOKENIZER)


def op10_fingerprints(spark, sf_dir):
    return fingerprints.query(read(spark, sf_dir, "documents"))


def op11_fill_middle(spark, sf_dir):
    return fill_middle.query(read(spark, sf_dir, "documents"))


def op12_warc(spark, sf_dir):
    return warc.query(read(spark, sf_dir, "pages"))


def op13_merkle(spark, sf_dir):
    return merkle.query(read(spark, sf_dir, "documents"))


_OPERATORS = (
    op1_toxicity, op2_url_filter, op3_token_files, op4_repeats, op5_html_main_text, op6_shards,
    op7_near_join, op8_decontaminate, op9_bpe, op10_fingerprints,
    op11_fill_middle, op12_warc, op13_merkle,
)


def queries():
    return {f.__name__: f for f in _OPERATORS}


def oracle_sql():
    return {
        "op4_repeats": repeats.ORACLE, "op8_decontaminate": decontaminate.ORACLE,
        "op11_fill_middle": fill_middle.ORACLE, "op12_warc": warc.ORACLE, "op13_merkle": merkle.ORACLE,
    }
