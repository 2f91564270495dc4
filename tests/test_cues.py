"""Cue lookups in the workers against the Column rules they stand for."""

from pyspark.sql import functions as F

from voxmill import lexicons as lx
from voxmill.functions import cues
from voxmill.functions import text as tx
from voxmill.operators import enrichment

TEXTS = ["", None, "thanks", "thank you, delayed delay", "unhelpful, would  not honor", "won't refunded refund é cant"]


def test_cue_hits_agree_with_column_rules(spark):
    frame = spark.createDataFrame([(t,) for t in TEXTS], "c string")
    rows = frame.select(
        cues.hits(F.col("c"), lx.POSITIVE_CUES, lx.NEGATIVE_CUES).alias("found"),
        tx.keyword_hits(F.col("c"), lx.POSITIVE_CUES).alias("pos"),
        tx.keyword_hits(F.col("c"), lx.NEGATIVE_CUES).alias("neg"),
    ).collect()
    assert [r.found and tuple(r.found) for r in rows] == [None if r.pos is None else (r.pos, r.neg) for r in rows]
    assert sum(r.pos or 0 for r in rows) == 5


def test_sentence_ranks_agree_with_column_rules(spark):
    sentences = ["a refund and a repair", "x y\x1cz " * 16, "word " * 30 + "warranty warranty", ""]
    terms = lx.SUMMARY_FOCUS_TERMS
    frame = spark.createDataFrame([(sentences,), ([],)], "c array<string>")
    ranks = [r[0] for r in frame.select(cues.sentence_ranks(F.col("c"), terms)).collect()]
    flat = spark.createDataFrame([(s,) for s in sentences], "c string")
    points = tx.keyword_hits(F.col("c"), terms) * 2 + F.floor(F.least(tx.word_count(F.col("c")), F.lit(40)) / 10)
    assert ranks == [[-r[0] for r in flat.select(points).collect()], []]
    assert ranks[0] == [-4, -4, -5, 0]


def test_enrichment_looks_cues_up_in_the_workers(spark):
    frame = spark.createDataFrame([("A refund was denied by the shop.", None)],
                                  "review_text string, full_text_with_comments string")
    for add in (enrichment.add_sentiment, enrichment.add_summary):
        plan = add(frame)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1


def test_trim_takes_all_white_space(spark):
    values = [c + "a" + c + "b" + c for c in tx.SPACES] + [tx.SPACES, "", None, "᠎a"]
    frame = spark.createDataFrame([(v,) for v in values], "c string")
    assert [r[0] for r in frame.select(tx.trim_ws(F.col("c"))).collect()] == [v and v.strip() for v in values]
    assert set(tx.SPACES) == {chr(c) for c in range(0x110000) if chr(c).isspace()}
