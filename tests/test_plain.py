"""Normalised text and labels from the Python workers."""

import random

from pyspark.sql import functions as F

from voxmill import lexicons as lx
from voxmill.functions import labels as lb
from voxmill.functions import text as tx

PIECES = ["Http://a.b/c?d", "http", "HTTPS", "x", "Ünder", " ", "\x85", "a b", "\U0001f600", "9", "--", "\n", "\x1c", "İ", "K",
          "Late", "DEFECTive", "charge", "charged", " ", "agent", "returned", "covered", ""]


def test_normalised_as_by_regular_expressions(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 12))) for _ in range(600)] + [None, "", "http", "httpx", " http　y "]
    docs = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    lowered = F.lower(F.coalesce("t", F.lit("")))
    no_links = F.regexp_replace(lowered, f"http[^{tx.SPACE}]+", " ")
    want = F.trim(F.regexp_replace(no_links, "[^a-z0-9]+", " "))
    got = docs.select("t", want.alias("want"), tx.normalize_text(F.col("t")).alias("got"))
    assert got.where("not (want <=> got)").collect() == []
    plan = docs.select(tx.normalize_text(F.col("t")))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "[^a-z0-9]+" not in plan


def test_broken_bytes_are_no_words(spark):
    docs = spark.sql("SELECT cast(X'61FF62206874747000FFC320C3' AS string) AS t")
    assert docs.select(tx.normalize_text(F.col("t")).alias("n")).first().n == "a b"


def test_labels_as_by_contains(spark):
    rng = random.Random(3)
    words = [w for ws in lx.ISSUE_TAXONOMY.values() for w in ws] + ["xfeex", "ö", "de", "fect"]
    texts = ["".join(rng.choices([*words, " ", "q"], k=rng.randint(0, 4))) for _ in range(400)] + [None, ""]
    docs = spark.createDataFrame([(t,) for t in texts], "t string")
    want = [
        [x for x, ws in lx.ISSUE_TAXONOMY.items() if any(w in (t or "") for w in ws)] or [lx.OTHER_LABEL] for t in texts
    ]
    got = docs.select("t", lb.issue_labels(F.col("t")).alias("found"))
    assert sorted((r.t or "", r.found) for r in got.collect()) == sorted((t or "", w) for t, w in zip(texts, want))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Contains" not in plan
