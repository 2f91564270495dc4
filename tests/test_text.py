"""Text, label and URL rules on hand-written rows."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voxmill.functions import labels as lb
from voxmill.functions import text as tx
from voxmill.functions import urls
from voxmill.operators import enrichment


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c"))).first()[0]


def many(spark, values, column, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [r[1] for r in frame.select("i", column(F.col("c"))).orderBy("i").collect()]


@settings(max_examples=5, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00İ"), max_size=40),
                min_size=20, max_size=60))
def test_text_rules_agree_with_python(spark, values):
    def normal(v):
        v = re.sub(r"http\S+", " ", v.lower())
        return " ".join(re.sub(r"[^a-z0-9\s]", " ", v).split())

    assert many(spark, values, tx.normalize_text) == [normal(v) for v in values]
    assert many(spark, values, tx.collapse_ws) == [" ".join(v.split()) for v in values]
    assert many(spark, values, tx.word_count) == [len(v.split()) for v in values]


def test_normalize_null(spark):
    assert one(spark, None, tx.normalize_text) == ""


def test_years(spark):
    dates = ["Jan 5, 2024", "2023-04-01T00:00:00", "unknown", "", None, "c12024x", "x 1999y 2001"]
    assert many(spark, dates, tx.extract_year) == [2024, 2023, None, None, None, None, 2001]


def test_sentences_keep_more_than_twenty_characters(spark):
    twenty, longer = "a" * 19 + ".", "b" * 20 + "."
    text = f"  {twenty}  {longer} c? {longer}\n"
    assert one(spark, text, tx.split_sentences) == [longer, longer]


def test_summary_limits(spark):
    def summary(text):
        return one(spark, text, lambda c: lb.summarize(c, tx.split_sentences(c)))

    assert summary("x " * 9 + "end") == "x " * 9 + "end"
    assert summary(("ab " * 100).strip()) != ""
    words = " ".join(["w"] * 10)
    assert summary(words) == words
    short = " ".join(["abc."] * 70)  # pieces are too short to be sentences
    assert summary(short + "d") == (short + "d")[:280] + ("..." if len(short) + 1 > 280 else "")
    assert len(summary("z" * 399 + ".")) == 400
    assert summary("z" * 400 + ".").endswith("...")
    first, second = "The door was blue and old today.", "A refund claim under warranty failed."
    assert summary(f"{first} {second}") == f"{second} {first}"


def test_sentiment_thresholds(spark):
    texts = {
        "": ("neutral", 0.0),
        "fixed scam": ("neutral", 0.0),
        "resolved fixed replaced approved scam fraud worst": ("neutral", 0.1429),
        "resolved fixed approved scam fraud": ("positive", 0.2),
        "delayed": ("negative", -1.0),
        "unhelpful": ("positive", 1.0),
    }
    frame = spark.createDataFrame(
        [(t, None) for t in texts], "review_text string, full_text_with_comments string"
    )
    got = {r.review_text: (r.ai_sentiment, r.ai_sentiment_score)
           for r in enrichment.add_sentiment(frame).collect()}
    assert got == texts


def test_reliability(spark):
    every = ["delivery_issue", "defective_product", "refund_return_issue",
             "warranty_claim_issue", "support_issue", "billing_issue"]
    rows = [(None, ["other"], 100.0), (0.5, ["other"], 46.0), (5.0, ["other"], 100.0),
            (None, every, 56.0), (1.0, every, 8.0)]
    frame = spark.createDataFrame(rows, "rating double, labels array<string>, want double")
    got = frame.select("want", lb.reliability_score(F.col("rating"), F.col("labels"))).collect()
    assert [r[1] for r in got] == [r[0] for r in got]


def test_primary_label_of_nothing(spark):
    assert one(spark, [], lb.primary_label, "array<string>") == "other"
    assert one(spark, None, lb.primary_label, "array<string>") == "other"


def test_urls(spark):
    base = "https://reviews.example.org"
    links = {"/a/b-c12?x=1": base + "/a/b-c12?x=1", "//h/x": "https://h/x", "?q=1": base + "?q=1",
             "#z": base + "#z", "": base, "foo": base + "/foo", "../up": base + "/up",
             "/a/./b/../c": base + "/a/c", "https://x.y/z": "https://x.y/z", "mailto:a@b": "mailto:a@b"}
    assert many(spark, list(links), urls.absolute_url) == list(links.values())
    assert many(spark, [base + "/A-C12", base + "/a-c12?q", base + "/a-c12/x", base + "/c12"],
                urls.is_item_url) == [True, True, False, False]
    assert many(spark, [base + "/a/?q#f", "HTTPS://H/a#b", base + "/"], urls.normalize_url) == [
        base + "/a", "https://H/a", base]
    assert many(spark, [base, base + "/categories/", base + "/categories/x", base + "/login",
                        base + "/phones", base + "/x-c1", base + "/my-cars"],
                urls.is_subcategory_url) == [False, False, True, False, True, False, False]


def test_robots(spark):
    rules = [(False, "/images/"), (True, "/images/full/"), (False, "/?search=*"),
             (False, "/layer-*"), (False, "/x$")]
    paths = ["/images/a", "/images/full/a", "/?search=b", "/layer-1", "/x", "/xy", "/free"]
    got = many(spark, ["https://h" + p for p in paths], lambda c: urls.robots_allowed(c, rules))
    assert got == [False, True, False, False, False, True, True]
    assert many(spark, ["https://h/a"], lambda c: urls.robots_allowed(c, [])) == [True]
