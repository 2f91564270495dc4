"""Positions for any ids, copies dropped without shuffling records, filters below the text work."""

import random

from pyspark.sql import functions as F

from voxmill import schemas
from voxmill.operators import cleaning, filters, numbering
from voxmill.sources import testviews as tv

SF = "/root/testdata/sf0.001"


def test_positions_of_ids_over_all_64_bits(spark):
    draw = random.Random(5)
    seqs = [draw.randrange(-(2**63), 2**63) for _ in range(500)] + [-(2**63), 2**63 - 1]
    frame = spark.createDataFrame([(s,) for s in seqs], "seq long")
    got = numbering.positions(frame, "seq", "p")
    assert [r.seq for r in got.orderBy("p").collect()] == sorted(seqs)
    assert [r.p for r in got.orderBy("p").collect()] == list(range(1, 503))


def test_many_levels_of_totals(spark, monkeypatch):
    monkeypatch.setattr(numbering, "FAN", 4)
    frame = spark.range(0, 3000, 7).withColumnRenamed("id", "seq").withColumn("v", F.col("seq"))
    got = numbering.running_total(frame, "seq", "v", "t", width=10).collect()
    assert len(got) == 429 and all(r.t == r.seq * (r.seq // 7 + 1) // 2 for r in got)


def test_positions_of_nothing(spark):
    assert numbering.positions(spark.range(0).withColumnRenamed("id", "seq"), "seq", "p").count() == 0


def test_records_are_not_shuffled_for_copies_and_ids(spark):
    raw = schemas.complete(tv.raw_reviews(spark, SF), schemas.RAW_REVIEW)
    staged = cleaning.stage(raw, "raw")
    got = cleaning.dedup_and_number(staged)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 1 and plan.count("strategy=broadcast") == 2
    assert got.count() == cleaning.dedup_reviews(staged).count()


def test_year_filter_before_the_text_work(spark):
    raw = cleaning.stage(tv.raw_reviews(spark, SF), "raw")
    early = cleaning.clean_reviews(raw, where=filters.in_years([1996], True))
    late = filters.filter_years(cleaning.clean_reviews(raw), [1996], True)
    columns = ["seq", "record_id", "review_text_normalized", "issue_labels"]
    assert early.select(columns).orderBy("seq").collect() == late.select(columns).orderBy("seq").collect()
    lines = early._jdf.queryExecution().optimizedPlan().toString().splitlines()
    text = max(i for i, line in enumerate(lines) if "http[^" in line)
    assert any("Filter" in line and "review_date" in line for line in lines[text + 1:])


def test_metrics_and_years(spark):
    rows = [(1, "a", ["x"], "Jan 1, 2020"), (2, None, ["x"], "unknown"), (3, "a", ["x"], None),
            (4, "b", None, "Jan 2, 2021")]
    frame = spark.createDataFrame(
        rows, "seq long, company string, issue_labels array<string>, review_date string"
    ).withColumn("review_updated_date", F.lit(None).cast("string"))
    one = filters.dataset_metrics(frame, issue="x").first()
    assert (one.total_records, one.filtered_records, one.distinct_companies) == (4, 3, 2)
    none = filters.dataset_metrics(frame.limit(0), issue="x").first()
    assert (none.total_records, none.filtered_records, none.distinct_companies) == (0, 0, 0)
    assert [r.year for r in filters.recent_years(frame, 2021).collect()] == [2021]
    assert [r.year for r in filters.recent_years(frame, 2030).collect()] == [2021, 2020]
