"""The index on disk against searches that fit anew, and what its plans read."""

import random

import pytest
from pyspark.sql import functions as F

import voxmill.__main__ as command
from voxmill.operators import search, search_index, tfidf

RECORD = (
    "seq long, review_text_normalized string, review_text string, has_return_mention boolean, "
    "has_warranty_mention boolean, issue_labels array<string>, review_date string"
)
WORDS = [f"w{i}" for i in range(60)]


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(6)
    rows = []
    for i in range(700):
        # A hot word in every document, ties by equal texts, ids far apart.
        text = "hot " + " ".join(rng.choices(WORDS, [1 / (k + 1) for k in range(60)], k=rng.randint(0, 25)))
        if i % 10 == 0:
            text = "hot w3 w4"
        year = rng.choice(["Mar 3, 1996", "2001-02-03", "unknown", None])
        rows.append((i * 97 - 5000, text, text, i % 3 == 0, i % 4 == 0, [rng.choice("ab"), "c"], year))
    rows.append((10**15, "", "", None, None, None, None))
    return spark.createDataFrame(rows, RECORD).cache()


@pytest.fixture(scope="module")
def index(spark, records, tmp_path_factory):
    kept, search_index.BLOCK_DOCS = search_index.BLOCK_DOCS, 16
    try:
        return search_index.build(records, str(tmp_path_factory.mktemp("index") / "i"), max_features=90)
    finally:
        search_index.BLOCK_DOCS = kept


def results(df):
    return sorted((r.query_no, r["rank"], r.seq, r.similarity) for r in df.collect())


def test_a_table_of_queries_against_one_by_one(spark, records, index):
    rng = random.Random(1)
    asked = [" ".join(rng.choices([*WORDS, "hot", "unknown"], k=rng.randint(0, 5))) for _ in range(22)] + ["", "hot", "w3 w4"]
    queries = spark.createDataFrame(list(enumerate(asked)), "query_no int, query string")
    docs = tfidf.corpus(records, fallback=False).cache()
    model = tfidf.fit(docs, max_features=90)
    for k in (1, 7):
        assert results(search_index.search(index, queries, k)) == results(search.search_batch(docs, model, asked, k))
    assert search_index.search(index, queries, 2000).where("query_no = 0").count() == 701


def test_plans_read_postings_of_the_terms_only(spark, index):
    queries = spark.createDataFrame([(0, "w5 hot")], "query_no int, query string")
    plan = search_index.similar(index, queries, 3)._jdf.queryExecution().toString()
    assert "_tokens" not in plan and "review_text" not in plan
    assert "PushedFilters: [In(index" in plan or "PushedFilters: [IsNotNull(index), In(index" in plan
    largest = index.postings.agg(F.max(F.size("seqs"))).first()[0]
    assert largest == 16  # the hot term is many rows


def test_blocks_that_cannot_win_are_not_scored(spark, records, tmp_path):
    rows = records.where("seq < 20000").select(
        "seq", F.when(F.col("seq") < -3000, "rare rare rare").otherwise("hot rare w1 w2 w3 w4").alias("review_text_normalized")
    )
    kept, search_index.BLOCK_DOCS = search_index.BLOCK_DOCS, 4
    try:
        own = search_index.build(rows, str(tmp_path / "i"))
    finally:
        search_index.BLOCK_DOCS = kept
    queries = spark.createDataFrame([(0, "rare")], "query_no int, query string")
    found = search_index.similar(own, queries, 3)
    assert [r.seq for r in found.orderBy(F.desc("sim"), F.desc("seq")).collect()] == sorted(
        (r.seq for r in rows.where("seq < -3000").collect()), reverse=True)[:3]


@pytest.mark.parametrize("conditions", [
    {"return_only": True}, {"issue": "a"}, {"years": [1996], "include_unknown": True}, {"warranty_only": True, "years": [2001]},
    {"issue": "none"},
])
def test_filters_against_a_fit_on_what_is_left(records, index, conditions):
    for query in ("w2 w3 hot", "nothing known")[:2 if "issue" in conditions else 1]:
        got = search.filtered_search(records, query, 6, index, **conditions).collect()
        kept = records.where(search.filters.condition(**conditions))
        docs = tfidf.corpus(kept, fallback=False)
        want = search.search_batch(docs, tfidf.fit(docs, max_features=90), [query], 6).collect()
        assert sorted((r["rank"], r.seq, r.similarity) for r in got) == sorted((r["rank"], r.seq, r.similarity) for r in want)


def test_empty_corpus(spark, tmp_path):
    own = search_index.build(spark.createDataFrame([], RECORD), str(tmp_path / "i"))
    queries = spark.createDataFrame([(0, "hot")], "query_no int, query string")
    assert search_index.search(own, queries).count() == 0


def test_command_line_builds_and_reads_an_index(spark, records, tmp_path, capsys, monkeypatch):
    from voxmill.plans import catalog

    clean = catalog.staged_clean(spark, "/root/testdata/sf0.001")
    clean.write.json(str(tmp_path / "clean"))
    monkeypatch.setattr(command.SparkSession.builder, "getOrCreate", lambda: spark, raising=False)
    common = ["--input", str(tmp_path / "clean"), "--format", "jsonl"]
    command.main(["index", *common, "--output", str(tmp_path / "index")])
    command.main(["search", "warranty claim", *common, "--index", str(tmp_path / "index"), "--top-k", "2"])
    assert "similarity" in capsys.readouterr().out


def test_many_queries_by_chunks(spark, records, index, monkeypatch):
    """Tables of many queries give the rows of the other way, through several chunks and parts of queries."""
    rng = random.Random(3)
    asked = [" ".join(rng.choices([*WORDS, "hot", "unknown"], k=rng.randint(0, 5))) for _ in range(40)]
    queries = spark.createDataFrame([*enumerate(asked), (None, "hot")], "query_no long, query string")
    want = {k: results(search_index.search(index, queries, k)) for k in (1, 7, 800)}
    monkeypatch.setattr(search_index, "MANY_QUERIES", 5)
    monkeypatch.setattr(search_index, "CHUNK_BLOCKS", 4)
    monkeypatch.setattr(search_index, "CHUNK_QUERIES", 15)
    for k, rows in want.items():
        assert results(search_index.search(index, queries, k)) == rows
    plan = search_index.similar(index, queries, 7)._jdf.queryExecution().toString()
    assert "CoGroupsInArrow" in plan and "search-bounds" not in plan


def test_vectors_are_not_ranked_in_one_task(spark, records, tmp_path, monkeypatch):
    """Blocks are dealt by a table of numbers: no vector goes through the ranking by ``seq``."""
    ranked = []
    kept = search_index.numbering.positions
    monkeypatch.setattr(search_index.numbering, "positions",
                        lambda df, *rest: ranked.append(df.columns) or kept(df, *rest))
    # A number that stands twice keeps its two rows.
    twice = records.where("seq < 3000").unionByName(records.where("seq = -4903"))
    own = search_index.build(twice, str(tmp_path / "i"))
    assert ranked == [["seq"]]
    assert own.postings.select(F.explode("seqs").alias("seq"), "index").where("seq = -4903").groupBy("index").count().where(
        "count <> 2").count() == 0
