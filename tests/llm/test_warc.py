"""WARC archives and their index against plain versions."""

import base64
import glob
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from voxmill.llm import warc
from voxmill.sources.staging import scratch_path

PAGE = "page_id long, url string, html string, payload string, file string, nth long"


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(8)
    html = ["<p>same</p>", "", "<p>ünï 日本</p>", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n", "x" * 400_000]
    urls = ["https://A.example.org:8080/a?b=1#c", "http://b.example.org", "no scheme", "", None, "http://x.org/line\r\nWARC-Type: revisit"]
    rows = [(i, rng.choice(urls), rng.choice(html) if i % 3 else f"<p>{rng.random()}</p>", "clash", "f", 3) for i in range(1, 400)]
    rows += [(5000 + i, "http://hot.example.org/", None, None, None, None) for i in range(900)]  # one url, one payload
    rows += [rows[0], rows[1], (None, "http://x.org/", "<p>same</p>", None, None, None), (None, None, "only nulls", None, None, None), (None, None, "only nulls", None, None, None)]
    return spark.createDataFrame(rows, PAGE).repartition(7)


def plainly(pages, least=0):
    first = {}
    for r in pages:
        digest = hashlib.sha1((r["html"] or "").encode()).digest()
        if r["page_id"] is not None and len((r["html"] or "").encode()) >= least:
            first[digest] = min(first.get(digest, r["page_id"]), r["page_id"])
    out = []
    for r in pages:
        payload = (r["html"] or "").encode()
        digest = hashlib.sha1(payload).digest()
        response = first.get(digest, r["page_id"])
        refers = None if response == r["page_id"] else response
        out.append((r["page_id"], len(payload), base64.b32encode(digest).decode(), "response" if refers is None else "revisit", refers))
    return sorted(out, key=repr)


NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def test_query_against_plain_version(pages):
    got = warc.query(pages).collect()
    assert sorted((tuple(r[n] for n in NAMES) for r in got), key=repr) == plainly(pages.collect())
    assert sorted(r["index_position"] for r in got) == list(range(1, len(got) + 1))
    ordered = sorted(got, key=lambda r: r["index_position"])
    keys = [(r["url_key"], r["captured_at"], r["page_id"] is not None, r["page_id"] or 0) for r in ordered]
    assert keys == sorted(keys)
    seen = {}
    for r in ordered:
        seen[r["url_key"]] = seen.get(r["url_key"], 0) + 1
        assert r["capture_no"] == seen[r["url_key"]]


def test_files_are_gzipped_warc_and_hold_the_payloads(spark, pages, monkeypatch):
    path = scratch_path(spark, "warc-test")
    warc.write(pages, path, least=5)
    files = glob.glob(f"{path}/part-*")
    assert sum(gzip.open(f).read().count(b"WARC-Record-ID: ") for f in files) == pages.count()
    runs = warc.read(spark, path)
    rows = runs.collect()
    assert sorted((tuple(r[n] for n in NAMES) for r in rows), key=repr) == plainly(pages.collect(), least=5)
    texts = {r["page_id"]: r["html"] or "" for r in pages.collect()}
    for r in rows:
        if r["record_type"] == "revisit":
            assert r["payload"] is None
        elif r["page_id"] is not None:
            assert bytes(r["payload"]).decode() == texts[r["page_id"]]
        with open(r["file"].removeprefix("file:"), "rb") as file:  # the entry leads to the record
            file.seek(r["offset"])
            fields, _, size = warc.parse(gzip.decompress(file.read(r["length"])))
        assert size == r["payload_bytes"] and fields["warc-type"] == r["record_type"]


def test_a_file_ends_once_it_is_large_enough(spark):
    noise = F.concat_ws("", F.transform(F.sequence(F.lit(0), F.lit(400)), lambda i: F.sha2(F.concat("id", i.cast("string")), 512)))
    pages = spark.range(900).coalesce(1).select(
        F.col("id").alias("page_id"), F.lit("http://a.org/").alias("url"), noise.alias("html")
    )
    path = scratch_path(spark, "warc-test")
    warc.write(pages, path)
    sizes = [len(open(f, "rb").read()) for f in glob.glob(f"{path}/part-*")]
    assert len(sizes) >= 2 and max(sizes) < warc.FILE_BYTES + 100_000
    assert warc.read(spark, path, with_payload=False).count() == 900


def test_merge_against_sorting():
    rng = random.Random(2)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted(rng.randint(0, 40) for _ in range(rng.randint(0, 30))) for _ in range(k)]
        assert list(warc.merge([iter(r) for r in runs])) == sorted(sum(runs, []))


def test_url_keys():
    assert warc.url_key("http://WWW.Example.org/A?b#c") == "org,example,www)/A?b#c"
    assert warc.url_key("https://example.org:81") == "org,example:81)"
    assert warc.url_key("mailto:x") == ")mailto:x"


def test_damage_is_reported():
    good = warc.record(1, "http://a.org/", 0, b"abc", 3, base64.b32encode(hashlib.sha1(b"abc").digest()).decode(), None)
    content = warc.member(good) + warc.member(good.replace(b"abc", b"abd"))
    with pytest.raises(ValueError, match=rf"f, offset {len(warc.member(good))}: the payload"):
        warc.entries("f", content, False)
    with pytest.raises(ValueError, match="ends early"):
        warc.entries("f", warc.member(good)[:-5], False)
    with pytest.raises(ValueError, match="not as long"):
        warc.entries("f", warc.member(good[:-6]), False)


def test_empty_table(spark):
    assert warc.query(spark.createDataFrame([], PAGE)).count() == 0
