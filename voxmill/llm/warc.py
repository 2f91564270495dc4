"""WARC archives of pages, and an index of their captures.

``write`` makes one WARC/1.1 record a row, each its own gzip member. Rows with equal payloads of at
least ``least`` bytes are one ``response``, that with the smallest id, and ``revisit`` records that
refer to it and hold the HTTP headers only. A file ends after the record that brings it to
``FILE_BYTES``. Files are written by Spark's text writer, which needs a line separator: it is an empty
gzip member, so that every file is a valid ``.warc.gz`` whatever its name.

``read`` takes the files apart again, one after the other, and checks lengths and digests; a damaged
record raises an error that names file and offset.

External index merge. The entries of a file, sorted by URL key and time, are a run. All entries are
dealt into ranges of keys, of ``RANGE_ROWS`` rows on average at most; in each range the slices of the runs are merged by a
tree of losers. File and offset are part of the key, so a range never has to hold one URL as a whole. The
driver gets one row a range, to number the captures from first to last and within each URL.

Null payloads are empty. A null url is written as an empty one; control characters in it are percent-encoded.
Null ids: they are never the smallest; where all are null, all are responses. Rows with the same id as the response are
responses, too, under the same record id. Other columns, of any name, are left out. An empty table
makes an empty archive and index.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
import time
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voxmill.llm.rows import small_side
from voxmill.sources.shipping import ship_package
from voxmill.sources.staging import scratch_path, stage

FILE_BYTES = 16 << 20
RANGE_ROWS = 200_000
LEVEL = 6
#: Rows that a worker takes out of an Arrow batch at a time.
SLICE = 64
#: First second of capture times that are made from ids, and how many of them there are.
FIRST_SECOND, SECONDS = 1_577_836_800, 1_000_000_000

_VERSION = b"WARC/1.1\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ID = "<urn:page:{}>"
_CONTROL = re.compile("[\x00-\x1f\x7f]")
_EMPTY_MEMBER = zlib.compressobj(9, zlib.DEFLATED, 31).flush()


# Records


def url_key(url: str) -> str:
    """Host labels from the top down, port, then what follows: ``org,example)/a?b``."""
    scheme, found, rest = url.partition("://")
    if not found:
        return f"){url}"
    authority = re.match(r"[^/?#]*", rest)[0]
    host, port = re.fullmatch(r"(.*?)(:[0-9]+)?", authority, re.DOTALL).groups()
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return ",".join(reversed(lowered.split("."))) + (port or "") + ")" + rest[len(authority):]


def record(id_: int | None, url: str, seconds: int, payload: bytes, size: int, digest: str, refers_to: int | None) -> bytes:
    """One record; ``refers_to`` makes it a revisit, without payload, of ``size`` bytes all the same."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    name = lambda x: _ID.format("-" if x is None else x)
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", name(id_)),
        ("WARC-Date", time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime(seconds))),
        ("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
    ]
    if refers_to is not None:
        fields += [("WARC-Refers-To", name(refers_to)), ("WARC-Profile", _PROFILE)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "".join(f"{k}: {v}\r\n" for k, v in fields).encode()
    return b"".join([_VERSION, head, b"\r\n", block, b"\r\n\r\n"])


def member(data: bytes) -> bytes:
    made = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return made.compress(data) + made.flush()


def members(content: bytes, step: int = 1 << 16) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, data) of each gzip member that holds anything."""
    view, at = memoryview(content), 0
    while at < len(view):
        inflate, start, parts = zlib.decompressobj(31), at, []
        while not inflate.eof:
            if at >= len(view):
                raise ValueError(f"record at {start} ends early")
            piece = view[at:at + step]
            parts.append(inflate.decompress(piece))
            at += len(piece) - len(inflate.unused_data)
        data = b"".join(parts)
        if data:
            yield start, at - start, data


def parse(data: bytes) -> tuple[dict[str, str], bytes, int]:
    """(fields by lower-case name, payload, its full size) of one record."""
    head, found, rest = data.partition(b"\r\n\r\n")
    if not (found and head.startswith(_VERSION)):
        raise ValueError("no record begins here")
    lines = head.decode().split("\r\n")[1:]
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    size = int(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("the block is not as long as its record says")
    http, _, payload = rest[:size].partition(b"\r\n\r\n")
    full = int(re.search(rb"(?im)^content-length: *([0-9]+)\r?$", http)[1])
    if fields["warc-type"] == "response":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if full != len(payload) or fields["warc-payload-digest"] != f"sha1:{digest}":
            raise ValueError("the payload is not what its digest says")
    return fields, payload, full


# Archives


def seconds_of(id_: Column) -> Column:
    """A capture time for rows that have none: one second per id."""
    return F.lit(FIRST_SECOND) + F.pmod(F.coalesce(id_, F.lit(0)).cast("long"), F.lit(SECONDS))


def _linked(pages: DataFrame, seconds: Column | None, least: int) -> DataFrame:
    """page_id, url, seconds, payload, sha1, first: the response's id, null on responses."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("url", F.lit("")).alias("url"),
        (seconds_of(F.col("page_id")) if seconds is None else seconds).cast("long").alias("seconds"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    )
    rows = rows.withColumn("sha1", F.sha1("payload"))
    # Narrow rows, counted per task first: copies of one payload meet as a few sums.
    several = stage(
        rows.where(F.octet_length("payload") >= least).groupBy("sha1")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 AND first IS NOT NULL")
        .select("sha1", "first"),
        "warc-copies",
    )
    joined = rows.join(small_side(several, 80), "sha1", "left")
    own = F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "seconds", "payload", "sha1", F.when(~own, F.col("first")).alias("first"))


_FILE = T.StructType([T.StructField("members", T.BinaryType())])


def write(pages: DataFrame, path: str, seconds: Column | None = None, least: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) to gzipped WARC files in the folder ``path``.

    ``seconds``: the capture time, in seconds since 1970; made from the id by default.
    """
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def file():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], ["members"])

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                columns = (c.to_pylist() for c in batch.slice(at, SLICE).columns)
                for id_, url, second, payload, sha1, first in zip(*columns):
                    digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                    held.append(member(record(id_, url, second, payload, len(payload), digest, first)))
                    size += len(held[-1])
                    if size >= FILE_BYTES:
                        yield file()
                        held, size = [], 0
        if held:
            yield file()

    files = _linked(pages, seconds, least).mapInArrow(run, _FILE)
    # The cast passes the bytes on as they are.
    files.select(F.col("members").cast("string").alias("value")).write.options(
        maxRecordsPerFile=1, lineSep=_EMPTY_MEMBER.decode("latin-1"), encoding="ISO-8859-1"
    ).text(path)


_ENTRY = [
    T.StructField("url_key", T.StringType()), T.StructField("captured_at", T.StringType()),
    T.StructField("page_id", T.LongType()), T.StructField("file", T.StringType()),
    T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
]
_RUN = T.StructType([*_ENTRY, T.StructField("url", T.StringType()), T.StructField("payload", T.BinaryType())])


def _order(entry: tuple) -> tuple:
    """URL key, time, id (nulls first), then the place in the archive, which no other entry has."""
    key, at, id_, file, offset = entry[:5]
    return key, at, id_ is not None, id_ or 0, file, offset


def entries(file: str, content: bytes, with_payload: bool) -> list[tuple]:
    """The entries of one file as a run: in order."""
    page = lambda x: None if x is None or x == _ID.format("-") else int(x[len(_ID) - 3:-1])
    found = []
    for offset, length, data in members(content):
        try:
            fields, payload, size = parse(data)
        except (ValueError, KeyError, TypeError) as error:
            raise ValueError(f"{file}, offset {offset}: {error}") from error
        url, kind = fields.get("warc-target-uri", ""), fields["warc-type"]
        found.append((
            url_key(url), re.sub("[^0-9]", "", fields["warc-date"]), page(fields["warc-record-id"]), file, offset, length,
            size, fields["warc-payload-digest"].removeprefix("sha1:"), kind, page(fields.get("warc-refers-to")),
            url, payload if with_payload and kind == "response" else None,
        ))
    return sorted(found, key=_order)


def _batch(rows: list[tuple], target: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), target)], schema=target)


def read(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row a record: index entry, ``url`` and, for responses if asked for, the ``payload``.

    The rows of a ``file`` come in the order of the index.
    """
    ship_package(spark)
    target = to_arrow_schema(_RUN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = entries(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), with_payload)
                for at in range(0, len(made), SLICE if with_payload else 10_000):
                    yield _batch(made[at:at + (SLICE if with_payload else 10_000)], target)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, _RUN)


# Index


def merge(runs: list[Iterator[tuple]]) -> Iterator[tuple]:
    """The items of sorted runs in order, by a tree of losers.

    Every inner node keeps the run that lost there. When the winner moves on, only the matches on
    its way to the root are played again.
    """
    k = len(runs)
    if not k:
        return
    heads = [next(r, None) for r in runs]

    def first(a: int, b: int) -> bool:
        return heads[b] is None or heads[a] is not None and heads[a] <= heads[b]

    winners, losers = [0] * k + list(range(k)), [0] * k
    for node in range(k - 1, 0, -1):
        a, b = winners[2 * node], winners[2 * node + 1]
        winners[node], losers[node] = (a, b) if first(a, b) else (b, a)
    winner = winners[1]
    while heads[winner] is not None:
        yield heads[winner]
        heads[winner] = next(runs[winner], None)
        node = (winner + k) // 2
        while node:
            if first(losers[node], winner):
                losers[node], winner = winner, losers[node]
            node //= 2


_MERGED = T.StructType([
    *_ENTRY, T.StructField("range", T.IntegerType()), T.StructField("place", T.LongType()),
    T.StructField("nth", T.LongType()),
])


def _merged(runs: DataFrame, rows: int) -> DataFrame:
    """``runs`` in ranges of keys, each in order: with ``place`` in its range and ``nth`` of its URL there."""
    target = to_arrow_schema(_MERGED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices: dict[str, list[tuple]] = {}
        for batch in batches:
            for entry in zip(*(c.to_pylist() for c in batch.columns)):
                slices.setdefault(entry[3], []).append((_order(entry), entry))
        number, made, last, nth = TaskContext.get().partitionId(), [], None, 0
        for place, (_, entry) in enumerate(merge([iter(s) for s in slices.values()])):
            nth = nth + 1 if entry[0] == last else 1
            last = entry[0]
            made.append((*entry, number, place, nth))
            if len(made) == 10_000:
                yield _batch(made, target)
                made = []
        if made:
            yield _batch(made, target)

    order = ["url_key", "captured_at", "page_id", "file", "offset"]
    ranges = max(int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / RANGE_ROWS))
    dealt = runs.select(*(f.name for f in _ENTRY)).repartitionByRange(ranges, *order)
    # Each run's slice stays in the order of its run.
    return dealt.sortWithinPartitions("file", *order).mapInArrow(run, _MERGED)


def index(runs: DataFrame) -> DataFrame:
    """Entries with ``index_position`` (from 1) and ``capture_no`` within the history of their URL.

    ``runs``: entries as ``read`` gives them, from a stage table.
    """
    spark = runs.sparkSession
    made = stage(_merged(runs, runs.count()), "warc-index")
    ranges = made.groupBy("range").agg(
        F.count(F.lit(1)).alias("n"), F.min("url_key").alias("first"), F.max("url_key").alias("last"),
        F.max_by("nth", "place").alias("tail"),
    ).collect()  # one row a range
    before, url, seen, bases = 0, None, 0, []
    for r in sorted(ranges, key=lambda r: r["range"]):
        bases.append((r["range"], before, r["first"], seen if r["first"] == url else 0))
        seen = r["tail"] + (bases[-1][-1] if r["first"] == r["last"] else 0)
        before, url = before + r["n"], r["last"]
    base = spark.createDataFrame(bases, "range int, before long, first string, seen long")
    return made.join(F.broadcast(base), "range").select(
        *(f.name for f in _ENTRY), (F.col("before") + F.col("place") + 1).alias("index_position"),
        (F.col("nth") + F.when(F.col("url_key") == F.col("first"), F.col("seen")).otherwise(0)).alias("capture_no"),
    )


def query(pages: DataFrame) -> DataFrame:
    """Archives written, read back and indexed."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write(pages, path)
    runs = stage(read(spark, path, with_payload=False), "warc-runs")
    return index(runs).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "captured_at",
        "capture_no", "index_position",
    )


ORACLE = r"""
WITH p AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS x FROM pages),
k AS (
  SELECT *, min(page_id) OVER (PARTITION BY x) AS first,
         regexp_extract(url, '://([^/?#]*)', 1) AS authority,
         substr(url, strpos(url, '://') + 3) AS rest,
         list_transform(range(0, 8), lambda i: CAST('0x' || x[5 * i + 1:5 * i + 5] AS BIGINT)) AS groups FROM p),
h AS (
  SELECT *, regexp_extract(authority, '^(.*?)(:[0-9]+)?$', 1) AS host,
         regexp_extract(authority, '^(.*?)(:[0-9]+)?$', 2) AS port FROM k),
e AS (
  SELECT *, CASE WHEN NOT contains(url, '://') THEN ')' || url
              ELSE array_to_string(list_reverse(string_split(lower(host), '.')), ',') || port || ')'
                   || substr(rest, length(authority) + 1) END AS url_key,
         strftime(make_timestamp(1000000 * (1577836800 + ((page_id % 1000000000) + 1000000000) % 1000000000)),
                  '%Y%m%d%H%M%S') AS captured_at,
         array_to_string(list_transform(groups, lambda g:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((g >> 15) & 31 AS INT) + 1, 1)
           || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((g >> 10) & 31 AS INT) + 1, 1)
           || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((g >> 5) & 31 AS INT) + 1, 1)
           || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(g & 31 AS INT) + 1, 1)), '') AS payload_digest
  FROM h)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to, url_key, captured_at,
       row_number() OVER (PARTITION BY url_key ORDER BY captured_at, page_id) AS capture_no,
       row_number() OVER (ORDER BY url_key, captured_at, page_id) AS index_position
FROM e
"""
