"""Token ids in compressed binary files.

Texts are encoded with the tokenizers library, an end id follows each, and the ids are written in
ascending order of ``doc_id`` (nulls first, equal ids by text). A file belongs to one range of
ids and holds segments: rows of whole documents with their ids and lengths, and a payload of a
prior and blocks (see ``range_coder``). A segment can be read by itself; ``start`` comes from the totals of
the segments before it.

Null texts count as empty and have the end id only. An empty table makes an empty file set.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voxmill.llm.bpe import byte_letters
from voxmill.llm.range_coder import Prior, block_for, decode_blocks, encode_counted
from voxmill.llm.rows import map_batches, map_slices, small_side
from voxmill.sources.shipping import ship_package
from voxmill.sources.staging import scratch_path

END_ID = 1
#: A segment is closed once it holds this many ids.
SEGMENT_IDS = 8 * 1024 * 1024
CACHE_CHUNKS = 700_000
#: White space of the tokenizer's pattern; its words never hold any, so parts between are independent.
_CHUNK = re.compile("[^\t-\r \x85\xa0  -     　]+")
_CONTROLS = "\x1c\x1d\x1e\x1f"  # white space for str.split() only
#: Marks that the tokenizer's pattern never joins with letters, and keeps together at the end of a part.
_MARKS = ".,!?;:"
#: Words of letters whose lower case and composition are theirs alone.
_PLAIN = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+").fullmatch
_LETTERS = byte_letters()
#: Parts asked for in one text.
_TOGETHER = 256

SEGMENTS = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("segment", T.IntegerType()),
    T.StructField("n_ids", T.LongType()), T.StructField("doc_ids", T.ArrayType(T.LongType())),
    T.StructField("lengths", T.ArrayType(T.LongType())), T.StructField("payload", T.BinaryType()),
])


class Encoder:
    """The tokenizers library, asked once for every distinct part between white space.

    A part of plain letters and closing marks is one word and its marks, whose ids do not depend on
    each other or on the case. The lower-cased word goes straight to the library's model, in byte
    letters. All else is asked for in texts of many parts, joined by a special token, and the ids
    are cut where it stands.
    """

    def __init__(self, content: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = re.compile("|".join(re.escape(t.content) for t in added.values()) or "(?!)").search
        self.between = next((
            (t.content, i) for i, t in added.items()
            if t.special and not (t.normalized or t.single_word or t.lstrip or t.rstrip)
        ), None)
        self.model = self.tokenizer.model
        self.letters = {c: "".join(_LETTERS[b] for b in chr(c).encode()) for c in range(0x80, 0x100)}
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {"": b""}

    def _ask_words(self, words: set[str]) -> None:
        tokenize, letters = self.model.tokenize, self.letters
        for word in words:
            ids = [t.id for t in tokenize(word if word.isascii() else word.translate(letters))]
            self.pieces[word] = struct.pack(f"<{len(ids)}I", *ids)

    def _ask(self, pieces: set[str]) -> None:
        """Put the ids of ``pieces`` into ``self.pieces``."""
        alone = pieces if not self.between else [p for p in pieces if self.special(p)]
        for piece in alone:
            ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        if not self.between:
            return
        token, id_ = self.between
        rest = [p for p in pieces if p not in self.pieces]
        groups = [rest[at:at + _TOGETHER] for at in range(0, len(rest), _TOGETHER)]
        joined = [token.join(g) for g in groups]
        for group, made in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(made.ids, "<u4")
            raw, start = ids.tobytes(), 0
            for piece, cut in zip(group, [*(4 * np.flatnonzero(ids == id_)).tolist(), len(raw)]):
                self.pieces[piece] = raw[start:cut]
                start = cut + 4

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian 32-bit integers."""
        if len(self.known) > CACHE_CHUNKS:
            self.known.clear()
        if len(self.pieces) > CACHE_CHUNKS:
            self.pieces = {"": b""}
        known, pieces = self.known, self.pieces
        parts = [_CHUNK.findall(t) if any(map(t.count, _CONTROLS)) else t.split() for t in texts]
        found = [list(map(known.get, own)) for own in parts]
        fresh = {p for own, ids in zip(parts, found) if None in ids for p, i in zip(own, ids) if i is None}
        words = [p.rstrip(_MARKS) for p in fresh]
        plain = [w.isascii() and w.isalpha() or _PLAIN(w) is not None for w in words]
        heads = [w.lower() if yes else p for p, w, yes in zip(fresh, words, plain)]
        tails = [p[len(w):] if yes else "" for p, w, yes in zip(fresh, words, plain)]
        self._ask_words({h for h, yes in zip(heads, plain) if yes and h not in pieces})
        self._ask(set(heads).union(tails).difference(pieces))
        for part, head, tail in zip(fresh, heads, tails):
            known[part] = pieces[head] + pieces[tail]
        return [
            b"".join([known[p] if i is None else i for p, i in zip(own, ids)] if None in ids else ids)
            for own, ids in zip(parts, found)
        ]


@lru_cache(maxsize=1)
def _encoder(shared) -> Encoder:
    return Encoder(shared.value)


def pack(blocks: list[bytes]) -> bytes:
    return b"".join(struct.pack("<I", len(b)) + b for b in blocks)


def unpack(payload: bytes) -> list[bytes]:
    blocks, at = [], 0
    while at < len(payload):
        size = struct.unpack_from("<I", payload, at)[0]
        blocks.append(payload[at + 4:at + 4 + size])
        at += 4 + size
    return blocks


def write(docs: DataFrame, path: str, tokenizer: str, text: str = "text", end_id: int = END_ID) -> None:
    """Write ``docs`` (doc_id, text) to ``path``: as many files as there are shuffle partitions."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    ship_package(spark)
    target = to_arrow_schema(SEGMENTS)
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = _encoder(shared), TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        names: list[int] = []
        lengths: list[int] = []

        def segment():
            joined = np.frombuffer(b"".join(ids), "<u4")
            prior, blocks = encode_counted(joined, block_for(len(joined)))
            payload = pack([prior.to_bytes(), *blocks])
            return pa.RecordBatch.from_pylist([{
                "part": part, "segment": number, "n_ids": len(joined), "doc_ids": names,
                "lengths": lengths, "payload": payload,
            }], schema=target)

        held = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                texts = [t or "" for t in some.column(1).to_pylist()]
                for name, made in zip(some.column(0).to_pylist(), encoder.encode(texts)):
                    ids.append(made + end)
                    names.append(name)
                    lengths.append(len(ids[-1]) // 4)
                    held += lengths[-1]
                    if held >= SEGMENT_IDS:
                        yield segment()
                        number, held = number + 1, 0
                        ids, names, lengths = [], [], []
        if names:
            yield segment()

    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("_text"))
    ordered = rows.repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id", "_text")
    map_batches(ordered, run, SEGMENTS).write.parquet(path)


_DOC = T.StructType([
    T.StructField("part", T.IntegerType()), T.StructField("segment", T.IntegerType()),
    T.StructField("doc_id", T.LongType()), T.StructField("local", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
    T.StructField("ids_crc32", T.LongType()),
])


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids (little-endian 32-bit), ids_crc32 of every document of the files."""
    files = spark.read.schema(SEGMENTS).parquet(path)

    def work(parts, numbers, names, lengths, payloads):
        for part, number, docs, sizes, payload in zip(parts, numbers, names, lengths, payloads):
            prior, *blocks = unpack(payload)
            data = decode_blocks(blocks, Prior.from_bytes(prior)).tobytes()
            at = 0
            for doc, size in zip(docs, sizes):
                own = data[4 * at:4 * (at + size)]
                yield part, number, doc, at, size, own if with_ids else None, zlib.crc32(own)
                at += size

    docs = map_slices(files.select("part", "segment", "doc_ids", "lengths", "payload"), _DOC, work, rows=1)
    sizes = files.select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("all"))  # one row per file
    parts = parts.select("part", (F.sum("all").over(W.orderBy("part")) - F.col("all")).alias("base"))
    within = F.sum("n_ids").over(W.partitionBy("part").orderBy("segment")) - F.col("n_ids")
    starts = sizes.withColumn("within", within).join(parts, "part")
    starts = starts.select("part", "segment", (F.col("base") + F.col("within")).alias("first"))
    return docs.join(small_side(starts), ["part", "segment"]).select(
        "doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids", "ids_crc32"
    )


def query(docs: DataFrame, tokenizer: str) -> DataFrame:
    path = scratch_path(docs.sparkSession, "token-files")
    write(docs, path, tokenizer)
    return read(docs.sparkSession, path, with_ids=False).drop("ids")
