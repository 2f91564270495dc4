"""BPE encoding and decoding by longest matches, a pair table and backtracking.

Tokens are found by an Aho-Corasick automaton. From left to right the longest token is taken that
the pair table allows after the token before it; when none fits, the last token gives way to the
next shorter one. Two tokens are compatible if BPE leaves them apart when it meets them alone, and
then the sequence is what the merges give. Positions that led nowhere are remembered, so the work
is linear in the text.

Words are the pieces the tokenizer file names: special tokens first, then NFC, lower case and its
split pattern. White space is never part of a word, so that a chunk between white space is
encoded by itself and kept in a bounded cache. Null texts count as empty; empty texts have no ids.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from functools import lru_cache

import ahocorasick
import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill.llm.rows import map_slices

_END = "\U0010fffe"
#: Chunks, and words, whose ids a worker keeps; a full cache starts anew.
CACHE_CHUNKS = 150_000
#: White space as the split pattern's \s sees it; str.split() takes four controls more.
_SPACE = r"\t-\r \x85\xa0  -     　"
_CHUNKS = regex.compile(f"[^{_SPACE}]+")
_CONTROL = regex.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable letter that byte-level BPE writes for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Bpe:
    """A tokenizer file of the kind with word ends, read once per worker."""

    def __init__(self, content: str):
        data = json.loads(content)
        model = data["model"]
        suffix = model["end_of_word_suffix"]
        ids = {self._inner(t, suffix): i for t, i in model["vocab"].items()}
        self.pairs: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int]] = {}
        self.rank: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = (self._inner(x, suffix) for x in (merge.split(" ") if isinstance(merge, str) else merge))
            whole = ids[a + b]
            self.pairs[ids[a], ids[b]] = whole
            self.made[whole] = (ids[a], ids[b])
            self.rank[whole] = rank
        self.length = {i: len(t) for t, i in ids.items()}
        self.shorter: dict[int, int | None] = {}
        self.automaton = ahocorasick.Automaton()
        for token, i in ids.items():
            self.automaton.add_word(token, (i, len(token) - 1))
            at = next((n for n in range(len(token) - 1, 0, -1) if token[:n] in ids), 0)
            self.shorter[i] = ids[token[:at]] if at else None
        self.automaton.make_automaton()
        self.whole = {t: i for t, i in ids.items() if t.endswith(_END)}
        self.allowed: dict[int, bool] = {}
        split = data["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(split, regex.V1)
        self.letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.special_split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.cache: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        # The offset table: token i is blob[offset[i]:offset[i + 1]], with the space that joins it.
        names = {i: t for t, i in model["vocab"].items()} | {i: t for t, i in self.special.items()}
        raw = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.blob = np.frombuffer(b"".join(raw), np.uint8)
        self.offset = np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)

    @staticmethod
    def _inner(token: str, suffix: str) -> str:
        return token[: -len(suffix)] + _END if suffix and token.endswith(suffix) else token

    def compatible(self, left: int, right: int) -> bool:
        """Whether BPE keeps ``left`` and ``right`` apart.

        Take the merges that made the two back, latest first. If the symbols that then face each
        other merge earlier than the merge taken back last, BPE would have joined them there.
        A merge to the left goes first among equals.
        """
        key = left << 16 | right
        pairs, rank, made = self.pairs, self.rank, self.made
        bound, apart = len(rank), True
        while True:
            joined = pairs.get((left, right))
            if joined is not None and rank[joined] < bound:
                apart = False
                break
            of_left, of_right = rank.get(left, -1), rank.get(right, -1)
            if of_left < 0 and of_right < 0:
                break
            if of_left > of_right:
                left, bound = made[left][1], of_left
            else:
                right, bound = made[right][0], of_right + 1
        self.allowed[key] = apart
        return apart

    def word(self, letters: str) -> list[int]:
        """Ids of one word, given as byte letters and the end mark."""
        whole = self.whole.get(letters)
        if whole is not None:
            return [whole]
        size = len(letters)
        length, shorter, allowed = self.length, self.shorter, self.allowed
        longest: list[int | None] = [None] * size
        for end, (token, back) in self.automaton.iter(letters):
            longest[end - back] = token  # a later match from a place is longer
        at, taken, dead = 0, [], set()
        token, before = longest[0], None
        while True:
            while token is not None:
                end = at + length[token]
                if not dead or end not in dead:
                    if before is None:
                        break
                    fits = allowed.get(before << 16 | token)
                    if fits is None:
                        fits = self.compatible(before, token)
                    if fits:
                        break
                token = shorter[token]
            if token is None:
                dead.add(at)
                token = taken.pop()
                at -= length[token]
                token = shorter[token]
                before = taken[-1] if taken else None
                continue
            taken.append(token)
            if end == size:
                return taken
            at, before, token = end, token, longest[end]

    def chunk(self, chunk: str) -> bytes:
        """Ids of a text without white space, as little-endian 32-bit integers."""
        parts: list[bytes] = []
        words = self.words
        for piece in self.special_split.split(chunk) if "<|" in chunk else [chunk]:
            if piece in self.special:
                parts.append(struct.pack("<I", self.special[piece]))
                continue
            plain = unicodedata.normalize("NFC", piece)
            plain = plain.lower() if "Σ" not in plain else "".join(c.lower() for c in plain)
            for word in self.split.findall(plain):
                ids = words.get(word)
                if ids is None:
                    raw = word.encode("utf-8", "surrogatepass")
                    made = self.word("".join([self.letters[b] for b in raw]) + _END)
                    ids = struct.pack(f"<{len(made)}I", *made)
                    if len(word) <= 64:
                        if len(words) > CACHE_CHUNKS:
                            words.clear()
                        words[word] = ids
                parts.append(ids)
        return b"".join(parts)

    def encode(self, text: str | None) -> np.ndarray:
        text = text or ""
        chunks = _CHUNKS.findall(text) if _CONTROL.search(text) else text.split()
        cache = self.cache
        try:
            parts = [cache[c] for c in chunks]
        except KeyError:
            if len(cache) > CACHE_CHUNKS:
                cache.clear()
            parts = []
            for c in chunks:
                ids = cache.get(c)
                if ids is None:
                    ids = self.chunk(c)
                    if len(c) <= 64:
                        cache[c] = ids
                parts.append(ids)
        return np.frombuffer(b"".join(parts), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens, joined by single spaces, in UTF-8."""
        if not len(ids):
            return b""
        start = self.offset[ids]
        size = self.offset[ids.astype(np.int64) + 1] - start
        ends = np.cumsum(size)
        place = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
        return self.blob[place].tobytes()[:-1]


@lru_cache(maxsize=2)
def _load(shared) -> Bpe:
    return Bpe(shared.value)


FIELDS = [
    T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType()),
]


def _mapped(docs: DataFrame, keep: list[str], text: str, tokenizer: str, fields, digest) -> DataFrame:
    """``digest(bpe, text)`` gives the values of ``fields`` for each row."""
    with open(tokenizer, encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def work(*columns):
        bpe = _load(shared)
        for *left, value in zip(*columns):
            yield (*left, *digest(bpe, value))

    inner = [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    picked = docs.select(
        *(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col(text).alias("_text")
    )
    out = map_slices(picked, T.StructType([*inner, *fields]), work, rows=64)
    return out.select(
        *(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), *(f.name for f in fields)
    )


def encode_decode(
    docs: DataFrame, tokenizer: str, keep: list[str], text: str = "text"
) -> DataFrame:
    """Columns ``keep`` plus ``ids`` (little-endian 32-bit) and ``decoded``. No shuffle.

    ``tokenizer`` is the path of the tokenizer file on the driver; its content, a file of fixed
    size, goes to the tasks as a broadcast variable.
    """
    def digest(bpe, value):
        ids = bpe.encode(value)
        return ids.tobytes(), bpe.decode(ids).decode()

    return _mapped(docs, keep, text, tokenizer, FIELDS, digest)


DIGESTS = [
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
    T.StructField("decoded_sha256", T.StringType()),
]


def query(docs: DataFrame, tokenizer: str, keep: list[str] = ["doc_id"]) -> DataFrame:  # noqa: B006
    """Counts and digests of what ``encode_decode`` gives, taken in the same pass."""
    def digest(bpe, value):
        ids = bpe.encode(value)
        return (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(),
            hashlib.sha256(bpe.decode(ids)).hexdigest(),
        )

    return _mapped(docs, keep, "text", tokenizer, DIGESTS, digest)
