"""Removal of long repeated strings.

Every byte covered by a string of ``LENGTH`` bytes that starts somewhere else too is removed; so is, where
asked for, every word in a run of a number of words that starts somewhere else too. Texts are UTF-8 bytes,
words are what stands between white space, and matches stay within a document. A ``Law`` says what the
symbols are (bytes, or words as codes) and how long a window is; all laws are searched together.

1. Chunks. Of ``near`` neighbouring grams the one with the smallest hash is an anchor; what lies from one
   anchor to the next is a chunk. Which chunks lie well inside a window depends on the window alone, so a
   window can only repeat if all of them do. Texts are packed into blocks; a block's chunk hashes go to
   the counting tasks as packed numbers, and one bit a chunk comes back: whether it occurs twice.
2. Segments. The windows that pass are given to the smallest chunk hash inside each; neighbouring windows
   with the same one form a segment. Equal windows have equal chunks, so they meet. A task sends the content
   of equal segments once, which takes away what copies of any number would bring.
3. Buckets of segments of about a megabyte. Within a bucket the segments are one text. From its
   Burrows-Wheeler transform, intervals of equal prefixes are extended backward, breadth first: level by
   level this yields the places where neighbouring suffixes share exactly so many symbols. It stops at
   the length of a window: suffixes without a place between them share at least that much and are repeated.
4. A hash with more than ``HOT`` different segments, or ``HOT_BYTES`` of them, is split over buckets. What
   repeats only across them is found by 64-bit digests of the windows, exchanged in packed form.

Texts below a window, nulls and empty texts lose nothing. Repeated rows are copies: a text that
occurs twice and has a window loses all of itself. Other columns, of any name, are carried where they
are asked for. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voxmill.llm.rows import map_batches, map_groups, map_slices, small_side
from voxmill.sources.shipping import ship_package
from voxmill.sources.staging import LARGE_ROWS, settled, stage

LENGTH = 400
#: Words of the runs that ``query`` counts besides.
WORDS = 51
BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 1 << 20
HOT, HOT_BYTES = 3000, 1 << 19
DIGEST_PARTS = 64
#: Chunk hashes that one counting task holds, about.
PART_HASHES = 4_000_000
#: Symbols whose arrays a worker holds at a time.
PIECE = 1 << 17
#: A word is a code of so many bytes, never all ones: that is the separator.
CODE = 5
#: Segments whose content a task has sent lately.
SENT = 50_000
#: Bytes of the table of chunk bits up to which it is broadcast.
MASK_BYTES = 64_000_000

_FACTOR, _OTHER = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_WRAP = 1 << 64
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Law:
    """Windows of ``length`` symbols; an anchor is the smallest of ``near`` grams of ``gram`` symbols."""

    number: int
    length: int
    gram: int
    near: int
    #: Bytes of a symbol in a stored segment.
    width: int

    @property
    def inside(self) -> int:
        """How many runs of ``near`` grams lie within a window."""
        return self.length - self.gram - self.near + 2


def byte_law(length: int) -> Law:
    return Law(0, length, 16, length // 4, 1)


def word_law(words: int) -> Law:
    return Law(1, words, 2, max(1, (words - 1) // 4), CODE)


# Symbols


_WHITE = np.zeros(256, bool)
_WHITE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
#: White space beyond ASCII in UTF-8, as leading bytes and the last ones that may follow.
_WIDE_WHITE = (
    ((0xC2,), (0x85, 0xA0)), ((0xE1, 0x9A), (0x80,)), ((0xE2, 0x80), (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF)),
    ((0xE2, 0x81), (0x9F,)), ((0xE3, 0x80), (0x80,)),
)


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of each word."""
    text = np.frombuffer(data, np.uint8)
    white = np.ones(len(text) + 2, bool)
    inner = white[1:-1]
    inner[:] = _WHITE[text]
    if not data.isascii():
        for lead, last in _WIDE_WHITE:
            at = np.flatnonzero(text[:len(text) - len(lead)] == lead[0])
            for j, byte in enumerate(lead[1:], 1):
                at = at[text[at + j] == byte]
            at = at[np.isin(text[at + len(lead)], last)]
            for j in range(len(lead) + 1):
                inner[at + j] = True
    edge = np.flatnonzero(white[1:] != white[:-1])
    return edge[::2], edge[1::2]


@lru_cache(maxsize=4)
def _powers(factor: int, count: int) -> np.ndarray:
    made, have = np.ones(count, np.uint64), 1
    while have < count:
        more = min(have, count - have)
        made[have:have + more] = made[:more] * np.uint64(pow(factor, have, _WRAP))
        have += more
    return made


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.random.default_rng(7).integers(0, 1 << 63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _values(symbols: np.ndarray) -> np.ndarray:
    """A number for each symbol: random ones for bytes; codes of words are random already."""
    return _byte_values()[symbols] if symbols.dtype == np.uint8 else symbols


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, factor: int = _FACTOR) -> np.ndarray:
    """A 64-bit hash of each span of symbols, from running sums of symbols times powers.

    ``starts`` and ``ends`` rise. Longer spans than ``PIECE`` are hashed one by one.
    """
    made = np.empty(len(starts), np.uint64)
    forth, back = _powers(factor, PIECE + 1), _powers(pow(factor, -1, _WRAP), PIECE + 1)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + PIECE, side="right"))
        if j <= i:
            made[i] = xxhash.xxh3_64_intdigest(symbols[base:int(ends[i])].tobytes(), factor & 0xFFFF)
            i += 1
            continue
        part = _values(symbols[base:int(ends[j - 1])])
        total = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * forth[:len(part)], out=total[1:])
        first = starts[i:j] - base
        made[i:j] = (total[ends[i:j] - base] - total[first]) * back[first]
        i = j
    return mixed(made ^ (ends - starts).astype(np.uint64) * np.uint64(_OTHER))


def symbols_of(law: Law, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of all texts one after the other, where each text begins, and the end)"""
    ends = np.cumsum([len(t) for t in texts])
    if law.width == 1:
        return np.frombuffer(b"".join(texts), np.uint8), np.concatenate(([0], ends))
    data = b" ".join(texts)
    starts, stops = word_spans(data)
    codes = span_hashes(np.frombuffer(data, np.uint8), starts, stops) % np.uint64((1 << 8 * CODE) - 1)
    return codes, np.concatenate(([0], np.searchsorted(starts, ends + np.arange(len(texts)))))


def packed(law: Law, symbols: np.ndarray) -> bytes:
    """Symbols as they stand in a segment."""
    if law.width == 1:
        return symbols.tobytes()
    return symbols.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :CODE].tobytes()


def unpacked(width: int, content: bytes) -> np.ndarray:
    data = np.frombuffer(content, np.uint8)
    if width == 1:
        return data
    wide = np.zeros((len(data) // width, 8), np.uint8)
    wide[:, :width] = data.reshape(-1, width)
    return wide.view("<u8").ravel()


# Chunks


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    length = 1
    while 2 * length <= width:
        values = np.minimum(values[:-length], values[length:])
        length *= 2
    rest = width - length
    return np.minimum(values[:len(values) - rest], values[rest:]) if rest else values


def _gram_keys(law: Law, symbols: np.ndarray) -> np.ndarray:
    """Hash in the high half, place in the low half: minima tell where they are, the first among equals."""
    if law.width == 1:  # 16 bytes as two numbers
        size = max(0, len(symbols) - 7)
        eight = np.empty(size, np.uint64)
        for k in range(min(8, size)):
            eight[k::8] = np.frombuffer(symbols, "<u8", (len(symbols) - k) // 8, k)
        one, two = eight[:-8], eight[8:]
    else:
        one, two = symbols[:-1], symbols[1:]
    keys = one * np.uint64(_FACTOR)
    keys += two * np.uint64(_OTHER)
    keys &= _HIGH
    keys |= np.arange(len(keys), dtype=np.uint64)
    return keys


@dataclass
class Chunks:
    """The chunks of several texts, one after the other."""

    #: Symbols of each text.
    counts: np.ndarray
    #: For each anchor the first run of grams, within its text, that it is the smallest of.
    first: np.ndarray
    #: Where the anchors of each text begin, and the end; the same for chunks.
    anchor_at: np.ndarray
    chunk_at: np.ndarray
    hashes: np.ndarray

    def of(self, text: int) -> tuple[int, np.ndarray, slice]:
        """(symbols, first runs, which chunks) of one text"""
        a, b = self.anchor_at[text:text + 2]
        return int(self.counts[text]), self.first[a:b], slice(*self.chunk_at[text:text + 2].tolist())


def chunks(law: Law, symbols: np.ndarray, begin: np.ndarray) -> Chunks:
    """Chunks of the texts that begin at ``begin`` (and the end); short texts have none."""
    counts = np.diff(begin)
    texts = np.flatnonzero(counts >= law.length)
    low_run = begin[texts]
    high_run = low_run + counts[texts] - law.gram - law.near + 2
    firsts, places, last, runs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], -1, int(high_run.max(initial=0))
    for low in range(0, runs, PIECE):
        high = min(runs, low + PIECE)
        part = np.ascontiguousarray(symbols[low:high + law.near + law.gram - 2])
        place = (sliding_min(_gram_keys(law, part), law.near) & _LOW).astype(np.int64) + low
        turn = np.diff(place, prepend=last) != 0
        last = int(place[-1])
        inside = np.zeros(high - low + 1, np.int8)  # runs that lie within a text
        np.add.at(inside, np.clip(low_run, low, high) - low, 1)
        np.add.at(inside, np.clip(high_run, low, high) - low, -1)
        here = low_run[(low_run >= low) & (low_run < high)] - low
        turn[here] = True
        turn &= np.cumsum(inside[:-1], dtype=np.int8) > 0
        turn = np.flatnonzero(turn)
        firsts.append(turn + low)
        places.append(place[turn])
    first, anchor = np.concatenate(firsts), np.concatenate(places)
    owner = np.searchsorted(low_run, first, side="right") - 1
    same = np.flatnonzero(owner[1:] == owner[:-1])
    hashes = span_hashes(symbols, anchor[same], anchor[same + 1] + law.gram)
    number = np.zeros(len(counts), np.int64)
    number[texts] = np.bincount(owner, minlength=len(texts))
    at = np.concatenate(([0], np.cumsum(number)))
    chunk_at = np.concatenate(([0], np.cumsum(np.maximum(number - 1, 0))))
    return Chunks(counts, first - low_run[owner], at, chunk_at, hashes)


def segments(law: Law, count: int, first: np.ndarray, hashes: np.ndarray, known: np.ndarray) -> list[tuple[int, int, int]]:
    """(hash, first window, last window) of the windows, of a text of ``count`` symbols, that may repeat.

    ``first``, ``hashes``: what ``chunks`` gives; ``known``: whether a chunk occurs elsewhere, too.
    """
    if not known.any():
        return []
    windows, last_chunk = count - law.length + 1, len(hashes)
    # For each anchor the next chunk that is not known.
    stop = np.minimum.accumulate(np.append(np.where(known, last_chunk, np.arange(last_chunk)), last_chunk)[::-1])[::-1]
    # What lies inside a window changes where its first or its last anchor does.
    turns = np.concatenate((first, first - law.inside + 1))
    turns = np.unique(turns[(turns >= 0) & (turns < windows)])
    head = np.searchsorted(first, turns, side="right") - 1
    tail = np.searchsorted(first, turns + law.inside - 1, side="right") - 1
    good = np.flatnonzero((stop[head] >= tail) & (tail > head))
    if not len(good):
        return []
    # The smallest chunk hash of each, from minima over powers of two.
    ordered = (hashes & _HIGH) | np.arange(len(hashes), dtype=np.uint64)
    a, b = head[good], tail[good]
    level = np.frexp((b - a).astype(float))[1] - 1
    chief, minima = np.empty(len(good), np.uint64), ordered
    for k in range(int(level.max()) + 1):
        own = np.flatnonzero(level == k)
        chief[own] = np.minimum(minima[a[own]], minima[b[own] - (1 << k)])
        minima = np.minimum(minima[:-(1 << k)], minima[1 << k:])
    chief = (chief & _LOW).astype(np.int64)
    begin, end = turns[good], np.append(turns[1:], windows)[good]
    fresh = np.concatenate(([True], (begin[1:] != end[:-1]) | (chief[1:] != chief[:-1])))
    at = np.flatnonzero(fresh)
    finish = end[np.append(at[1:], len(end)) - 1]
    signed = hashes.view(np.int64)
    return list(zip(signed[chief[at]].tolist(), begin[at].tolist(), (finish - 1).tolist()))


# Equal windows by backward extension on the Burrows-Wheeler transform


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, int, np.ndarray]:
    """(suffixes sorted by their first ``depth`` symbols at least, a level, the groups at that level)

    Ranks are doubled. Pairs of ranks and the place go into one number where they fit, which sorts fastest.
    The groups are flags: whether a suffix differs from the one before in its first ``level`` symbols.
    """
    n = len(text)
    bits = n.bit_length()
    letter = max(1, int(text.max()).bit_length())
    have = min(depth, (64 - bits) // letter)
    shallow = max(have, depth // 16)
    key = np.zeros(n, np.uint64)
    for j in range(have):
        key <<= np.uint64(letter)
        key[:n - j] |= text[j:]
    key <<= np.uint64(bits)
    key |= np.arange(n, dtype=np.uint64)
    key.sort()
    mask, shift = np.uint64((1 << bits) - 1), np.uint64(bits)
    order = (key & mask).astype(np.int32)
    key >>= shift
    head = np.concatenate(([True], key[1:] != key[:-1]))
    group = np.maximum.accumulate(np.where(head, np.arange(n, dtype=np.int32), 0)).astype(np.int32)
    rank = np.empty(n, np.int32)
    rank[order] = group  # the place of the first member of its group
    level, groups = have, head.copy()
    tied = ~(head & np.append(head[1:], True))
    places = np.flatnonzero(tied).astype(np.int32)
    mine, group = order[places], group[places]
    while have < depth and len(places):
        after = mine + have
        second = rank.take(np.minimum(after, n - 1)) + 1
        second[after >= n] = 0
        if 3 * bits <= 64:
            key = group.astype(np.uint64)
            key <<= shift
            key |= second.astype(np.uint64)
            key <<= shift
            key |= mine.astype(np.uint64)
            key.sort()
            mine = (key & mask).astype(np.int32)
            key >>= shift
        else:
            key = group.astype(np.int64) * (n + 1) + second
            by = np.argsort(key)
            mine, key = mine[by], key[by]
        fresh = np.concatenate(([True], key[1:] != key[:-1]))
        order[places] = mine
        group = np.maximum.accumulate(np.where(fresh, places, 0))
        rank[mine] = group
        head[places[fresh]] = True
        have *= 2
        if have <= shallow:
            level, groups = have, head.copy()
        rest = ~(fresh & np.append(fresh[1:], True))
        places, mine, group = places[rest], mine[rest], group[rest]
    return order, level, groups


def _neighbours(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place the place before and after with the same value; -1 and the length where there is none."""
    n = len(values)
    by = np.argsort(values, kind="stable")
    same = values[by[1:]] == values[by[:-1]]
    before, after = np.full(n, -1), np.full(n, n)
    before[by[1:][same]] = by[:-1][same]
    after[by[:-1][same]] = by[1:][same]
    return before, after


def prefix_places(text: np.ndarray, order: np.ndarray, depth: int, level: int, groups: np.ndarray) -> np.ndarray:
    """Flags: whether suffixes ``q - 1`` and ``q`` of ``order`` share fewer than ``depth`` symbols.

    Interval extension: all suffixes that begin with a string stand in one interval; the letters before
    them give the intervals of the strings one letter longer. The place after an interval that appears at
    level ``l`` and has no value yet is where exactly ``l`` symbols are shared, and only such intervals are
    extended further. The first ``level`` levels are read off the ``groups`` of the sort. Within an interval
    the transform is gone through by runs of one letter.
    """
    n = len(text)
    letters = text[order - 1]  # the transform; the text is read as a ring
    to = np.empty(n, np.int64)
    to[np.argsort(letters, kind="stable")] = np.arange(n)
    turn = letters[1:] != letters[:-1]
    run_of = np.concatenate(([0], np.cumsum(turn)))
    run_low = np.concatenate(([0], np.flatnonzero(turn) + 1))
    run_high = np.append(run_low[1:], n) - 1
    before, after = _neighbours(letters[run_low])
    found = np.append(groups, True)
    low = np.flatnonzero(groups)
    high = np.append(low[1:], n) - 1
    for _ in range(level, depth):
        single = low == high
        end = to[low[single]]
        end = end[~found[end + 1]]
        lows, highs = [end], [end]
        wide_low, wide_high = low[~single], high[~single]
        if len(wide_low):
            one, last = run_of[wide_low], run_of[wide_high]
            size = last - one + 1
            stop = np.cumsum(size)
            which = np.repeat(np.arange(len(size)), size)
            run = np.arange(stop[-1]) + (one - stop + size)[which]
            is_first, is_last = before[run] < one[which], after[run] > last[which]
            a, b = which[is_first], which[is_last]
            first = np.sort(a * n + to[np.maximum(run_low[run[is_first]], wide_low[a])])
            final = np.sort(b * n + to[np.minimum(run_high[run[is_last]], wide_high[b])])
            i, j = first % n, final % n
            fresh = ~found[j + 1]
            lows.append(i[fresh])
            highs.append(j[fresh])
        low, high = np.concatenate(lows), np.concatenate(highs)
        if not len(low):
            break
        found[high + 1] = True
    return found


def repeated_windows(parts: list[bytes], counts: list[int], length: int | None = None, width: int = 1) -> list[np.ndarray]:
    """For each part the windows that occur elsewhere in ``parts``, or that belong to a part that stands for
    several equal ones. A part is symbols of ``width`` bytes."""
    length = length or LENGTH
    between = b"\xff" * width  # never part of UTF-8 or of codes
    text = unpacked(width, between.join(parts) + between)
    if width > 1:
        text = np.unique(text, return_inverse=True)[1].astype(np.uint32)
    size = np.array([len(p) // width for p in parts])
    begin = np.concatenate(([0], np.cumsum(size + 1)[:-1]))
    order, level, groups = suffix_order(text, length)
    apart = prefix_places(text, order, length, level, groups)
    paired = ~(apart[:-1] & apart[1:])  # shares ``length`` symbols with the suffix before or after
    again = np.zeros(len(text), bool)
    again[order] = paired
    return [
        np.arange(s - length + 1) if c > 1 else np.flatnonzero(again[b:b + max(0, s - length + 1)])
        for b, s, c in zip(begin, size, counts)
    ]


# Jobs


def _runs(places: np.ndarray) -> list[int]:
    """[first, last, first, last, ...] of runs of consecutive places."""
    if not len(places):
        return []
    edge = np.flatnonzero(np.diff(places) != 1)
    first = places[np.concatenate(([0], edge + 1))]
    last = places[np.concatenate((edge, [len(places) - 1]))]
    return np.stack([first, last], axis=1).ravel().tolist()


def _fields(names: str) -> T.StructType:
    kinds = {
        "law": T.IntegerType(), "part": T.IntegerType(), "salt": T.IntegerType(), "size": T.IntegerType(), "block": T.LongType(),
        "hash": T.LongType(), "digest": T.LongType(), "tkey": T.LongType(), "starts": T.ArrayType(T.IntegerType()),
        "runs": T.ArrayType(T.IntegerType()), "tkeys": T.ArrayType(T.LongType()), "sizes": T.ArrayType(T.LongType()),
    }
    return T.StructType([T.StructField(n, kinds.get(n, T.BinaryType())) for n in names.split()])


_BLOCK = _fields("block tkeys sizes data")
_HASHES = _fields("law part block pack")
_MASKS = _HASHES
_SEGMENTS = _fields("law hash digest tkey starts size bytes")
_RUNS = _fields("law hash digest runs")
_PACKED = _fields("law hash part salt windows")
_PLACED = _fields("tkey law runs")


def _blocks(texts: DataFrame) -> DataFrame:
    """``texts`` (tkey, bytes) packed into a row for about ``BLOCK_BYTES``, under numbers of their own."""
    ship_package(texts.sparkSession)
    target = to_arrow_schema(_BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, names, held = TaskContext.get().partitionId() << 32, [], []

        def block():
            columns = [[number], [names], [[len(c) for c in held]], [b"".join(held)]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, target)], schema=target)

        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for key, content in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns)):
                    names.append(key)
                    held.append(content)
                    size += len(content)
                    if size >= BLOCK_BYTES:
                        yield block()
                        number, names, held, size = number + 1, [], [], 0
        if held:
            yield block()

    return map_batches(texts.select("tkey", "bytes"), run, _BLOCK)


def _texts_of(sizes: list[int], data: bytes) -> list[bytes]:
    at = np.concatenate(([0], np.cumsum(sizes))).tolist()
    return [data[a:b] for a, b in zip(at, at[1:])]


def _dealt(hashes: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunks by part, the parts there are, where each begins)"""
    part = (hashes % np.uint64(parts)).astype(np.int64)
    by = np.argsort(part, kind="stable")
    there, begin = np.unique(part[by], return_index=True)
    return by, there, begin


def _hashes(laws, parts, blocks, sizes, datas) -> Iterator[tuple]:
    for block, size, data in zip(blocks, sizes, datas):
        texts = _texts_of(size, data)
        for law in laws:
            hashes = chunks(law, *symbols_of(law, texts)).hashes
            by, there, begin = _dealt(hashes, parts[law.number])
            high = (hashes[by] >> np.uint64(32)).astype("<u4")
            for p, own in zip(there.tolist(), np.split(high, begin[1:])):
                yield law.number, p, block, own.tobytes()


def _count(key, blocks, packs) -> Iterator[tuple]:
    """One bit for each hash that was sent: whether it occurs twice."""
    law, part = key
    each = [np.frombuffer(p, "<u4") for p in packs]
    ordered = np.sort(np.concatenate(each))
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return
    for block, own in zip(blocks, each):
        mask = twice[np.minimum(np.searchsorted(twice, own), len(twice) - 1)] == own
        if mask.any():
            yield law, part, block, np.packbits(mask).tobytes()


def _segments(laws, parts, sent, blocks, keys, sizes, datas, masks) -> Iterator[tuple]:
    """``sent``: a set of the task's own."""
    for block_keys, size, data, mask in zip(keys, sizes, datas, masks):
        texts = _texts_of(size, data)
        for law in laws:
            symbols, begin = symbols_of(law, texts)
            found = chunks(law, symbols, begin)
            known = np.zeros(len(found.hashes), bool)
            by, there, start = _dealt(found.hashes, parts[law.number])
            own = {m["part"]: m["pack"] for m in mask if m["law"] == law.number}
            for p, places in zip(there.tolist(), np.split(by, start[1:])):
                if p in own:
                    known[places] = np.unpackbits(np.frombuffer(own[p], np.uint8), count=len(places)).view(bool)
            total = np.concatenate(([0], np.cumsum(known)))[found.chunk_at]
            for i in np.flatnonzero(total[1:] > total[:-1]).tolist():
                count, first, mine = found.of(i)
                runs = segments(law, count, first, found.hashes[mine], known[mine])
                if runs:
                    yield from _segments_of(law, block_keys[i], symbols[begin[i]:begin[i + 1]], runs, sent)


def _segments_of(law, key, symbols, runs, sent) -> Iterator[tuple]:
    found: dict[tuple[int, int], tuple[list[int], bytes]] = {}
    whole = packed(law, symbols)
    for hash_, begin, last in runs:
        content = whole[begin * law.width:(last + law.length) * law.width]
        digest = xxhash.xxh3_64_intdigest(content) - (1 << 63)
        found.setdefault((hash_, digest), ([], content))[0].append(begin)
    for (hash_, digest), (starts, content) in found.items():
        if len(sent) > SENT:
            sent.clear()
        # Equal segments are equal in content: a task need not send it again and again.
        again = (law.number, hash_, digest) in sent
        sent.add((law.number, hash_, digest))
        yield law.number, hash_, digest, key, starts, len(content), None if again else content


def _bucket(laws, key, hashes, digests, counts, contents) -> Iterator[tuple]:
    """Runs of windows of each segment that occur elsewhere in this bucket; equal segments are one."""
    law = laws[key[0]]
    each: dict[tuple[int, int], list] = {}
    for hash_, digest, count, content in zip(hashes, digests, counts, contents):
        own = each.setdefault((hash_, digest), [0, None])
        own[0] += count
        own[1] = content if own[1] is None else own[1]
    rest = sorted(each)
    at = 0
    while at < len(rest):  # about a megabyte at a time; groups of one hash stay together
        size, end = 0, at
        while end < len(rest) and (size < BUCKET_BYTES or rest[end][0] == rest[end - 1][0]):
            last = end + 1
            while last < len(rest) and rest[last][0] == rest[end][0]:
                last += 1
            if last == end + 1 and (end == at or rest[end - 1][0] != rest[end][0]):
                # Nothing else has its hash: all or nothing.
                count, content = each[rest[end]]
                if count > 1:
                    yield law.number, *rest[end], [0, len(content) // law.width - law.length]
                each[rest[end]][1] = b""
            size += len(each[rest[end]][1])
            end += 1
        now, at = [x for x in rest[at:end] if each[x][1]], end
        if now:
            windows = repeated_windows([each[x][1] for x in now], [each[x][0] for x in now], law.length, law.width)
            for x, places in zip(now, windows):
                if len(places):
                    yield law.number, *x, _runs(places)


def window_digests(law: Law, contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(a 64-bit hash of each window of all segments, how many windows each has)"""
    symbols = unpacked(law.width, b"".join(contents))
    count = np.array([len(c) // law.width for c in contents])
    begin = np.concatenate(([0], np.cumsum(count)[:-1]))
    windows = count - law.length + 1
    skipped = begin - np.concatenate(([0], np.cumsum(windows)[:-1]))
    starts = np.arange(windows.sum()) + np.repeat(skipped, windows)
    one = span_hashes(symbols, starts, starts + law.length)
    return mixed(one ^ (span_hashes(symbols, starts, starts + law.length, _OTHER) << np.uint64(1))), windows


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _pack(laws, key, contents) -> Iterator[tuple]:
    number, hash_, salt = key
    windows = np.unique(window_digests(laws[number], list(set(contents)))[0])
    part = (windows % np.uint64(DIGEST_PARTS)).astype(np.int64)
    for p in np.unique(part):
        yield number, hash_, int(p), salt, windows[part == p].tobytes()


def _across(key, salts, packs) -> Iterator[tuple]:
    """The digests that several salts hold, for each of these salts."""
    number, hash_, part = key
    each = [np.frombuffer(p, "<u8") for p in packs]
    ordered = np.sort(np.concatenate(each))
    shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    for salt, own in zip(salts, each):
        mine = own[_among(own, shared)]
        if len(mine):
            yield number, hash_, part, salt, mine.tobytes()


def _apply(laws, key, digests, contents, packs) -> Iterator[tuple]:
    """Rows with ``packs`` hold repeated digests, the others hold segments."""
    number, hash_, _ = key
    law = laws[number]
    shared = np.sort(np.concatenate([np.frombuffer(p, "<u8") for p in packs if p is not None] or [np.zeros(0, "<u8")]))
    each = {d: c for d, c in zip(digests, contents) if c is not None}
    if not len(shared) or not each:
        return
    found, windows = window_digests(law, list(each.values()))
    for digest, mask in zip(each, np.split(_among(found, shared), np.cumsum(windows)[:-1])):
        places = np.flatnonzero(mask)
        if len(places):
            yield number, hash_, digest, _runs(places)


def _joined(keys, laws, runs) -> Iterator[tuple]:
    """Runs of windows of one text, put together where they meet."""
    for key, law, own in zip(keys, laws, runs):
        spans = merged([(a, b + 1) for a, b in zip(own[::2], own[1::2])])
        yield key, law, [x for a, b in spans for x in (a, b - 1)]


def repeated(texts: DataFrame, *laws: Law) -> DataFrame:
    """tkey, law (its number), runs: [first, last, ...] of windows that occur elsewhere.

    ``texts``: tkey, bytes, one row for each different text. A window that repeats only in copies of its
    text is not found here; ``remove`` takes all of such a text.
    """
    return settled(texts.sparkSession, lambda: _repeated(texts, list(laws)), "repeats")


def _candidates(texts: DataFrame, laws: list[Law]) -> DataFrame:
    """law, hash, digest, tkey, starts, size, bytes of the segments; one row of equal ones in a task has the bytes."""
    blocks = stage(_blocks(texts), "repeat-blocks", **LARGE_ROWS)
    size = blocks.agg(F.sum(F.octet_length("data"))).first()[0] or 0
    # About two anchors in ``near`` + 1 symbols; a word has about six bytes.
    parts = {
        law.number: 1 + 2 * size // ((law.near + 1) * (1 if law.width == 1 else 6) * PART_HASHES) for law in laws
    }
    sent = map_slices(blocks.select("block", "sizes", "data"), _HASHES, partial(_hashes, laws, parts), rows=1)
    masks = map_groups(sent, ["law", "part"], _MASKS, _count)
    masks = stage(masks.groupBy("block").agg(
        F.collect_list(F.struct("law", "part", "pack")).alias("masks"), F.sum(F.octet_length("pack") + 16).alias("weight")
    ), "repeat-masks")
    weight, rows = masks.agg(F.sum("weight"), F.count("*")).first()
    side = small_side(masks.select("block", "masks"), 16 + (weight or 0) // max(1, rows), MASK_BYTES)
    return map_slices(
        blocks.join(side, "block").select("block", "tkeys", "sizes", "data", "masks"), _SEGMENTS,
        partial(_segments, laws, parts, set()), rows=1,
    )


def _repeated(texts: DataFrame, laws: list[Law]) -> DataFrame:
    spark = texts.sparkSession
    by_number = {law.number: law for law in laws}
    cut = settled(spark, lambda: _candidates(texts, laws), "segments")
    # Narrow rows: how many different segments a hash has, and how many bytes.
    variants = cut.groupBy("law", "hash", "digest").agg(F.max("size").alias("size")).groupBy("law", "hash").agg(
        F.count("*").alias("variants"), F.sum("size").alias("size")
    )
    salts = F.greatest(F.ceil(F.col("variants") / HOT), F.ceil(F.col("size") / HOT_BYTES)).cast("int")
    variants = stage(variants.select("law", "hash", "size", salts.alias("salts")), "segments-variants")
    buckets = int(max(1, (variants.agg(F.sum("size")).first()[0] or 0) // BUCKET_BYTES))
    hot = stage(variants.where("salts > 1").select("law", "hash", "salts"), "segments-hot")
    salted = cut.join(small_side(hot, 24), ["law", "hash"], "left").withColumn(
        "salt", F.when(F.col("salts") > 1, F.pmod(F.xxhash64("digest"), F.col("salts"))).otherwise(0).cast("int")
    )
    dealt = salted.withColumn("bucket", F.pmod(F.xxhash64("law", "hash", "salt"), F.lit(buckets)))
    runs = map_groups(
        dealt.select("law", "bucket", "hash", "digest", F.size("starts").alias("count"), "bytes"),
        ["law", "bucket"], _RUNS, partial(_bucket, by_number), buckets,
    )
    if hot.limit(1).count():
        spread = salted.where("salts > 1 AND bytes IS NOT NULL").select("law", "hash", "salt", "digest", "bytes")
        packs = map_groups(spread.select("law", "hash", "salt", "bytes"), ["law", "hash", "salt"], _PACKED, partial(_pack, by_number))
        shared = map_groups(packs.select("law", "hash", "part", "salt", "windows"), ["law", "hash", "part"], _PACKED, _across)
        none = F.lit(None)
        both = spread.select("law", "hash", "salt", "digest", "bytes", none.cast("binary").alias("pack")).union(
            shared.select("law", "hash", "salt", none.cast("long"), none.cast("binary"), "windows")
        )
        runs = runs.union(map_groups(both, ["law", "hash", "salt"], _RUNS, partial(_apply, by_number)))
    runs = stage(runs, "runs")
    placed = (
        cut.select("law", "hash", "digest", "tkey", "starts").join(runs, ["law", "hash", "digest"])
        .select("tkey", "law", F.explode("starts").alias("start"), "runs")
        .select("tkey", "law", F.transform("runs", lambda x: x + F.col("start")).alias("runs"))
        .groupBy("tkey", "law").agg(F.flatten(F.collect_list("runs")).alias("runs"))  # of one text
    )
    return map_slices(placed, _PLACED, _joined)


def distinct_texts(texts: DataFrame, copies: DataFrame) -> DataFrame:
    """tkey, bytes: each text once. Only texts in ``copies`` are sorted; they meet within tasks first."""
    several = small_side(copies, 16).select("tkey")
    one = texts.join(several, "tkey", "left_semi").groupBy("tkey").agg(F.max("bytes").alias("bytes"))
    return texts.join(several, "tkey", "left_anti").select("tkey", "bytes").union(one)


def merged(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
    spans: list[list[int]] = []
    for first, end in sorted(found):
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([first, end])
    return [(a, b) for a, b in spans]


def covered(runs: list[int], length: int) -> list[tuple[int, int]]:
    """Spans of symbols covered by runs of windows."""
    return merged([(first, last + length) for first, last in zip(runs[::2], runs[1::2])])


_REMOVED = [
    T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
    T.StructField("n_repeated_words", T.LongType()), T.StructField("kept", T.StringType()),
]


def remove(
    docs: DataFrame, keep: list[str], text: str = "text", with_text: bool = True, words: int = WORDS,
    cut_words: bool = False,
) -> DataFrame:
    """Columns ``keep`` plus ``n_bytes, n_removed, n_spans, kept_sha256, n_repeated_words, kept``.

    ``kept``: the remaining text; bytes of a character that was cut are left out of it. It is null
    where nothing was removed, or if ``with_text`` is false. ``n_repeated_words``: words in runs of ``words``
    that start somewhere else too; with ``cut_words`` these are removed besides.
    """
    byte, word = byte_law(LENGTH), word_law(words)
    value = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    long = docs.select(value.alias("bytes")).where(F.octet_length("bytes") >= min(LENGTH, 2 * words - 1))
    long = long.select(F.xxhash64("bytes").alias("tkey"), "bytes")
    copies = stage(long.groupBy("tkey").agg(F.count("*").alias("n")).where("n > 1"), "copies")
    found = repeated(distinct_texts(long, copies), byte, word)
    of = lambda law: F.max(F.when(F.col("law") == law.number, F.col("runs")))
    found = found.groupBy("tkey").agg(of(byte).alias("runs"), of(word).alias("word_runs"))
    own = lambda c: F.when(F.col("n").isNull(), F.col(c)).alias(c)
    both = found.join(copies, "tkey", "full").select(
        "tkey", own("runs"), own("word_runs"), F.col("n").isNotNull().alias("whole")
    )
    both = stage(both, "removals")
    places = F.greatest(F.size("runs"), F.lit(0)) + F.greatest(F.size("word_runs"), F.lit(0))
    weight = both.agg(F.sum(places)).first()[0] or 0
    side = small_side(both, 28 + 4 * weight // max(1, both.count()))
    rows = docs.select(
        *(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), value.alias("bytes"),
    ).withColumn("tkey", F.xxhash64("bytes"))
    joined = rows.join(side, "tkey", "left")
    inner = [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]

    def work(*columns):
        for *left, data, whole, runs, word_runs in zip(*columns):
            spans, word_cover = covered(runs or [], LENGTH), covered(word_runs or [], words)
            if whole:
                count = len(word_spans(data)[0])
                word_cover = [(0, count)] if count >= words else []
                spans = [(0, len(data))] if len(data) >= LENGTH or cut_words and word_cover else []
            elif cut_words and word_cover:
                first, end = word_spans(data)
                spans = merged(spans + [(int(first[a]), int(end[b - 1])) for a, b in word_cover])
            rest, at = [], 0
            for a, b in spans:
                rest.append(data[at:a])
                at = b
            rest.append(data[at:])
            kept = b"".join(rest)
            yield (
                *left, len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(),
                sum(b - a for a, b in word_cover), kept.decode("utf-8", "ignore") if with_text and spans else None,
            )

    names = [f.name for f in _REMOVED]
    out = map_slices(
        joined.select(*(f.name for f in inner), "bytes", "whole", "runs", "word_runs"),
        T.StructType([*inner, *_REMOVED]), work,
    )
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), *names)


def query(docs: DataFrame) -> DataFrame:
    return remove(docs, ["doc_id"], with_text=False).drop("kept")


def cut(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with repeated strings and runs of words taken out of ``text`` and ``n_chars`` counted anew."""
    made = remove(docs, docs.columns, words=words, cut_words=True)
    text = F.coalesce("kept", "text")
    changed = F.col("kept").isNotNull()
    columns = []
    for f in docs.schema.fields:
        column = F.col(f.name)
        if f.name == "text":
            column = text
        elif f.name == "n_chars":
            column = F.when(changed, F.char_length(text).cast(f.dataType)).otherwise(column)
        columns.append(column.alias(f.name))
    return made.select(columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h,
         octet_length(encode(coalesce(text, ''))) AS n FROM documents),
w AS (
  SELECT doc_id, i, md5(substr(h, 2 * i + 1, 800)) AS s
  FROM d, unnest(range(0, n - 399)) AS r(i) WHERE n >= 400),
again AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1),
hit AS (SELECT DISTINCT doc_id, i FROM w JOIN again USING (s)),
edge AS (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 400
                         THEN 0 ELSE 1 END AS fresh FROM hit),
numbered AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM edge),
span AS (SELECT doc_id, k, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY doc_id, k),
gap AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM span),
kept AS (
  SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS tail,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS parts
  FROM gap JOIN d USING (doc_id) GROUP BY doc_id),
t AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''),
    '[^\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+') AS v
  FROM documents),
run AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(v, i + 1, i + 51), ' ')) AS s
  FROM t, unnest(range(0, len(v) - 50)) AS r(i) WHERE len(v) >= 51),
runs AS (SELECT s FROM run GROUP BY s HAVING count(*) > 1),
met AS (SELECT DISTINCT doc_id, i FROM run JOIN runs USING (s)),
step AS (SELECT doc_id, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 51) AS wide FROM met),
words AS (SELECT doc_id, sum(least(wide, 51)) AS n_repeated_words FROM step GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(removed, 0) AS n_removed, coalesce(spans, 0) AS n_spans,
       sha256(unhex(coalesce(parts, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256,
       coalesce(n_repeated_words, 0) AS n_repeated_words
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN words USING (doc_id)
"""
