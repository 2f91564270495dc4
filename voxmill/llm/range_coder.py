"""Adaptive context-mixing range coder for token ids, run for many blocks in step.

Every block starts from the same state, so blocks decode independently, and numpy works on one id
of every block at a time. For each id, contexts of the last two ids (order 2), of the last id
(order 1) and of no id (order 0: the most frequent one so far) each predict what follows. Their
confidence selects adaptive probabilities, which are mixed in the logistic domain with learnt
weights. The mix says how likely the best candidate is; the rest of the range is shared out among
all ids by a ``Prior``, a distribution of order 0. One division of the range codes either case.

The prior is flat, or counted over many blocks from the ids that the candidates missed, and then
stored once beside the blocks.

All arithmetic is on integers, so that the result does not depend on the machine. A block is
``MAGIC``, the number of ids and their crc32 (little-endian, 32 bits each), and 32-bit words.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np

MAGIC = b"VXT2"
PRIOR_MAGIC = b"VXP2"
BLOCK = 4096
#: Blocks that are wanted side by side, and the length they are not cut below for that.
LANES, SHORTEST = 2048, 1024
MAX_ID = 1 << 16

_T0, _T1, _T2 = 1 << 8, 1 << 9, 1 << 10  # places per block for each order: small, to stay in fast memory
_SURE = 1 << 16  # an entry of order 1 or 2 is an id plus its confidence, 0 to 3, times this
_FULL = 1 << 20  # sum of a prior
_BITS = np.uint64(32)
_WORD = np.uint64((1 << 32) - 1)
_STEPS = 128  # ids of each block whose limits are computed together

_STRETCH = np.array([round(256 * math.log((p + 0.5) / (4095.5 - p))) for p in range(4096)], np.int32)
_SQUASH = np.array(
    [min(4095, max(1, round(4096 / (1 + math.exp(-x / 256))))) for x in range(-2047, 2048)], np.int64
)
#: First chances in 4096ths, by confidence, of order 1, order 2 and order 0.
_CHANCES = np.array([600, 1400, 2200, 3000, 600, 1400, 2200, 3000, 300, 900, 0, 0], np.int32)


class Prior:
    """Shares of ids in ``_FULL``, as widths, starts and the id of each place."""

    def __init__(self, ids: np.ndarray, widths: np.ndarray):
        self.ids, self.widths = ids, widths
        self.width = np.zeros(MAX_ID, np.int64)
        self.width[ids] = widths
        self.start = np.cumsum(self.width) - self.width
        self.id = np.repeat(np.arange(MAX_ID, dtype=np.uint16), self.width)

    @classmethod
    def flat(cls) -> Prior:
        return cls(np.arange(MAX_ID), np.full(MAX_ID, _FULL // MAX_ID))

    @classmethod
    def counted(cls, ids: np.ndarray) -> Prior:
        """By frequency in ``ids``; no other id can be coded. Flat if there are none."""
        counts = np.bincount(ids, minlength=MAX_ID)
        found = np.flatnonzero(counts)
        if not len(found):
            return cls.flat()
        widths = 1 + counts[found] * (_FULL - len(found)) // len(ids)
        widths[widths.argmax()] += _FULL - widths.sum()
        return cls(found, widths)

    def to_bytes(self) -> bytes:
        steps = np.diff(self.ids, prepend=0).astype("<u2").tobytes()
        body = zlib.compress(steps + self.widths.astype("<u4").tobytes())
        return PRIOR_MAGIC + struct.pack("<II", len(self.ids), zlib.crc32(body)) + body

    @classmethod
    def from_bytes(cls, data: bytes) -> Prior:
        if data[:4] != PRIOR_MAGIC:
            raise ValueError("not a prior of token ids")
        count, crc = struct.unpack_from("<II", data, 4)
        if zlib.crc32(data[12:]) != crc:
            raise ValueError("a prior does not fit its checksum")
        body = zlib.decompress(data[12:])
        ids = np.cumsum(np.frombuffer(body, "<u2", count).astype(np.int64))
        return cls(ids, np.frombuffer(body, "<u4", count, 2 * count).astype(np.int64))


class _Model:
    """What ``n`` blocks have learnt so far."""

    def __init__(self, n: int):
        lane = np.arange(n)
        # Places of order 1 and order 2 are in one table, so that both are read at once.
        self.first = np.stack([lane * _T1, n * _T1 + lane * _T2])
        self.mask = np.array([[_T1 - 1], [_T2 - 1]])
        self.table = np.zeros(n * (_T1 + _T2), np.int32)
        self.first0 = lane * _T0
        self.times = np.zeros(n * _T0, np.int16)
        self.chance = np.tile(_CHANCES, n)
        self.sets = lane * 12 + np.array([[0], [4], [8]])
        self.weights = np.full((3, n), 24000, np.int32)
        self.hash = np.zeros((2, n), np.int64)
        self.usual = np.zeros(n, np.int32)
        self.usual_times = np.zeros(n, np.int16)
        self.place = np.empty((3, n), np.int64)

    def predict(self) -> tuple[np.ndarray, np.ndarray]:
        """(candidate, probability in 4096ths that it is right)"""
        self.at = (self.hash & self.mask) + self.first
        self.seen = self.table.take(self.at)
        self.sure = self.seen >> 16
        self.known = self.seen & 0xFFFF
        best = np.where(self.sure[0] > 0, self.known[0], self.usual)
        best = np.where(self.sure[1] > 0, self.known[1], best)
        np.multiply(self.sure, self.known == best, out=self.place[:2])
        self.place[2] = self.usual == best
        self.place += self.sets
        self.now = self.chance.take(self.place)
        self.inputs = _STRETCH.take(self.now)
        mixed = (self.weights * self.inputs).sum(axis=0) >> 16
        self.p = _SQUASH.take(np.minimum(np.maximum(mixed, -2047), 2047) + 2047)
        return best, self.p

    def learn(self, ids: np.ndarray, hit: np.ndarray) -> None:
        goal = hit.astype(np.int32) << 12
        miss = goal - self.p.astype(np.int32)
        self.chance[self.place] = np.maximum(self.now + ((goal - self.now) >> 5), 1)
        self.weights += (self.inputs * miss) >> 10
        np.minimum(np.maximum(self.weights, -200_000, out=self.weights), 200_000, out=self.weights)
        fresh = np.where(self.sure > 1, self.seen - _SURE, ids | _SURE)
        same = np.minimum(self.seen + _SURE, ids | 3 * _SURE)
        self.table[self.at] = np.where(self.known == ids, same, fresh)
        at0 = self.first0 + (ids & (_T0 - 1))
        times = self.times.take(at0) + 1
        self.times[at0] = times
        np.copyto(self.usual, ids, where=times >= self.usual_times)
        np.maximum(self.usual_times, times, out=self.usual_times)
        order1 = ids.astype(np.int64) * 40503 >> 4
        self.hash[1] = order1 * 3 + self.hash[0] * 5  # hash[0] still is that of the id before
        self.hash[0] = order1


class _Range:
    """Low end and width of ``n`` blocks; 32 bits move out once the width is below 32 bits."""

    def __init__(self, n: int):
        self.low = np.zeros(n, np.uint64)
        self.width = np.full(n, (1 << 64) - 1, np.uint64)

    def narrow(self, part: np.ndarray, start: np.ndarray, width: np.ndarray):
        """(blocks that move, their words)"""
        self.low += part * start.view(np.uint64)
        self.width = part * width.view(np.uint64)
        go = np.flatnonzero(self.width <= _WORD)
        low, rest = self.low[go], self.width[go]
        # Where a multiple of 2**32 lies inside, give up the part beyond it.
        rest = np.where((low ^ (low + rest)) > _WORD, -low & _WORD, rest)
        self.low[go] = low << _BITS
        self.width[go] = rest << _BITS
        return go, low >> _BITS


def _predictions(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each id its probability as candidate, and whether it was the candidate."""
    model = _Model(steps.shape[1])
    chances = np.empty(steps.shape, np.int16)
    hits = np.empty(steps.shape, bool)
    for t, ids in enumerate(steps):
        best, chances[t] = model.predict()
        np.equal(best, ids, out=hits[t])
        model.learn(ids, hits[t])
    return chances, hits


def _write(ids: np.ndarray, steps: np.ndarray, chances, hits, prior: Prior) -> list[bytes]:
    length, count = steps.shape
    coder = _Range(count)
    words = np.zeros((count, length + 2), np.uint32)
    flat = words.ravel()
    at = np.arange(count) * (length + 2)
    short = len(ids) - (count - 1) * length
    for first in range(0, length, _STEPS):
        p = chances[first:first + _STEPS].astype(np.int64)
        hit, x = hits[first:first + _STEPS], steps[first:first + _STEPS]
        edge, rest = p << 20, 4096 - p
        starts = np.where(hit, 0, edge + rest * prior.start[x])
        widths = np.where(hit, edge, rest * prior.width[x])
        for t in range(len(p)):
            if first + t == short:  # the last block ends here; what follows in its lane is dropped
                last = int(coder.low[-1]), int(at[-1])
            go, word = coder.narrow(coder.width >> _BITS, starts[t], widths[t])
            flat[at[go]] = word
            at[go] += 1
    if short == length:
        last = int(coder.low[-1]), int(at[-1])
    out = []
    for b in range(count):
        low, end = last if b == count - 1 else (int(coder.low[b]), int(at[b]))
        own = ids[b * length:(b + 1) * length].astype("<u4")
        body = words[b, :end - b * (length + 2)].astype("<u4").tobytes()
        tail = struct.pack("<II", low >> 32, low & 0xFFFFFFFF)
        out.append(MAGIC + struct.pack("<II", len(own), zlib.crc32(own)) + body + tail)
    return out


def block_for(count: int) -> int:
    """The block length for ``count`` ids: shorter than BLOCK where numpy would have few blocks to work on at once.

    A step costs much the same for 500 blocks as for 2,000; blocks of a quarter take about 1 % more bytes.
    """
    return min(BLOCK, max(SHORTEST, -(-count // LANES)))


def _steps(ids: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Blocks side by side: row t holds id t of each. The last block is filled up with its last id."""
    if int(ids.max()) >= MAX_ID:
        raise ValueError(f"ids must be below {MAX_ID}")
    if not 0 < block <= BLOCK:
        raise ValueError(f"a block must hold 1 to {BLOCK} ids")
    length = min(block, len(ids))
    count = -(-len(ids) // length)
    padded = np.full(count * length, ids[-1], np.int32)
    padded[:len(ids)] = ids
    return np.ascontiguousarray(padded.reshape(count, length).T)


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """``ids`` cut into blocks of BLOCK ids, each one encoded by itself with a flat prior."""
    if not len(ids):
        return []
    steps = _steps(ids)
    return _write(ids, steps, *_predictions(steps), Prior.flat())


def encode_counted(ids: np.ndarray, block: int = BLOCK) -> tuple[Prior, list[bytes]]:
    """A prior counted over all blocks, and the blocks, of ``block`` ids, that were encoded with it."""
    if not len(ids):
        return Prior.flat(), []
    steps = _steps(ids, block)
    chances, hits = _predictions(steps)
    prior = Prior.counted(steps[~hits])
    return prior, _write(ids, steps, chances, hits, prior)


def decode_blocks(blocks: list[bytes], prior: Prior | None = None) -> np.ndarray:
    """The ids of all blocks, in order. Raises ValueError if a checksum does not fit."""
    if not blocks:
        return np.zeros(0, np.uint32)
    sizes, sums, bodies = [], [], []
    for block in blocks:
        if block[:4] != MAGIC:
            raise ValueError("not a block of token ids")
        size, crc = struct.unpack_from("<II", block, 4)
        if not 0 < size <= BLOCK:
            raise ValueError("a block of token ids has a wrong size")
        sizes.append(size)
        sums.append(crc)
        bodies.append(np.frombuffer(block, "<u4", offset=12))
    prior = prior or Prior.flat()
    count, wide = len(blocks), max(2, *map(len, bodies)) + 1
    words = np.zeros((count, wide), np.uint64)
    for b, body in enumerate(bodies):
        words[b, :len(body)] = body
    code = words[:, 0] << _BITS | words[:, 1]
    flat = words.ravel()
    ends = np.arange(1, count + 1) * wide - 1
    at = ends - wide + 3
    steps = np.empty((max(sizes), count), np.int32)
    model, coder = _Model(count), _Range(count)
    for t in range(len(steps)):
        x, p = model.predict()
        part = coder.width >> _BITS
        value = np.minimum((code - coder.low) // part, _WORD).view(np.int64)
        width = p << 20
        hit = value < width
        start = np.zeros(count, np.int64)
        missed = np.flatnonzero(~hit)
        edge, rest = width[missed], 4096 - p[missed]
        ids = prior.id.take((value[missed] - edge) // rest)
        x[missed] = ids
        start[missed] = edge + rest * prior.start.take(ids)
        width[missed] = rest * prior.width.take(ids)
        go, _ = coder.narrow(part, start, width)
        # Blocks that have ended or are damaged read on at their last word.
        own = at[go]
        code[go] = code[go] << _BITS | flat.take(np.minimum(own, ends[go]))
        at[go] = own + 1
        steps[t] = x
        model.learn(x, hit)
    made = []
    for b in range(count):
        made.append(steps[:sizes[b], b].astype("<u4"))
        if zlib.crc32(made[b].tobytes()) != sums[b]:
            raise ValueError("a block of token ids does not fit its checksum")
    return np.concatenate(made)
