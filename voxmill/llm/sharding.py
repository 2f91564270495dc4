"""Balanced shards by minimax contiguous partition.

Rows with equal texts form one atomic group. Groups stand in the order of their text's hash, and
the smallest shard capacity for which a greedy walk needs no more than the given number of shards
is found by binary search; the walk with that capacity gives the cuts. A group larger than a fair
share would leave shards empty in any contiguous cut, so such groups stand first in the order, one
per shard, and the rest is cut for the shards that are left.

The driver never sees all groups. It holds totals of hash ranges and asks for finer totals only
where a cut can fall, so that what it holds is bounded by ``2 ** FIRST_BITS`` ranges and a few
hundred refined ones, whatever the data size.

A null text counts as empty. An empty table gives an empty result; repeated rows are all kept.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxmill.sources.staging import stage

FIRST_BITS = 14
NEXT_BITS = 8
#: Slots are numbered within this many cells of each shard.
CELLS = 1024


@dataclass
class Range:
    """Groups whose hash, shifted right by ``64 - bits``, is ``key``."""

    bits: int
    key: int
    total: int
    groups: int
    first: int  # smallest hash

    @property
    def atomic(self) -> bool:
        return self.groups == 1 or self.bits == 64


def greedy(before: list[int], shards: int, capacity: int) -> list[int] | None:
    """Cuts (indexes of the first unit of shards 1, 2, ...), or None if ``shards`` are not enough.

    ``before``: running totals of the units, starting with 0.
    """
    cuts, at, last = [], 0, len(before) - 1
    while True:
        end = bisect_right(before, before[at] + capacity) - 1
        if end == last:
            return cuts
        if end == at or len(cuts) == shards - 1:
            return None
        cuts.append(end)
        at = end


def smallest_capacity(sizes: list[int], shards: int) -> int:
    before = [0, *accumulate(sizes)]
    low, high = max(max(sizes, default=0), -(-before[-1] // shards)), before[-1]
    while low < high:
        middle = (low + high) // 2
        if greedy(before, shards, middle) is None:
            low = middle + 1
        else:
            high = middle
    return low


def _totals(groups: DataFrame, bits: int) -> DataFrame:
    key = F.shiftright("hash", 64 - bits) if bits < 64 else F.col("hash")
    return groups.groupBy(key.alias("key")).agg(
        F.sum("bytes").alias("total"), F.count("*").alias("groups"), F.min("hash").alias("first"),
    )


def _ranges(totals: DataFrame, bits: int) -> list[Range]:
    return [Range(bits, *row) for row in totals.collect()]


def cut_points(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """Hashes at which shards 1, 2, ... begin, and the capacity. ``groups``: hash, bytes."""
    found = sorted(_ranges(_totals(groups, FIRST_BITS), FIRST_BITS), key=lambda r: r.first)
    while True:
        sizes = [r.total for r in found]
        if not sizes:
            return [], 0
        capacity = smallest_capacity(sizes, shards)  # upper bound while ranges are coarse
        before = [0, *accumulate(sizes)]
        fair = -(-before[-1] // shards)
        # Where shard number k can end: no earlier than with whole ranges of the smallest
        # capacity, no later than k times the largest one.
        vague: set[int] = set()
        low = 0
        for k in range(1, shards):
            start = max(0, bisect_right(before, before[low] + fair) - 1)
            high = bisect_right(before, min(k * capacity, before[-1])) - 1
            vague.update(range(start, min(high, len(found) - 1) + 1))
            low = max(low, start)
        finer: dict[int, list[int]] = {}
        for i in vague:
            if not found[i].atomic:
                finer.setdefault(found[i].bits, []).append(i)
        if not finer:
            cuts = greedy(before, shards, capacity)
            return [found[c].first for c in cuts], capacity
        made: list[Range] = []
        for bits, places in finer.items():
            wanted = [found[i].key for i in places]
            inside = groups.where(F.shiftright("hash", 64 - bits).isin(wanted))
            next_bits = min(64, bits + NEXT_BITS)
            made += _ranges(_totals(inside, next_bits), next_bits)
        gone = {i for places in finer.values() for i in places}
        found = sorted(
            [r for i, r in enumerate(found) if i not in gone] + made, key=lambda r: r.first
        )


def heavy_groups(groups: DataFrame, shards: int) -> list[int]:
    """Hashes of groups that exceed the fair share of what is left, largest first."""
    largest = groups.orderBy(F.desc("bytes"), "hash").limit(shards).collect()
    left = groups.agg(F.sum("bytes")).first()[0] or 0
    alone: list[int] = []
    for row in largest[: shards - 1]:
        if row["bytes"] * (shards - len(alone)) <= left:
            break
        alone.append(row["hash"])
        left -= row["bytes"]
    return alone


def _shard(alone: list[int], cuts: list[int]) -> Column:
    shard = F.lit(len(alone))
    for cut in cuts:
        shard = shard + (F.col("hash") >= F.lit(cut)).cast("int")
    for i, value in enumerate(alone):
        shard = F.when(F.col("hash") == F.lit(value), F.lit(i)).otherwise(shard)
    return shard.cast("int")


def shard(docs: DataFrame, keep: list[str], shards: int = 16, text: str = "text") -> DataFrame:
    """Columns ``keep`` plus ``size, text_crc32, shard, slot``; slots count from 0 in each shard."""
    value = F.coalesce(F.col(text), F.lit(""))
    rows = stage(
        docs.select(
            *(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)),
            F.xxhash64(value).alias("hash"),
            (F.octet_length(value) + 1).cast("long").alias("size"),
            F.crc32(value).alias("text_crc32"),
        ),
        "shard-rows",
    )
    groups = stage(rows.groupBy("hash").agg(F.sum("size").alias("bytes")), "shard-groups")
    alone = heavy_groups(groups, shards)
    rest = groups.where(~F.col("hash").isin(alone)) if alone else groups
    cuts, _ = cut_points(rest, shards - len(alone))
    kept = [f"_{i}" for i in range(len(keep))]
    cell = F.pmod(F.xxhash64(*kept), F.lit(CELLS)).cast("int") if kept else F.lit(0)
    placed = rows.withColumn("shard", _shard(alone, cuts)).withColumn("cell", cell)
    cells = placed.groupBy("shard", "cell").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(W.partitionBy("shard").orderBy("cell")) - F.col("rows")
    offsets = cells.select("shard", "cell", before.alias("offset"))  # shards * CELLS rows at most
    rank = F.row_number().over(W.partitionBy("shard", "cell").orderBy(*kept, "hash")) - 1
    return (
        placed.withColumn("rank", rank)
        .join(F.broadcast(offsets), ["shard", "cell"])
        .select(
            *(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)),
            "size", "text_crc32", "shard", (F.col("rank") + F.col("offset")).cast("long").alias("slot"),
        )
    )


def query(docs: DataFrame) -> DataFrame:
    return shard(docs, ["doc_id"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
