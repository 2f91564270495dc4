"""Near-duplicate join on word shingles: MinHash bands, then exact Jaccard.

A text's set: hashes of its runs of five words (lower-cased ``\\w+``; a shorter text has one run of
all its words). Texts with equal sets are one node with a weight. Each node has ``TREES`` labels of
``DEPTH`` MinHash values. The first values of a label are a band, of one length for all, the longest that gives
the wanted recall for the threshold (``prefix_for``); nodes that meet in a band are compared by their signatures first. What
passes is gathered into candidate groups by connected components, every group's sets are fetched
once, and all its pairs are verified exactly.

Groups are cut into blocks of ``BLOCK`` nodes, and each pair of blocks is a task of its own, so no
task holds an unbounded group. Pairs never become rows: a task returns, per node, the weight of
its links and one spanning link.

Null texts count as empty; texts without words have equal (empty) sets. Repeated rows and copies
are one node. An empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill.llm.components import components
from voxmill.llm.rows import map_groups, map_slices, small_side
from voxmill.sources.staging import settled, stage

WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 20, 6
RECALL = 0.9999
#: Signatures that agree in this share or more are verified: 4 standard deviations below 0.8.
SKETCH = 0.65
BLOCK = 2048
#: Words whose hashes a worker keeps; a full table starts anew.
KNOWN_WORDS = 150_000

_WORD = re.compile(r"\w+")
_RANDOM = np.random.RandomState(11)
_FACTOR = _RANDOM.randint(1, 2**62, TREES * DEPTH).astype(np.uint64) * 2 + 1
_SHIFT = _RANDOM.randint(1, 2**62, TREES * DEPTH).astype(np.uint64)


def prefix_for(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix that still finds a pair of ``threshold`` with the wanted probability."""
    for length in range(depth, 1, -1):
        if 1 - (1 - threshold**length) ** trees >= recall:
            return length
    return 1


class Shingler:
    """Shingle sets; keeps the hashes of the words it has met."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def set_of(self, text: str | None) -> np.ndarray:
        words = _WORD.findall((text or "").lower())
        if len(words) < WORDS:
            whole = xxhash.xxh3_64_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))
            return np.array([whole] if words else [], np.uint64)
        known = self.known
        try:
            hashes = [known[w] for w in words]
        except KeyError:
            if len(known) > KNOWN_WORDS:
                known.clear()
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
            hashes = [known[w] for w in words]
        h = np.array(hashes, np.uint64)
        n = len(h) - WORDS + 1
        made = np.zeros(n, np.uint64)
        for j in range(WORDS):
            made = (made ^ (made >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n]
        made = (made ^ (made >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return np.unique(made ^ (made >> np.uint64(32)))


def signature(shingles: np.ndarray) -> np.ndarray:
    """TREES * DEPTH MinHash values of 16 bits; zeros for an empty set."""
    if not len(shingles):
        return np.zeros(TREES * DEPTH, np.uint16)
    low = np.full(TREES * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at:at + 4096, None] * _FACTOR + _SHIFT
        np.minimum(low, part.min(axis=0), out=low)
    return ((low * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(48)).astype(np.uint16)


_SHINGLER = Shingler()
_NODE = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("tkey", T.StringType()),
    T.StructField("node", T.LongType()), T.StructField("sig", T.BinaryType()),
])


def node_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def _forget() -> None:
    """Hashing a task's words anew costs little; kept, they would lie in the worker in all later stages."""
    _SHINGLER.known = {}


def _nodes(ids, keys, texts):
    for id_, key, text in zip(ids, keys, texts):
        shingles = _SHINGLER.set_of(text)
        yield id_, key, node_of(shingles), signature(shingles).tobytes()


def _blocks(members: DataFrame, group: list[str], item: str) -> DataFrame:
    """``members`` with ``i, j``: each pair of blocks of a group once, as its own smaller group."""
    sizes = members.groupBy(*group).agg(F.count("*").alias("_n")).where(F.col("_n") > 1)
    cut = members.join(sizes, group)
    count = F.ceil(F.col("_n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64(item), count).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), count - 1), lambda x: F.struct(
        F.least(mine, x).alias("i"), F.greatest(mine, x).alias("j")
    ))
    return (
        cut.withColumn("mine", mine).withColumn("_p", F.explode(pairs))
        .select("*", F.col("_p.i").alias("i"), F.col("_p.j").alias("j")).drop("_p", "_n")
    )


class Forest:
    """Union-find over the places 0 .. n-1, with the smaller root kept."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def _spread(linked: np.ndarray, forest: Forest, offset: int = 0) -> None:
    """Join each row of a block of the link matrix with the columns it is linked to."""
    for x, row in enumerate(linked):
        for y in np.flatnonzero(row):
            forest.join(offset + x, int(y))


_LINK = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _sketch_links(key, nodes, sigs, mine):
    """Nodes of one trie node whose signatures agree, as links to the smallest of each component."""
    order = sorted(range(len(nodes)), key=lambda x: nodes[x])
    n, need = len(order), SKETCH * TREES * DEPTH
    rows = np.frombuffer(b"".join(sigs[x] for x in order), np.uint16).reshape(n, -1)
    forest = Forest(n)
    # Whole labels first: equal ones are linked without comparing each with each.
    first: dict[bytes, int] = {}
    for x in range(n):
        forest.join(first.setdefault(rows[x].tobytes(), x), x)
    heads = np.array(sorted(first.values()))
    own = rows[heads]
    for at in range(0, len(heads), 64):
        agree = (own[at:at + 64, None, :] == own[None, :, :]).sum(axis=2) >= need
        for x, row in enumerate(agree):
            for y in np.flatnonzero(row):
                forest.join(int(heads[at + x]), int(heads[y]))
    for x in range(n):
        root = forest.root(x)
        if root != x:
            yield nodes[order[x]], nodes[order[root]]


def _verify(key, nodes, weights, sets, mine):
    """Per node: the weight of its links in this pair of blocks, and a spanning link."""
    _, i, j = key
    order = sorted(range(len(nodes)), key=lambda x: nodes[x])
    n = len(order)
    parts = [np.frombuffer(sets[x], np.uint64) for x in order]
    size = np.array([len(p) for p in parts], np.float32)
    weight = np.array([weights[x] for x in order], np.int64)
    side = np.array([mine[x] for x in order])
    features, place = np.unique(np.concatenate(parts), return_inverse=True)
    owner = np.repeat(np.arange(n), [len(p) for p in parts])
    common = np.bincount(place, minlength=len(features))
    keep = np.flatnonzero(common > 1)  # others are in no intersection
    number = np.full(len(features), -1)
    number[keep] = np.arange(len(keep))
    column = number[place]
    owner, column = owner[column >= 0], column[column >= 0]
    by_column = np.argsort(column, kind="stable")
    owner, column = owner[by_column], column[by_column]
    shared = np.zeros((n, n), np.float32)
    for at in range(0, len(keep), 2048):
        low, high = np.searchsorted(column, [at, at + 2048])
        x = np.zeros((n, min(2048, len(keep) - at)), np.float32)
        x[owner[low:high], column[low:high] - at] = 1
        shared += x @ x.T
    # shared / (a + b - shared) >= t, in whole numbers that float32 holds exactly
    linked = shared * 5 >= (size[:, None] + size[None, :] - shared) * 4
    np.fill_diagonal(linked, False)
    if i != j:
        linked &= side[:, None] != side[None, :]
    elif (side != i).any():
        raise ValueError("a block holds a foreign node")
    links = linked @ weight
    forest = Forest(n)
    _spread(linked, forest)
    for x in range(n):
        yield nodes[order[x]], int(links[x]), nodes[order[forest.root(x)]]


_VERIFIED = T.StructType([
    T.StructField("node", T.LongType()), T.StructField("links", T.LongType()),
    T.StructField("near", T.LongType()),
])


def join(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """id, tkey (md5 of the text), class_id, n_links, for every row of ``docs``.

    ``class_id``: smallest id of the connected group of near copies; ``n_links``: how many other
    distinct texts have a similarity of at least 0.8 with this one.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    rows = stage(
        map_slices(
            docs.select(F.col(id_col).cast("long").alias("id"), F.md5(value).alias("tkey"), value.alias("_t")),
            _NODE, _nodes, done=_forget,
        ),
        "near-rows",
    )
    texts = rows.groupBy("tkey").agg(F.min("id").alias("id"), F.first("node").alias("node"))
    nodes = stage(
        texts.groupBy("node").agg(
            F.min("id").alias("id"), F.count("*").alias("weight"), F.min("tkey").alias("tkey")
        ),
        "near-nodes",
    )
    texts = docs.select(F.md5(value).alias("tkey"), value.alias("_t"))
    found = settled(docs.sparkSession, lambda: verified(texts, rows, nodes), "near-links")
    named = stage(
        nodes.join(found, "node", "left").select(
            "node", "id", F.coalesce("root", "node").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        ),
        "near-named",
    )
    lowest = named.groupBy("root").agg(F.min("id").alias("class_id"))
    named = named.join(lowest, "root").select("node", "class_id", "n_links")
    return rows.select("id", "tkey", "node").join(named, "node").select("id", "tkey", "class_id", "n_links")


def verified(texts: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, links, root for the nodes that have links."""
    length = prefix_for(THRESHOLD, TREES, DEPTH, RECALL)
    width = DEPTH * 2
    prefix = [
        F.xxhash64(F.lit(t), F.substring(F.col("sig"), t * width + 1, length * 2)) for t in range(TREES)
    ]
    signed = rows.select("node", "sig").groupBy("node").agg(F.first("sig").alias("sig"))
    signed = stage(signed, "near-signatures")
    met = signed.select("node", F.explode(F.array(*prefix)).alias("bucket"))
    several = met.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = stage(met.join(several, "bucket"), "near-buckets")
    blocks = _blocks(members, ["bucket"], "node").join(signed, "node")
    links = map_groups(blocks.select("bucket", "i", "j", "node", "sig", "mine"), ["bucket", "i", "j"],
                       _LINK, _sketch_links)
    groups = stage(components(links), "near-groups")
    wanted = groups.select("node", F.col("root").alias("group")).join(
        nodes.select("node", "weight", "tkey"), "node"
    )
    wanted = stage(wanted, "near-wanted")
    chosen = texts.join(small_side(wanted, 96), "tkey").dropDuplicates(["node"])

    def sets(*columns):
        for group, node, weight, value in zip(*columns):
            yield group, node, weight, _SHINGLER.set_of(value).tobytes()

    schema = T.StructType([
        T.StructField("group", T.LongType()), T.StructField("node", T.LongType()),
        T.StructField("weight", T.LongType()), T.StructField("set", T.BinaryType()),
    ])
    fetched = stage(
        map_slices(chosen.select("group", "node", "weight", "_t"), schema, sets, done=_forget), "near-sets"
    )
    blocks = _blocks(fetched, ["group"], "node")
    pairs = stage(
        map_groups(blocks.select("group", "i", "j", "node", "weight", "set", "mine"),
                   ["group", "i", "j"], _VERIFIED, _verify),
        "near-verified",
    )
    total = pairs.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(pairs.select(F.col("node").alias("a"), F.col("near").alias("b")))
    return total.join(roots, "node", "left").where("links > 0")


def query(docs: DataFrame) -> DataFrame:
    return join(docs).select(F.col("id").alias("doc_id"), "class_id", "n_links")


def _kept(docs: DataFrame) -> DataFrame:
    """id, tkey of the rows that stay, n: how many rows are alike in both."""
    rows = stage(join(docs), "near-classes")
    order = F.struct(F.col("id").isNull().alias("none"), "id", "tkey")
    kept = rows.groupBy("class_id").agg(F.min(order).alias("k")).where("class_id IS NOT NULL")
    # Groups in which no row has an id keep one row for each distinct text.
    blind = rows.where("class_id IS NULL").select("id", "tkey").distinct()
    kept = kept.select("k.id", "k.tkey").union(blind)
    times = rows.groupBy("id", "tkey").agg(F.count("*").alias("n")).where("n > 1")
    own = times.select(F.col("id").alias("_id"), F.col("tkey").alias("_tkey"), "n")
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("tkey") == F.col("_tkey"))
    return kept.join(own, same, "left").select("id", "tkey", F.coalesce("n", F.lit(1)).alias("n"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: the one with the smallest id of each group stays."""
    kept = settled(docs.sparkSession, lambda: _kept(docs), "near-kept")
    names = docs.columns
    own = docs.select(
        *(F.col(c).alias(f"_{i}") for i, c in enumerate(names)),
        F.col("doc_id").cast("long").alias("id"),
        F.md5(F.coalesce("text", F.lit(""))).alias("tkey"),
    )
    both = own["id"].eqNullSafe(kept["id"]) & (own["tkey"] == kept["tkey"])
    left = own.join(kept, both, "left_semi")
    if kept.where("n > 1").limit(1).count():
        left = left.dropDuplicates(["id", "tkey"])
    return left.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(names)))
