"""Merkle manifest of a table, with a proof for every row.

A row is a leaf: the SHA-256 of its fields. The leaves of a source, ascending by id, are the first
level of its tree; every ``ARITY`` nodes in a row become their hash (the last ones may be fewer, even
one) until one is left. The trees' roots, ordered by source, make the root in the same way. Digests
are hashed as hex text.

Incremental witnesses. A witness is what stands beside a node's path, level by level. ``Appender`` takes
nodes one after the other and keeps the open subtrees only, each with the partial witnesses of the nodes
in it; when the last sibling completes a run, the siblings extend the witnesses of all nodes below. The
leaves are numbered and dealt into aligned blocks of ``BLOCK`` nodes, so that any task can append one block.
Block roots are appended in the same way, block by block, and so are the trees' roots at last. On the
way down, a block's own witness extends those of its nodes, and the proofs come out with the leaves.

No task holds more than one block, so one source may have all rows. Texts are hashed where they are
read and never shuffled. Rows are ordered by id (nulls first), then by leaf; equal rows are numbered as
they come and have the same leaf. Null fields are ``-``; null sources are a tree of their own, the
first one. Other columns, of any name, are left out. An empty table has no proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill.llm.rows import map_groups, map_slices, small_side
from voxmill.sources.staging import stage

ARITY = 3
DEPTH = 7
#: Nodes of a block: a whole number of levels.
BLOCK = ARITY**DEPTH
#: Most leaves, on average, of a range that is sorted to number them.
RANGE_ROWS = 200_000

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64

Level = tuple[tuple[str, ...], tuple[str, ...]]  # siblings on the left, on the right


def node_hash(children) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


def pack(witness: list[Level]) -> str:
    return "".join(f"{len(left)}{len(right)}{''.join(left)}{''.join(right)}" for left, right in witness)


def unpack(packed: str) -> list[Level]:
    levels, at = [], 0
    while at < len(packed):
        left, right = int(packed[at]), int(packed[at + 1])
        own = tuple(packed[i:i + _HEX] for i in range(at + 2, at + 2 + _HEX * (left + right), _HEX))
        levels.append((own[:left], own[left:]))
        at += 2 + _HEX * (left + right)
    return levels


def fold(digest: str, witness: list[Level]) -> str:
    """The root that a node and the siblings on its path make."""
    for left, right in witness:
        digest = node_hash((*left, digest, *right))
    return digest


def proof_hash(witness: list[Level]) -> str:
    return node_hash(d for left, right in witness for d in (*left, *right))


class Appender:
    """Nodes appended one after the other. ``witnesses[i]`` grows as the subtrees around node ``i`` close."""

    def __init__(self) -> None:
        #: By level: complete subtrees whose run is not complete, as (digest, first node, end).
        self.open: list[list[tuple[str, int, int]]] = [[]]
        self.witnesses: list[list[Level]] = []

    def append(self, digest: str) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._add(0, (digest, at, at + 1))

    def _add(self, level: int, subtree: tuple[str, int, int]) -> None:
        while True:
            if level == len(self.open):
                self.open.append([])
            run = self.open[level]
            run.append(subtree)
            if len(run) < ARITY:
                return
            subtree = self._complete(level)
            level += 1

    def _complete(self, level: int) -> tuple[str, int, int]:
        """The parent of the run on ``level``; its children's witnesses get their siblings."""
        run = self.open[level]
        digests = tuple(d for d, _, _ in run)
        for i, (_, first, end) in enumerate(run):
            beside = digests[:i], digests[i + 1:]
            for witness in self.witnesses[first:end]:
                witness.append(beside)
        parent = node_hash(digests), run[0][1], run[-1][2]
        run.clear()
        return parent

    def close(self, depth: int | None = None) -> str:
        """Complete what is open, up to ``depth`` levels or until one node is left; its digest."""
        level = 0
        while True:
            above = any(self.open[level + 1:])
            if depth is None and not above and len(self.open[level]) == 1 or level == depth:
                return self.open[level][0][0]
            if self.open[level]:
                parent = self._complete(level)
                if level + 1 == len(self.open):
                    self.open.append([])
                # A run below was not complete, so the one above has room for this last subtree.
                self.open[level + 1].append(parent)
            level += 1


def append_all(digests: list[str], alone: bool) -> tuple[str, list[list[Level]]]:
    """(root, witnesses) of one block; a block that is not ``alone`` in its tree always has ``DEPTH`` levels."""
    block = Appender()
    for digest in digests:
        block.append(digest)
    return block.close(None if alone else DEPTH), block.witnesses


# Leaves


def _field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(text: Column, others: tuple[str, ...] = FIELDS[:-1]) -> Column:
    return F.sha2(F.encode(F.concat(*(_field(F.col(c)) for c in others), _field(text)), "UTF-8"), 256)


def leaves(docs: DataFrame, claimed: Column | None = None) -> DataFrame:
    """doc_id, source, leaf and the leaf that is ``claimed``, null where it is the same. No shuffle."""
    return docs.select(
        "doc_id", "source", leaf(F.col("text")).alias("leaf"),
        (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"),
    )


# Numbering


def _numbered(rows: DataFrame, keys: list[str], order: list[str], count: int) -> DataFrame:
    """``rows`` (a stage table) with ``pos`` from 0 and ``total`` in each group of equal ``keys``.

    Ranges of ``keys`` and ``order`` are sorted; a group's rows may lie in many ranges, whose totals are added up.
    """
    names = rows.columns
    tie = F.monotonically_increasing_id()  # equal rows can be dealt to several ranges
    ranges = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // RANGE_ROWS))
    by = [*keys, *order, "_tie"]
    sorted_ = rows.withColumn("_tie", tie).repartitionByRange(ranges, *by).sortWithinPartitions(*by)
    schema = T.StructType([
        *rows.schema.fields, T.StructField("_range", T.IntegerType()), T.StructField("_place", T.LongType()),
    ])
    at = [names.index(k) for k in keys]

    state: list = [None, 0]  # of the task: the group it is in, rows so far

    def number(*columns):
        mine = TaskContext.get().partitionId()
        for row in zip(*columns):
            key = tuple(row[i] for i in at)
            if key != state[0]:
                state[:] = [key, 0]
            yield (*row, mine, state[1])
            state[1] += 1

    placed = stage(map_slices(sorted_.drop("_tie"), schema, number, rows=10_000), "merkle-placed")
    parts = placed.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    group = W.partitionBy(*keys)
    parts = stage(parts.select(
        *(F.col(k).alias(f"_{k}") for k in keys), F.col("_range").alias("_part"),
        (F.sum("_n").over(group.orderBy("_range")) - F.col("_n")).alias("_before"), F.sum("_n").over(group).alias("total"),
    ), "merkle-ranges")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + [F.col("_range") == F.col("_part")]
    condition = same[0]
    for c in same[1:]:
        condition &= c
    return placed.join(small_side(parts), condition).select(
        *names, (F.col("_before") + F.col("_place")).alias("pos"), "total"
    )


# Trees

_ROOT = T.StructType([T.StructField("digest", T.StringType())])


def _roots(nodes: DataFrame) -> DataFrame:
    """One node a block: (tree, pos, total, digest) of the level ``DEPTH`` above, or the tree's root."""
    schema = T.StructType([
        T.StructField("tree", nodes.schema["tree"].dataType), T.StructField("pos", T.LongType()),
        T.StructField("total", T.LongType()), *_ROOT,
    ])

    def work(key, places, digests):
        tree, total, block = key
        ordered = [d for _, d in sorted(zip(places, digests))]
        yield tree, block, -(-total // BLOCK), append_all(ordered, total <= BLOCK)[0]

    blocks = nodes.select("tree", "total", F.floor(F.col("pos") / BLOCK).alias("block"), "pos", "digest")
    return map_groups(blocks, ["tree", "total", "block"], schema, work)


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """Stage tables from ``nodes`` up; the last one has one node, the root, for every tree."""
    levels = [nodes]
    while True:
        levels.append(stage(_roots(levels[-1]), "merkle-level"))
        if (levels[-1].agg(F.max("total")).first()[0] or 1) <= 1:
            return levels


def _with_blocks(nodes: DataFrame, above: DataFrame, extra: list[str]) -> DataFrame:
    """``nodes`` by tree and block, beside one row without digest for each block: its head and witness."""
    none = lambda c: F.lit(None).cast(nodes.schema[c].dataType).alias(c)
    text = lambda c: F.lit(None).cast("string").alias(c)
    block = F.floor(F.col("pos") / BLOCK).alias("block")
    own = nodes.select("tree", block, "pos", "total", "digest", *extra, text("head"), text("witness"))
    return own.unionByName(above.select(
        "tree", F.col("pos").alias("block"), *map(none, ["pos", "total", "digest", *extra]), "head", "witness"
    ))


def _extended(places, totals, digests, witnesses) -> Iterator[tuple[int, list[Level]]]:
    """For each node of a block its row's number and its whole witness."""
    upper = unpack(next(w for w in witnesses if w is not None))
    rows = sorted((p, i) for i, p in enumerate(places) if p is not None)
    _, own = append_all([digests[i] for _, i in rows], totals[rows[0][1]] <= BLOCK)
    for (_, i), witness in zip(rows, own):
        yield i, witness + upper


def _down(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """tree, pos, head, witness of ``nodes``, from those of the nodes above them."""
    schema = T.StructType([
        T.StructField("tree", nodes.schema["tree"].dataType), T.StructField("pos", T.LongType()),
        T.StructField("head", T.StringType()), T.StructField("witness", T.StringType()),
    ])

    def work(key, places, totals, digests, heads, witnesses):
        head = next(h for h in heads if h is not None)
        for i, witness in _extended(places, totals, digests, witnesses):
            yield key[0], places[i], head, pack(witness)

    return map_groups(_with_blocks(nodes, above, []), ["tree", "block"], schema, work)


def _descend(levels: list[DataFrame], top: DataFrame) -> DataFrame:
    """From the roots' witnesses to those of the blocks of ``levels[0]``; ``pos`` numbers the blocks."""
    for nodes in reversed(levels[1:-1]):
        top = stage(_down(nodes, top), "merkle-witnesses")
    return top


def manifest(rows: DataFrame) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof, proof_sha256, folded_root, verified of every row.

    ``rows``: doc_id, source, leaf, claimed, as ``leaves`` gives them. ``proof`` is the packed witness up to the root;
    ``folded_root`` is what the claimed leaf, or else the leaf, and the witness make.
    """
    spark = rows.sparkSession
    rows = stage(rows, "merkle-leaves")
    nodes = stage(_numbered(rows, ["source"], ["doc_id", "leaf"], rows.count()).select(
        F.col("source").alias("tree"), "pos", "total", F.col("leaf").alias("digest"), "doc_id", "claimed"
    ), "merkle-nodes")
    trees = _climb(nodes.select("tree", "pos", "total", "digest"))

    subroots = trees[-1].select(F.lit(0).alias("all"), F.col("tree").alias("source"), "digest")
    ordered = stage(_numbered(subroots, ["all"], ["source"], subroots.count()), "merkle-subroots")
    top = ordered.select(F.col("all").alias("tree"), "pos", "total", "digest")
    heads = _climb(top)
    found = heads[-1].first()  # the root, the only node there
    root = found["digest"] if found else None
    crown = spark.createDataFrame([(0, 0, "", "")], "tree int, pos long, head string, witness string")
    crown = _down(top, _descend(heads, crown.where(F.lit(found is not None)))).select("pos", "witness")
    above = ordered.join(crown, "pos").select(
        F.col("source").alias("tree"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("head"), "witness"
    )
    return _proofs(nodes, _descend(trees, stage(above, "merkle-witnesses")), root)


def _proofs(nodes: DataFrame, above: DataFrame, root: str | None) -> DataFrame:
    kinds = {c: nodes.schema[c].dataType for c in ("doc_id", "tree")}
    text = ["leaf", "subroot", "root", "proof", "proof_sha256", "folded_root"]
    schema = T.StructType([
        T.StructField("doc_id", kinds["doc_id"]), T.StructField("source", kinds["tree"]),
        *(T.StructField(c, T.StringType()) for c in text), T.StructField("verified", T.BooleanType()),
    ])

    def work(key, places, totals, digests, ids, claims, heads, witnesses):
        subroot = next(h for h in heads if h is not None)
        for i, witness in _extended(places, totals, digests, witnesses):
            folded = fold(claims[i] or digests[i], witness)
            yield (
                ids[i], key[0], digests[i], subroot, root, pack(witness), proof_hash(witness), folded, folded == root,
            )

    return map_groups(_with_blocks(nodes, above, ["doc_id", "claimed"]), ["tree", "block"], schema, work)


def query(docs: DataFrame) -> DataFrame:
    """The manifest, checked against rows some of which lost their line feeds."""
    even = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    stripped = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    made = manifest(leaves(docs, F.when(even, leaf(stripped))))
    return made.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, concat(CAST(octet_length(encode(CAST(doc_id AS VARCHAR))) AS VARCHAR), ':', CAST(doc_id AS VARCHAR),
      coalesce(octet_length(encode(source)) || ':' || source, '-'), coalesce(octet_length(encode(lang)) || ':' || lang, '-'),
      coalesce(length(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS front FROM documents),
-- unsigned crc32 of the decimal id; only its lowest bit is used
ids AS (SELECT doc_id, encode(CAST(doc_id AS VARCHAR)) AS b FROM d),
crc(doc_id, b, i, c) AS (
  SELECT doc_id, hex(b), 0, CAST(4294967295 AS BIGINT) FROM ids
  UNION ALL
  SELECT doc_id, b, i + 1, list_reduce(range(0, 8), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END,
      xor(c, CAST('0x' || substr(b, 2 * i + 1, 2) AS BIGINT)))
  FROM crc WHERE 2 * i < length(b)),
even AS (SELECT doc_id FROM crc WHERE 2 * i = length(b) AND xor(c, 4294967295) % 2 = 0),
leaf AS (
  SELECT d.doc_id, source, sha256(front || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    CASE WHEN e.doc_id IS NOT NULL
      THEN sha256(front || coalesce(octet_length(encode(replace(text, chr(10), ''))) || ':' || replace(text, chr(10), ''), '-')) END AS tampered,
    row_number() OVER (PARTITION BY source ORDER BY d.doc_id) - 1 AS pos
  FROM d LEFT JOIN even e ON e.doc_id = d.doc_id),
tree(source, lvl, pos, h, n) AS (
  SELECT source, 0, pos, leaf, count(*) OVER (PARTITION BY source) FROM leaf
  UNION ALL
  SELECT source, lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 2) // 3
  FROM tree WHERE n > 1 GROUP BY source, lvl, pos // 3),
sub AS (SELECT source, h AS subroot, lvl AS depth, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos FROM tree WHERE n = 1),
top(lvl, pos, h, n) AS (
  SELECT 0, pos, subroot, count(*) OVER () FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos)), (max(n) + 2) // 3
  FROM top WHERE n > 1 GROUP BY lvl, pos // 3),
root AS (SELECT h AS root, lvl AS height FROM top WHERE n = 1),
-- for every leaf and level: what stands left and right of its path
beside AS (
  SELECT l.doc_id, t.lvl, string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < l.pos // CAST(pow(3, t.lvl) AS BIGINT)) AS a,
    string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > l.pos // CAST(pow(3, t.lvl) AS BIGINT)) AS b
  FROM leaf l JOIN sub s ON s.source IS NOT DISTINCT FROM l.source JOIN tree t ON t.source IS NOT DISTINCT FROM l.source
    AND t.lvl < s.depth AND t.pos // 3 = l.pos // CAST(pow(3, t.lvl + 1) AS BIGINT)
  GROUP BY l.doc_id, t.lvl
  UNION ALL
  SELECT l.doc_id, s.depth + t.lvl, string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < s.pos // CAST(pow(3, t.lvl) AS BIGINT)),
    string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > s.pos // CAST(pow(3, t.lvl) AS BIGINT))
  FROM leaf l JOIN sub s ON s.source IS NOT DISTINCT FROM l.source CROSS JOIN root r JOIN top t ON
    t.lvl < r.height AND t.pos // 3 = s.pos // CAST(pow(3, t.lvl + 1) AS BIGINT)
  GROUP BY l.doc_id, s.depth, t.lvl),
path AS (
  SELECT doc_id, sha256(coalesce(string_agg(coalesce(a, '') || coalesce(b, ''), '' ORDER BY lvl), '')) AS proof_sha256,
    list(coalesce(a, '') || '|' || coalesce(b, '') ORDER BY lvl) AS levels
  FROM beside GROUP BY doc_id),
folded AS (
  SELECT l.doc_id, l.leaf, l.source, coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
    list_reduce(coalesce(levels, []), lambda h, x: sha256(split_part(x, '|', 1) || h || split_part(x, '|', 2)),
      coalesce(l.tampered, l.leaf)) AS folded_root
  FROM leaf l LEFT JOIN path p USING (doc_id))
SELECT f.doc_id, f.leaf, s.subroot, r.root, f.proof_sha256, f.folded_root, f.folded_root = r.root AS verified
FROM folded f JOIN sub s ON s.source IS NOT DISTINCT FROM f.source CROSS JOIN root r
"""
