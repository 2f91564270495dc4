"""Merkle manifest against a plain version that holds all trees at once."""

import hashlib
import random
import zlib

import pytest

from voxmill.llm import merkle

DOC = "doc_id long, source string, lang string, n_chars long, text string, pos long, witness string, head string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(digests):
    """(root, for each node the list of (left, right) siblings)"""
    levels = [digests]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    paths = []
    for i in range(len(digests)):
        path = []
        for level in levels[:-1]:
            run = i // 3 * 3
            path.append((tuple(level[run:i]), tuple(level[i + 1:run + 3])))
            i //= 3
        paths.append(path)
    return levels[-1][0], paths


def plainly(rows):
    leaf = lambda r, text: sha(*(field(r[c]) for c in ("doc_id", "source", "lang", "n_chars")), field(text))
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    made, subroots = [], []
    for name in names:
        own = sorted(by[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        subroot, paths = tree([leaf(r, r["text"]) for r in own])
        subroots.append(subroot)
        made.append((own, paths))
    root, tops = tree(subroots)
    out = []
    for subroot, top, (own, paths) in zip(subroots, tops, made):
        for r, path in zip(own, paths):
            digest, text = leaf(r, r["text"]), r["text"]
            if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            proof = sha(*(d for left, right in path + top for d in (*left, *right)))
            folded = leaf(r, text)
            for left, right in path + top:
                folded = sha(*left, folded, *right)
            out.append((r["doc_id"], digest, subroot, root, proof, folded, folded == root))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    sources = [None, "", "a", "ä", "\U0001f600", "￿"] + [f"s{i}" for i in range(40)]
    rows = [(i, rng.choice(sources), rng.choice([None, "en"]), i % 7 or None, rng.choice([None, "", "a\nb", "ü\n", f"t{i}", "\n" * 5000]), 1, "w", "h")
            for i in range(-200, 1200)]
    rows += [(10_000 + i, "hot", "en", 3, f"line\n{i}", None, None, None) for i in range(2 * merkle.BLOCK + 5)]
    rows += [(None, "a", None, None, "x\ny", 0, "", "")] * 3 + [rows[0]] * 5 + [(3, "a", None, None, "other", 0, "", "")]
    return spark.createDataFrame(rows, DOC).repartition(5)


def test_query_against_plain_version(docs):
    got = sorted((tuple(r) for r in merkle.query(docs).collect()), key=repr)
    want = plainly(docs.collect())
    assert got == want
    assert {r[-1] for r in got} == {True, False}


def test_proofs_verify_without_the_table(docs):
    rows = merkle.manifest(merkle.leaves(docs)).sample(0.05, seed=1).collect()
    for r in rows:
        witness = merkle.unpack(r["proof"])
        assert merkle.fold(r["leaf"], witness) == r["root"] and r["verified"]
        assert merkle.fold(sha("x"), witness) != r["root"]
        assert merkle.proof_hash(witness) == r["proof_sha256"] and merkle.pack(witness) == r["proof"]


def test_appender_against_whole_trees():
    for n in [*range(1, 40), 81, 82, 243, 250]:
        digests = [sha(str(i)) for i in range(n)]
        root, paths = tree(digests)
        block = merkle.Appender()
        for i, d in enumerate(digests):
            block.append(d)
            # Only open subtrees are kept: fewer than three a level.
            assert all(len(run) < merkle.ARITY for run in block.open)
        assert block.close() == root and block.witnesses == paths


def test_blocks_of_a_larger_tree_have_all_levels():
    depth = merkle.DEPTH
    for n in (1, 2, 3, 10):
        root, witnesses = merkle.append_all([sha(str(i)) for i in range(n)], alone=False)
        assert all(len(w) == depth for w in witnesses)
        assert all(merkle.fold(sha(str(i)), w) == root for i, w in enumerate(witnesses))


def test_one_row_and_no_row(spark):
    one = spark.createDataFrame([(1, None, None, None, None, 0, "", "")], DOC)
    assert [tuple(r) for r in merkle.query(one).collect()] == plainly(one.collect())
    assert merkle.query(one.where("false")).count() == 0
