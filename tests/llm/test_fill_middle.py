"""Fill-in-middle against a plain version that goes over one text at a time."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmill.llm import fill_middle as fm

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
DOC = "doc_id long, text string, form string, output string, n long"


def plainly(doc_id, text):
    text = text or ""
    units = TOKEN.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def made_up(count):
    rng = random.Random(3)
    pieces = [" ", "\n", "\t", "\x0b\x0c", "a", "bc", "ünï", "日本", "🙂", " ", "<", "<P", "P>", "<S", ">", "M"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 30))) for _ in range(count)]
    return texts + ["", None, " ", "x", "\n\n", "<P>", "a <M> b", "<P", "<", "日本語" * 400, "word " * 40_000, "x" * 300_000]


@pytest.fixture(scope="module")
def docs(spark):
    texts = made_up(800)
    rows = [(i, t, "clash", None, 7) for i, t in enumerate(texts)]
    rows += [rows[5], (None, "no id here at all", None, None, None), (None, None, None, None, None), (-4, "less than none", "x", "y", 0)]
    return spark.createDataFrame(rows, DOC)


def test_query_against_plain_version(docs):
    want = []
    for r in docs.collect():
        n, form, prefix, middle, output = plainly(r["doc_id"], r["text"])
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (output, r["text"] or "")]
        want.append((r["doc_id"], n, form, prefix, middle, *sha))
    got = [tuple(r) for r in fm.query(docs).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[2] for r in got} == set(fm.FORMS)


def test_outputs_and_restored_texts_beside_clashing_columns(docs):
    made = fm.transform(docs, ["doc_id", "text"], seed=42)
    rows = made.collect()
    assert all(r["output"] == plainly(r["doc_id"], r["text"])[4] for r in rows)
    back = fm.restore(made.withColumnRenamed("text", "was"), ["doc_id", "was"]).collect()
    assert len(back) == len(rows) and all(r["text"] == (r["was"] or "") for r in back)
    kept = fm.transform(docs.withColumnRenamed("form", "_0").withColumnRenamed("output", "+n"), ["_0", "+n"])
    assert kept.columns[:2] == ["_0", "+n"]
    assert sorted(map(repr, kept.select("_0", "+n").collect())) == sorted(
        map(repr, docs.select(F.col("form").alias("_0"), F.col("output").alias("+n")).collect())
    )


def test_every_cut_is_moved_in_steps_of_any_size(monkeypatch):
    texts = [t.encode() for t in made_up(60) if t is not None and len(t) < 1000]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    rng = np.random.default_rng(1)
    for step in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(fm, "STEP_BYTES", step)
        hashes = rng.integers(0, 1 << 32, (len(texts), 4))
        hashes[:, 2] = 0
        out, to, form, *_ = fm.scatter(data, offsets, hashes)
        back, at = fm.gather(out, to, form)
        assert back.tobytes() == data.tobytes() and at.tolist() == offsets.tolist()


def test_an_output_that_lost_a_mark_is_reported():
    data = np.frombuffer(b"<P>a<S>b", np.uint8)
    with pytest.raises(ValueError):
        fm.gather(data, np.array([0, len(data)]), np.array([fm.PSM]))


def test_empty_table(spark):
    assert fm.query(spark.createDataFrame([], DOC)).count() == 0
