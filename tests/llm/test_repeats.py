"""Repeated strings and runs of words against brute force: awkward texts, hot passages, many copies."""

import hashlib
import random
import re

import numpy as np
import pytest

from voxmill.llm import repeats

rng = random.Random(21)
WORDS = ["".join(rng.choice("abcdefghijklm") for _ in range(rng.randint(2, 9))) for _ in range(900)]
SPACES = [" ", " ", " ", "\n", "  ", "　", "\xa0", " ", " ", "\x1c", "\x85", " "]


def words(n, spaces=(" ",)):
    return "".join(rng.choice(WORDS) + rng.choice(spaces) for _ in range(n))


def covered(windows, length):
    """Symbols covered in each text by windows that are there more than once."""
    seen = {}
    for own in windows:
        for w in own:
            seen[w] = seen.get(w, 0) + 1
    for own in windows:
        gone, end = [], 0
        for i, w in enumerate(own):
            if seen[w] > 1:
                gone += range(max(i, end), i + length)
                end = i + length
        yield gone


def brute(texts):
    data = [(t or "").encode() for t in texts]
    split = [re.findall(r"\S+", t or "") for t in texts]
    bytes_ = covered([[hash(d[i:i + 400]) for i in range(len(d) - 399)] for d in data], 400)
    runs = covered([[hash(tuple(s[i:i + 51])) for i in range(len(s) - 50)] for s in split], 51)
    for d, gone, run in zip(data, bytes_, runs):
        keep = np.ones(len(d), bool)
        keep[gone] = False
        spans = int((np.diff(np.concatenate(([0], ~keep))) == 1).sum())
        yield len(d), len(gone), spans, hashlib.sha256(np.frombuffer(d, np.uint8)[keep].tobytes()).hexdigest(), len(run)


def check(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = sorted(tuple(r) for r in repeats.query(table).collect())
    want = [(i, *r) for i, r in enumerate(brute(texts))]
    assert [g for g, w in zip(got, want) if g != w] == [] and len(got) == len(want)
    return got


def test_awkward_texts(spark):
    passage, wide = words(55), words(70, SPACES)
    texts = [
        None, "", "a" * 2000, "ab" * 700, "ab" * 900 + "c", words(30) + passage + words(30), words(20) + passage,
        words(9) + wide + words(3), wide + words(60, SPACES), wide.replace("　", " "), "日本語" * 400, "x" + "日本語" * 300,
        "\xa0" * 500, "　".join(["ü"] * 60), " ".join(["ü"] * 61), words(3000), passage, passage, "word " * 51, "word\n" * 52,
        words(49) + "end " + words(2), "\x00" * 450, "\x00" * 450 + "a",
    ]
    got = check(spark, texts)
    assert sum(r[2] > 0 for r in got) >= 10 and sum(r[5] > 0 for r in got) >= 8


def test_hot_passages_and_large_groups_of_near_copies(spark):
    """Hashes with thousands of segments: one passage and one text in many hands, each with its own edits."""
    passage, base = words(58), words(150).split()
    texts = []
    for i in range(1500):
        own = list(base)
        own[rng.randrange(150)] = f"edit{i}"
        texts.append(" ".join(own))
        texts.append(words(rng.randint(0, 30)) + passage + words(rng.randint(0, 30)))
    texts += [texts[0]] * 700 + [words(200) for _ in range(100)]
    got = check(spark, texts)
    assert sum(r[5] > 0 for r in got) == 3700


def test_long_text_in_pieces(spark, monkeypatch):
    shared = words(4000)
    check(spark, [words(15_000) + shared + words(15_000), words(10) + shared[5000:], words(30_000)])


def test_word_spans():
    for _ in range(300):
        text = "".join(rng.choice(["a", "ü", "日", "​", " ", " ", "᠎", "\x1f", "\t", *SPACES]) for _ in range(40))
        data = text.encode()
        starts, ends = repeats.word_spans(data)
        assert [data[a:b].decode() for a, b in zip(starts, ends)] == re.findall(r"\S+", text)


@pytest.mark.parametrize("law", [repeats.byte_law(400), repeats.word_law(51)])
def test_windows_that_occur_twice_are_candidates_under_one_hash(law):
    shared = words(150)
    texts = [words(rng.randint(0, 200)) + shared + words(rng.randint(0, 200)) for _ in range(6)] + ["ab" * 600] * 2
    texts.insert(3, "too short")
    symbols, begin = repeats.symbols_of(law, [t.encode() for t in texts])
    found = repeats.chunks(law, symbols, begin)
    values, times = np.unique(found.hashes, return_counts=True)
    under, where = {}, {}
    for k in range(len(texts)):
        count, first, mine = found.of(k)
        own = symbols[begin[k]:begin[k + 1]]
        assert count == len(own) and np.array_equal(own, repeats.symbols_of(law, [texts[k].encode()])[0])
        for hash_, a, b in repeats.segments(law, count, first, found.hashes[mine], np.isin(found.hashes[mine], values[times > 1])):
            for p in range(a, b + 1):
                under[k, p] = hash_
        for p in range(count - law.length + 1):
            where.setdefault(own[p:p + law.length].tobytes(), []).append((k, p))
    for places in where.values():
        if len(places) > 1:
            assert len({under[x] for x in places}) == 1


def test_pieces_do_not_change_chunks(monkeypatch):
    law = repeats.byte_law(400)
    texts = [words(n).encode() for n in (3000, 40, 200, 90, 5, 300)]
    alone = [repeats.chunks(law, *repeats.symbols_of(law, [t])) for t in texts]
    for piece in (500, 1013, 4096, 1 << 17):
        monkeypatch.setattr(repeats, "PIECE", piece)
        found = repeats.chunks(law, *repeats.symbols_of(law, texts))
        for k, one in enumerate(alone):
            count, first, mine = found.of(k)
            assert count == one.counts[0] and np.array_equal(first, one.first)
            assert np.array_equal(found.hashes[mine], one.hashes)
