"""Each operator on small awkward tables, against brute force where there is one."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from voxmill.llm import (
    bpe, decontaminate, fingerprints, html_templates, near_join, queries, range_coder, repeats,
    sharding, token_files, toxicity, url_filter,
)

DOC = "doc_id long, text string, lang string, source string, n_chars long, start string, path string"
rng = random.Random(5)
WORDS = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]


def words(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


BASE = words(120)
TEXTS = [
    None, "", "one", "ünïcødé wörds 日本語 <|endoftext|> don't", BASE, BASE, BASE.replace(BASE.split()[60], "zz", 1),
    words(90), "prefix " + words(30) + " " + BASE[100:560] + " " + words(20), "ab " * 500, words(6000),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if i % 2 else "en", None, len(t or ""), "x", "y") for i, t in enumerate(TEXTS)]
    rows += [rows[4], (None, words(50), None, None, None, None, None)]  # a repeated row, a null id
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def rows_of(df):
    return df.collect()


def texts_by_id(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.collect()]


def test_toxicity(spark, docs, none):
    insults = [(100 + i, words(30) + (" idiot " if i % 3 == 0 else " ") + words(10)) for i in range(300)]
    table = spark.createDataFrame(insults, "doc_id long, text string")
    labels = table.select("doc_id", (F.col("doc_id") % 3 == 1).cast("int").alias("toxic"), F.lit(1).alias("text"))
    got = rows_of(toxicity.query(table, labels))
    held = [r for r in got if r["held_out"]]
    assert held and all(r["predicted"] == (r["doc_id"] % 3 == 1) for r in held)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    empty = labels.limit(0)
    assert len(rows_of(toxicity.query(docs, empty))) == len(TEXTS) + 2
    assert toxicity.query(none, empty).count() == 0
    assert toxicity.clean(docs, empty).columns == docs.columns


def test_url_filter(spark):
    urls = [
        None, "", "no scheme", "HTTP://WWW.Site.NET/a", "http://a.example.net/en/1?x=1", "http://example.net/enx",
        "http://example.com/de/1#f", "http://x.org/fr/2", "http://net", "http://notexample.com/de/1", "http://b.net?q/r",
    ] * 3
    pages = spark.createDataFrame(
        [(i, u, "h", "h") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string"
    )
    got = {r["page_id"]: r for r in url_filter.query(pages).collect()}
    assert len(got) == len(urls)
    assert (got[3]["host"], got[3]["path"], got[3]["rule"]) == ("www.site.net", "/a", "net/")
    assert [got[i]["rule"] for i in range(11)] == [
        None, None, None, "net/", "example.net/en/", "net/", "example.com/de/", "org/fr/", None, None, None,
    ]
    assert all(r["verdict"] in ("allow", "block") for r in got.values())
    assert url_filter.query(pages.limit(0)).count() == 0


def test_range_coder():
    r = np.random.RandomState(3)
    for ids in (r.randint(0, 65536, 9000), np.minimum(r.zipf(1.3, 5000), 65535), np.zeros(4096, int), np.arange(1)):
        blocks = range_coder.encode_blocks(ids.astype(np.uint32))
        assert (range_coder.decode_blocks(blocks) == ids).all()
        if len(blocks) > 1:  # blocks are independent
            assert (range_coder.decode_blocks(blocks[1:2]) == ids[4096:8192]).all()
    damaged = bytearray(range_coder.encode_blocks(np.arange(100, dtype=np.uint32))[0])
    damaged[20] ^= 255
    with pytest.raises(ValueError):
        range_coder.decode_blocks([bytes(damaged)])


def test_counted_prior():
    ids = np.minimum(np.random.RandomState(4).zipf(1.3, 9000), 65535)
    prior, blocks = range_coder.encode_counted(ids)
    stored = prior.to_bytes()
    again = range_coder.Prior.from_bytes(stored)
    assert (range_coder.decode_blocks(blocks, again) == ids).all()
    assert (range_coder.decode_blocks(blocks[2:], again) == ids[8192:]).all()
    assert sum(map(len, blocks)) + len(stored) < sum(map(len, range_coder.encode_blocks(ids)))
    assert range_coder.encode_counted(ids[:0])[1] == []
    damaged = bytearray(stored)
    damaged[20] ^= 255
    for call in (
        lambda: range_coder.Prior.from_bytes(bytes(damaged)),
        lambda: range_coder.decode_blocks([blocks[0][:12]], again),  # a block without its words
    ):
        with pytest.raises(ValueError):
            call()


def test_token_files(docs, none):
    library = Tokenizer.from_file(queries.TOKENIZER)
    want, at = [], 0
    for doc, text in sorted(texts_by_id(docs), key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [1], "<u4")
        want.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = [tuple(r) for r in token_files.query(docs, queries.TOKENIZER).orderBy("start").collect()]
    assert got == want
    assert token_files.query(none, queries.TOKENIZER).count() == 0


def test_bpe_is_exact(docs, none):
    library = Tokenizer.from_file(queries.TOKENIZER)
    for r in bpe.query(docs, queries.TOKENIZER, ["doc_id", "text"]).collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
    assert bpe.encode_decode(none, queries.TOKENIZER, ["doc_id", "start"]).count() == 0
    own = bpe.Bpe(open(queries.TOKENIZER, encoding="utf-8").read())
    letters = "aeioutshn'dlrm ΣÅé́İß1２½\x1c 　日🙂ﬁ<|endoftext|>"
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 40)))
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def brute_repeats(texts):
    data = [t.encode() for t in texts]
    seen = {}
    for d in data:
        for i in range(len(d) - 399):
            seen[d[i:i + 400]] = seen.get(d[i:i + 400], 0) + 1
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - 399):
            if seen[d[i:i + 400]] > 1:
                gone[i:i + 400] = True
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~gone])
        yield len(d), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()


def test_repeats(docs, none, monkeypatch):
    table = texts_by_id(docs)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = sorted(((d[0], *r) for d, r in zip(table, brute_repeats([t for _, t in table]))), key=key)
    assert sum(r[2] > 0 for r in want) >= 5
    bytes_of = lambda df: [tuple(r)[:5] for r in df.collect()]
    assert sorted(bytes_of(repeats.query(docs)), key=key) == want
    assert repeats.query(none).count() == 0
    monkeypatch.setattr(repeats, "HOT", 1)  # every hash with two segments is split over buckets
    assert sorted(bytes_of(repeats.query(docs)), key=key) == want


def test_repeats_sees_each_text_once(spark, monkeypatch):
    copied, shared = words(200), words(120)
    texts = [copied] * 50 + [words(20) + " " + copied[100:700] + " " + words(20), words(9) + " " + shared, shared]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    given, inner = [], repeats.repeated

    def spy(found, *args, **kinds):
        given.append(found.groupBy("tkey").count().agg(F.max("count"), F.count("*")).first())
        return inner(found, *args, **kinds)

    monkeypatch.setattr(repeats, "repeated", spy)
    got = sorted(tuple(r)[:5] for r in repeats.query(table).collect())
    assert given == [(1, 4)]
    assert got == [(i, *r) for i, r in enumerate(brute_repeats(texts))]


def test_pipeline_cuts_passages_of_51_words(spark):
    short, wide, fifty = words(51), "é " * 50 + "ende", words(50)
    long_word = "x" + "0123456789abcdef" * 30
    twice = words(53)
    texts = [
        f"{words(30)} 1 {short} 2 {words(9)}", f"{words(5)} 3\n{short.replace(' ', '  ')}\u3000ü {words(40)}",
        f"ß {wide} 4 {words(8)}", f"{words(70)} 5 {wide}", f"{words(4)} 6 {fifty} 7", f"8 {fifty} 9 {words(6)}",
        f"{long_word} {words(3)}", f"{words(3)} {long_word}", twice, twice, words(9), None,
    ]
    assert all(len(t.encode()) < 400 for t in (short, wide, twice))
    rows = [(i, t, "en", None, len(t or ""), "x", "y") for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in corpus_pipeline.cut_repeats(spark, spark.createDataFrame(rows, DOC), "").collect()}
    for i in (0, 1):
        assert " ".join(short.split()) not in " ".join(got[i]["text"].split())
        assert got[i]["text"] == texts[i].replace(short if i == 0 else short.replace(" ", "  "), "")
    assert [got[i]["text"] for i in (2, 3)] == [texts[i].replace(wide, "") for i in (2, 3)]
    assert [got[i]["text"] for i in (4, 5, 10, 11)] == [texts[i] for i in (4, 5, 10, 11)]
    assert all("0123456789abcdef" not in got[i]["text"] for i in (6, 7))
    assert got[8]["text"] == got[9]["text"] == "" and got[8]["n_chars"] == 0


def test_repeated_windows(monkeypatch):
    monkeypatch.setattr(repeats, "LENGTH", 12)
    for turn in range(60):
        letters = b"ab" if turn % 2 else b"abcdefgh"
        base = bytes(rng.choice(letters) for _ in range(60))
        parts = [
            bytes(rng.choice(letters) for _ in range(rng.randint(12, 30))) + base[rng.randint(0, 40):][:rng.randint(0, 40)]
            for _ in range(rng.randint(1, 8))
        ]
        seen = {}
        for p in parts:
            for i in range(len(p) - 11):
                seen[p[i:i + 12]] = seen.get(p[i:i + 12], 0) + 1
        want = [[i for i in range(len(p) - 11) if seen[p[i:i + 12]] > 1] for p in parts]
        assert [x.tolist() for x in repeats.repeated_windows(parts, [1] * len(parts))] == want


PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a href=/>Menu</a></nav>"
    "<aside>side</aside><div class='cookie-notice'>ok?</div><article><h1>Head {n}</h1><p><b>First &amp; {n}<br>line"
    "<p>Second   para.</p><form>Name</form><section class=comments><p>reader</p></section></article><footer>f</footer>"
)


def test_html(spark):
    rows = [(i, "http://h.example/1", PAGE.format(n=i), "x") for i in range(4)]
    rows += [(9, None, None, None), (10, "u", "", None), (11, "http://o.example/", "a < b <p>plain", None), rows[0]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html_templates.query(pages).collect()}
    for i in range(4):
        assert got[i]["text"] == f"Head {i}\n\nFirst & {i} line\n\nSecond para."
    assert got[9]["text"] == got[10]["text"] == "" and got[9]["n_chars"] == 0
    assert got[11]["text"] == "a < b\n\nplain"
    assert html_templates.query(pages).count() == len(rows)
    assert html_templates.query(pages.limit(0)).count() == 0


def html_texts(spark, pages):
    rows = [(i, f"http://{host}/{i}", html, "x") for i, (host, html) in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    return [r["text"] for r in sorted(html_templates.query(table).collect())]


def test_html_state_classes_on_wrappers(spark):
    post = "<{tag}><h2>Head {n}</h2><p>Text of {n}.</p><div class=comments><p>reader</p></div></{tag2}>"
    art = lambda n: post.format(tag="article class=share-enabled", tag2="article", n=n)
    div = lambda n: post.format(tag="div class=entry", tag2="div", n=f"{n} " + "long " * 30)
    shells = [
        '<body class="has-sidebar">{}</body>', '<body><main class="no-sidebar">{}</main></body>',
        '<body><div id="page" class="menu-open">{}<div id=comments><article>reader</article></div></div></body>',
    ]
    pages = [(f"h{k}.example", s.format(art(n))) for k, s in enumerate(shells) for n in range(3)]
    pages += [("d.example", shells[2].replace("<article>", "<p>").format(div(n))) for n in range(3)]
    pages += [("m.example", s.format(art(n))) for n, s in enumerate((shells[0], shells[2], shells[2]))]
    got = html_texts(spark, pages)
    for i in range(9):
        assert got[i] == f"Head {i % 3}\n\nText of {i % 3}."
    for n in range(3):
        assert got[9 + n].startswith(f"Head {n} long") and "reader" not in got[9 + n]
        assert got[12 + n] == f"Head {n}\n\nText of {n}."


def test_html_layouts_optional_parts_and_page_ids(spark):
    shell = "<body><nav><a href=/>Menu</a></nav><div class=crumb>You are here</div>{}<div class=end>Contact us</div></body>"
    art = lambda n, a="": f"<article {a}><h2>Head {n}</h2><p>Text of {n}.</p></article>"
    box = lambda kind, n: f"<div class={kind}><h2>Head {n}</h2><p>Text {n} {'long ' * 60}</p></div>"
    pages = [("lack.example", shell.format(art(n) if n else "<p>Nothing here</p>")) for n in range(4)]
    pages += [("twice.example", shell.format(art(n) + (art("more") if n == 5 else ""))) for n in range(4, 8)]
    pages += [("ids.example", shell.format(art(n, f"id=post-{n} class='post-{n} post'"))) for n in range(8, 11)]
    pages += [("two.example", shell.format(box("post" if n % 2 else "story", n))) for n in range(11, 17)]
    got = html_texts(spark, pages)
    for n in [1, 2, 3, 4, 6, 7, 8, 9, 10]:
        assert got[n] == f"Head {n}\n\nText of {n}."
    assert "Nothing here" in got[0]
    assert got[5] == "Head 5\n\nText of 5.\n\nHead more\n\nText of more."
    for n in range(11, 17):
        assert got[n] == f"Head {n}\n\nText {n} " + " ".join(["long"] * 60)


def test_shards(spark, docs, none):
    got = rows_of(sharding.query(docs))
    assert len(got) == len(TEXTS) + 2
    by_shard = {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    same = [r["shard"] for r in got if r["size"] == len(BASE) + 1 and r["text_crc32"] == zlib.crc32(BASE.encode())]
    assert len(same) == 3 and len(set(same)) == 1
    assert sharding.query(none).count() == 0
    groups = spark.range(3000).select(F.xxhash64("id").alias("hash"), (F.col("id") * 7 % 91 + 1).alias("bytes"))
    cuts, capacity = sharding.cut_points(groups, 7)
    table = sorted((r["hash"], r["bytes"]) for r in groups.collect())
    assert capacity == sharding.smallest_capacity([b for _, b in table], 7)
    totals = {}
    for h, b in table:
        shard = sum(h >= c for c in cuts)
        totals[shard] = totals.get(shard, 0) + b
    assert max(totals.values()) == capacity and set(totals) <= set(range(7))


def test_smallest_capacity():
    for _ in range(200):
        sizes = [rng.randint(1, 9) for _ in range(rng.randint(1, 8))]
        shards = rng.randint(1, 4)

        def best(i, k):
            if k == 1:
                return sum(sizes[i:])
            return min(max(sum(sizes[i:j]), best(j, k - 1)) for j in range(i, len(sizes) + 1))

        assert sharding.smallest_capacity(sizes, shards) == best(0, shards)


def test_near_join(spark, none, monkeypatch):
    base = words(200).split()
    texts = [None, "", "a b", "a b", words(40)]
    for i in range(40):
        own = list(base)
        for _ in range(i % 7):
            own[rng.randrange(200)] = "changed"
        texts.append(" ".join(own))
    table = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, class_id string")
    shingler = near_join.Shingler()
    distinct = sorted({t or "" for t in texts})
    sets = [frozenset(shingler.set_of(t).tolist()) for t in distinct]
    forest, links = near_join.Forest(len(sets)), [0] * len(sets)
    for a in range(len(sets)):
        for b in range(a):
            union = len(sets[a] | sets[b])
            if union and len(sets[a] & sets[b]) / union >= 0.8:
                forest.join(a, b)
                links[a] += 1
                links[b] += 1
    root = {t: forest.root(i) for i, t in enumerate(distinct)}
    lowest = {}
    for i, t in enumerate(texts):
        lowest.setdefault(root[t or ""], i)
    want = {i: (lowest[root[t or ""]], links[distinct.index(t or "")]) for i, t in enumerate(texts)}
    for block in (2048, 8):  # one block, and groups cut into pairs of blocks
        monkeypatch.setattr(near_join, "BLOCK", block)
        got = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in near_join.query(table).collect()}
        assert got == want
    kept = near_join.one_of_each(table.union(table))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(lowest.values()))
    assert near_join.query(none).count() == 0


def test_decontaminate(spark, docs, none):
    item = " ".join(BASE.split()[20:34])
    items = spark.createDataFrame(
        [(1, item, 0), (2, "Short item", 0), (3, None, 0), (None, "zz", 0), (4, item.upper() + "!", 0)],
        "item_id long, text string, n_hit long",
    )
    got = rows_of(decontaminate.find_leaks(docs, items, ["doc_id", "text"]))
    assert len(got) == len(TEXTS) + 2
    hit = [r for r in got if r["text"] and r["text"].startswith(BASE)]
    assert len(hit) == 3
    for r in hit:
        assert r["item_ids"] == ["1", "4"] and r["n_hit"] == 14
        assert [BASE[s["start"]:s["end"]] for s in r["spans"]] == [item]
    split = rows_of(decontaminate.find_leaks(docs, items, ["doc_id", "text"], automaton_bytes=1))
    assert sorted(map(str, split)) == sorted(map(str, got))
    assert decontaminate.query(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontaminate.query(none, items).count() == 0
    assert decontaminate.clean(docs, items).columns == docs.columns


def test_fingerprints(docs, none):
    rows = sorted(texts_by_id(docs), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    want = []
    for i, (doc, text) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        cut = len(text) // 4
        want.append((doc, len(text), hashlib.sha256((text[:len(text) - cut] + after[:cut]).encode()).hexdigest()))
    got = fingerprints.query(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=key) == sorted(want, key=key)
    by_text = {}
    for r in got:
        by_text.setdefault(r["doc_id"], set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert by_text[4] == by_text[5] and len(by_text[4]) == 1
    assert next(r for r in got if r["doc_id"] == 10)["near_edited"] > 0.1
    assert fingerprints.query(none).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    out = corpus_pipeline.run(spark, sf)
    assert 0 < out.count() <= spark.read.parquet(f"{sf}/documents.parquet").count()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_copies", "repeats", "decontamination", "bpe",
    ]
