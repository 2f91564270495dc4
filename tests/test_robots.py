"""Robots rules by search in sorted heads, against trying every rule."""

import random
import re

import pytest

from voxmill.functions.urls import robots_regex
from voxmill.operators import robots

RULES = "host string, agent string, allow boolean, path_pattern string"


def by_trying(rules, agent, host, path):
    own = [r for r in rules if r[0].lower() == host]
    group = [r for r in own if r[1] == agent] or [r for r in own if r[1] == "*"]
    best = (-1, True)
    for _, _, allow, pattern in group:
        if pattern and re.search(robots_regex(pattern), path):
            best = max(best, (len(pattern), allow))
    return best[1]


def random_rules(rng, host, agent, n):
    def pattern():
        text = "/" + "".join(rng.choice("ab/é.?") for _ in range(rng.randint(0, 5)))
        if rng.random() < 0.4:
            at = rng.randint(0, len(text))
            text = text[:at] + "*" + text[at:]
        return text + rng.choice(["", "", "", "$", "*"])
    return [(host, agent, rng.random() < 0.5, pattern()) for _ in range(n)]


@pytest.mark.parametrize("limit", [robots.BROADCAST_BYTES, -1])
def test_search_against_every_rule(spark, monkeypatch, limit):
    monkeypatch.setattr(robots, "BROADCAST_BYTES", limit)
    rng = random.Random(7)
    rules = random_rules(rng, "A.example", "*", 40) + random_rules(rng, "b.example", "*", 3)
    rules += random_rules(rng, "b.example", "bot", 25) + random_rules(rng, "d.example", "other", 5)
    rules += [("e.example", "bot", False, ""), ("e.example", "*", False, "/")] + rules[:3]
    rules += [("f.example", "*", False, "/a$b"), ("f.example", "*", True, "/a")]
    urls = []
    for i in range(1500):
        host = rng.choice(["a.example", "B.example", "c.example", "d.example", "e.example", "f.example"])
        urls.append((i, f"https://{host}/" + "".join(rng.choice("ab/é.?$") for _ in range(rng.randint(0, 8)))))
    frame = spark.createDataFrame(urls + [(9000, None), (9001, ""), urls[0]], "id long, url string")
    index = robots.rule_index(spark.createDataFrame(rules, RULES), "Bot/1.0")
    got = robots.judged(frame, index).collect()
    assert len(got) == len(urls) + 3
    for row in got:
        if row.id >= 9000:
            assert row.robots_allowed
            continue
        host, rest = re.match(r"https://([^/]*)(.*)", row.url).groups()
        assert row.robots_allowed == by_trying(rules, "bot", host.lower(), rest), row


def test_no_rules_and_no_links(spark):
    none = spark.createDataFrame([], RULES)
    links = spark.createDataFrame([("http://a.example/x",)], "url string")
    index = robots.rule_index(none, "bot")
    assert [r.robots_allowed for r in robots.judged(links, index).collect()] == [True]
    assert robots.judged(links.limit(0), index).count() == 0


def test_clashing_column_names(spark):
    rules = spark.createDataFrame([("a.example", "*", False, "/")], RULES)
    links = spark.createDataFrame([("http://a.example/x", "h", "k")], "url string, host string, heads string")
    row = robots.judged(links, robots.rule_index(rules, "bot")).first()
    assert (row.host, row.heads, row.robots_allowed) == ("h", "k", False)


def test_long_rules_and_long_paths(spark):
    rules = [("a.example", "*", i % 2 == 0, "/" + "x" * i) for i in range(0, 300)]
    urls = [(f"http://a.example/{'x' * n}{tail}",) for n in (0, 1, 7, 299, 5000) for tail in ("", "y")]
    index = robots.rule_index(spark.createDataFrame(rules, RULES), "bot")
    for row in robots.judged(spark.createDataFrame(urls, "url string"), index).collect():
        assert row.robots_allowed == (min(row.url.count("x") - 1, 299) % 2 == 0)
