"""Robots rules of many hosts: a sorted list of literal heads per host, searched instead of tried in turn.

A rule's head is its literal text before the first wildcard. A head that begins a path is not above it in
byte order, and everything between such a head and the path begins with the head too. So one binary search
gives the last head not above the path, and every head that begins the path begins that head as well. Each
head carries the rules of all heads that begin it, longest pattern first: the first that fits decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.functions.once import once
from voxmill.sources.staging import stage

BROADCAST_BYTES = 64 * 1024 * 1024
#: Parts into which each host's links are spread when the rules are too large for a broadcast.
SALTS = 16

_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _AUTHORITY + r"([^/?#]*)", 1))


def target_of(url: Column) -> Column:
    """Path and query, which the rules are about; they begin with a slash."""
    rest = F.regexp_replace(url, _AUTHORITY + r"[^/?#]*|#.*$", "")
    return F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))


def _regex(pattern: Column) -> Column:
    """``*`` stands for any run of characters, a final ``$`` for the end of the path."""
    escaped = F.regexp_replace(pattern, r"([\\.\[\]{}()+?^|$])", r"\\$1")
    return F.concat(
        F.lit("^"), F.regexp_replace(F.replace(escaped, F.lit("*"), F.lit(".*")), r"\\\$$", r"\$")
    )


def agent_rules(rules: DataFrame, agent: str) -> DataFrame:
    """(host, allow, pattern): per host the rules for ``agent``, or those for ``*`` if it has none."""
    token = agent.lower().split("/")[0].strip()
    named = rules.where(F.col("host").isNotNull() & F.col("agent").isin(token, "*")).select(
        F.lower("host").alias("host"), (F.col("agent") == token).alias("_named"), "allow",
        F.col("path_pattern").alias("pattern"),
    )
    best = named.groupBy("host").agg(F.max("_named").alias("_named"))
    # An empty pattern fits nothing, but it does name the agent.
    return named.join(best, ["host", "_named"]).where("pattern <> ''").select("host", "allow", "pattern").distinct()


def rule_index(rules: DataFrame, agent: str) -> DataFrame:
    """(host, bytes, heads): one written row per host. ``rules``: host, agent, allow, path_pattern.

    A host's rules come from one robots file, so they fit a row. Equal heads are one; rules given twice
    count once.
    """
    pattern = F.col("pattern")
    literal = F.regexp_extract(pattern, r"^[^*]*", 0)
    ends = pattern.endswith("$") & ~F.contains(pattern, F.lit("*"))
    plain = F.regexp_like(pattern, F.lit(r"^[^*]*\**$")) & ~ends
    own = agent_rules(rules, agent).select(
        "host",
        F.when(ends, F.expr("left(pattern, length(pattern) - 1)")).otherwise(literal).alias("head"),
        F.struct(
            (-F.length(pattern)).alias("order"), (~F.col("allow")).alias("deny"),
            F.when(~plain, _regex(pattern)).alias("regex"),
        ).alias("rule"),
    )
    per_head = own.groupBy("host", "head").agg(F.collect_list("rule").alias("rules"))
    begins = per_head.select("host", "head", F.explode(F.sequence(F.lit(0), F.length("head"))).alias("n")).select(
        "host", "head", F.expr("left(head, n)").alias("begin")
    )
    above = per_head.select("host", F.col("head").alias("begin"), F.explode("rules").alias("rule")).select(
        "host", "begin", F.struct("rule.order", "rule.deny", "begin", "rule.regex").alias("rule")
    )
    chains = begins.join(above, ["host", "begin"]).groupBy("host", "head").agg(
        F.array_sort(F.collect_list("rule")).alias("rules")
    )
    size = F.octet_length("head") + F.aggregate(
        "rules", F.lit(0),
        lambda n, r: n + F.octet_length(r["begin"]) + F.coalesce(F.octet_length(r["regex"]), F.lit(0)) + 48,
    )
    index = chains.withColumn("_size", size).groupBy("host").agg(
        F.sum("_size").alias("bytes"), F.array_sort(F.collect_list(F.struct("head", "rules"))).alias("heads")
    )
    return stage(index, "robots")


def _verdict(heads: Column, target: Column) -> Column:
    """Whether the first fitting rule allows; null without one."""
    steps = F.ceil(F.log2(F.size(heads) + 1)).cast("int") + 1

    def halve(at: Column, _: Column) -> Column:
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        below = F.get(heads, mid)["head"] <= target
        return F.when(at["lo"] >= at["hi"], at).when(
            below, F.struct((mid + 1).alias("lo"), at["hi"].alias("hi"))
        ).otherwise(F.struct(at["lo"].alias("lo"), mid.alias("hi")))

    span = F.struct(F.lit(0).alias("lo"), F.size(heads).alias("hi"))
    last = F.aggregate(F.sequence(F.lit(1), steps), span, halve, lambda at: at["lo"] - 1)
    found = F.get(heads, last)
    fits = F.filter(found["rules"], lambda r: target.startswith(r["begin"]) & (
        r["regex"].isNull() | F.regexp_like(target, r["regex"])))
    return ~F.get(fits, F.lit(0))["deny"]


def judged(links: DataFrame, index: DataFrame, url: str = "url") -> DataFrame:
    """``links`` with ``robots_allowed``. No rule, no file or no URL: allowed.

    Rules go to every executor while all of them take no more than ``BROADCAST_BYTES``; beyond, each host's
    links are spread over ``SALTS`` tasks.
    """
    total = index.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    rules = index.select(F.col("host").alias("_host"), F.col("heads").alias("_heads"))
    placed = links.withColumns({"_host": host_of(F.col(url)), "_target": once(target_of(F.col(url)))})
    keys = ["_host"]
    if total <= BROADCAST_BYTES:
        rules = F.broadcast(rules)
    else:
        keys.append("_salt")
        rules = rules.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        placed = placed.withColumn("_salt", F.pmod(F.xxhash64(url), F.lit(SALTS)).cast("int"))
    allowed = F.coalesce(_verdict(F.col("_heads"), F.col("_target")), F.lit(True))
    return placed.join(rules, keys, "left").select(
        *[links[c] for c in links.columns if c != "robots_allowed"], allowed.alias("robots_allowed")
    )
