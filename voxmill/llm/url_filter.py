"""URL verdicts: rules where one fits, gradient-boosted trees on lexical features elsewhere.

The trees learn from labelled URLs. In the query these are the URLs that a rule decides, as the
given tables hold no other labels. Features: lengths, depth, digit ratios, character entropy, counts of
parameters, hyphens and labels, and statistics of the host's last label over all rows. Fitting
takes at most ``train_rows`` labelled URLs, chosen by hash; everything else covers all rows.

A null URL or one without ``://`` has an empty host and path; no rule fits, the trees decide. With
no labelled URLs, or labels of one kind only, URLs without a rule get that kind, or ``allow``.
Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.sources.staging import stage

TRAIN_ROWS = 20_000
TREES, DEPTH = 12, 4
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = [
    "length", "host_length", "path_length", "depth", "labels", "digit_ratio", "host_digit_ratio",
    "hyphens", "parameters", "has_fragment", "entropy", "host_entropy", "suffix_log_rows",
    "suffix_block_rate",
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(
        F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))
    ).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest fitting rule. ``rules``: (verdict, ``host/path``) pairs.

    The list is part of the plan: meant for hand-written rules, up to a few hundred.
    """
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.translate(text, pattern, ""))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.nullif(whole, F.lit(0)), F.lit(0.0))


def _entropy(text: Column) -> Column:
    letters = F.split(text, "")
    share = lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / F.length(text)
    each = F.filter(F.array_distinct(letters), lambda c: c != "")
    return F.coalesce(
        F.aggregate(each, F.lit(0.0), lambda a, c: a - share(c) * F.log2(share(c))), F.lit(0.0)
    )


def _with_features(rows: DataFrame) -> DataFrame:
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return rows.select(
        "*",
        F.length(url).cast("double").alias("length"),
        F.length(host).cast("double").alias("host_length"),
        F.length(path).cast("double").alias("path_length"),
        _count(path, "/").cast("double").alias("depth"),
        _count(host, ".").cast("double").alias("labels"),
        _ratio(_count(url, "0123456789"), F.length(url)).alias("digit_ratio"),
        _ratio(_count(host, "0123456789"), F.length(host)).alias("host_digit_ratio"),
        _count(host, "-").cast("double").alias("hyphens"),
        F.when(query == "", 0.0).otherwise(_count(query, "&") + 1.0).alias("parameters"),
        F.contains(url, F.lit("#")).cast("double").alias("has_fragment"),
        _entropy(url).alias("entropy"),
        _entropy(host).alias("host_entropy"),
        F.substring_index(host, ".", -1).alias("suffix"),
    )


def judge(
    pages: DataFrame, rules: list[tuple[str, str]], keep: list[str], url: str = "url",
    labelled: DataFrame | None = None, train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """Columns ``keep`` plus ``host, path, rule, verdict``.

    ``labelled``: url, verdict (``allow`` or ``block``); if None, what the rules say of ``pages``.
    """
    value = F.coalesce(F.col(url), F.lit(""))
    kept = [f"_{i}" for i in range(len(keep))]
    rows = pages.select(*(F.col(c).alias(k) for k, c in zip(kept, keep)), value.alias("url"))
    rows = stage(_judged_by_rules(rows, rules), "url-rows")
    if labelled is None:
        known = rows.where("verdict IS NOT NULL")
    else:
        known = labelled.select(F.coalesce("url", F.lit("")).alias("url"), F.col("verdict"))
        known = _judged_by_rules(known.withColumnRenamed("verdict", "_said"), []).withColumn(
            "verdict", F.col("_said")
        )
    known = known.where(F.col("verdict").isin("allow", "block")).select("url", "host", "path", "verdict")
    suffix = F.substring_index("host", ".", -1).alias("suffix")
    # Rows and labelled rows per suffix: summed in each task first, so a common suffix is no load.
    seen = rows.groupBy(suffix).agg(F.count("*").alias("rows"))
    said = known.groupBy(suffix).agg(
        F.count("*").alias("said"), F.count_if(F.col("verdict") == "block").alias("blocked")
    )
    rate = (F.coalesce("blocked", F.lit(0)) + 1.0) / (F.coalesce("said", F.lit(0)) + 2.0)
    suffixes = stage(
        seen.join(said, "suffix", "left").select(
            "suffix", F.log1p("rows").alias("suffix_log_rows"), rate.alias("suffix_block_rate")
        ),
        "url-suffixes",
    )
    sample = known.orderBy(F.xxhash64("url"), "url").limit(train_rows)
    train = _assembled(_with_features(sample), suffixes).select(
        "features", (F.col("verdict") == "block").cast("double").alias("label")
    )
    train = stage(train.coalesce(2), "url-train")
    kinds = {r[0] for r in train.select("label").distinct().collect()}
    out = ["host", "path", "rule"]
    named = [F.col(k).alias(c) for k, c in zip(kept, keep)]
    if len(kinds) < 2:
        other = "block" if kinds == {1.0} else "allow"
        return rows.select(*named, *out, F.coalesce("verdict", F.lit(other)).alias("verdict"))
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=7).fit(train)
    scored = model.transform(_assembled(_with_features(rows), suffixes))
    by_trees = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return scored.select(*named, *out, F.coalesce("verdict", by_trees).alias("verdict"))


def _judged_by_rules(rows: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    host, path = host_and_path(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path})
    rule, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    return rows.withColumns({"rule": rule, "verdict": verdict})


def _assembled(rows: DataFrame, suffixes: DataFrame) -> DataFrame:
    joined = rows.join(suffixes, "suffix", "left").fillna(
        {"suffix_log_rows": 0.0, "suffix_block_rate": 0.5}
    )
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(joined)


#: The rules of the query.
RULES = [
    ("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"),
]


def query(pages: DataFrame) -> DataFrame:
    return judge(pages, RULES, ["page_id"])
