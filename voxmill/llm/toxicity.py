"""Toxicity scores by weak supervision.

Many voters look at a text: lexicon words, word beginnings and writing patterns. The lexicon starts
from ``SEED_WORDS``; further words and word beginnings are mined from labelled rows by how much
likelier they are in toxic ones. A generative label model treats each voter as a noisy witness of
a hidden class: it estimates by EM how often it fires in either class, and from the residuals how
far voters move together, so that voters that repeat each other share one voice. A linear
classifier is then fitted to the posterior labels, and scores every whole text.

Fitting takes at most ``FIT_ROWS`` labelled rows, chosen by a hash of the id among the rows the
caller allows; scoring covers all rows in one pass without a shuffle. Null and empty texts get the
score of a text on which no voter fires. Without labels the seed words alone speak.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxmill.llm.rows import map_slices
from voxmill.sources.staging import scope, stage

FIT_ROWS = 20_000
MAX_VOTERS = 300
#: Log likelihood ratio from which a mined mark is believed; chance alone rarely gives it, however
#: many words are tried.
MIN_EVIDENCE = 14.0
THRESHOLD = 0.3
BEGINNINGS = (4, 5, 6)

#: Insults to start from.
SEED_WORDS = (
    "idiot", "moron", "stupid", "loser", "trash", "scum", "pathetic", "worthless", "disgusting",
    "clown", "imbecile", "dumb", "ugly", "garbage", "vermin", "filth", "freak", "creep", "jerk",
    "retard", "bastard", "bitch", "fool", "coward", "liar", "hate", "kill", "die",
    "dummkopf", "abschaum", "arschloch", "idiota", "imbécil", "basura", "connard", "ordure",
)
PATTERNS = {
    "shouting": re.compile(r"(?:\b[A-ZÀ-Þ]{3,}\b[^\w]*){4}"),
    "exclaiming": re.compile(r"!{3,}"),
    "address": re.compile(r"\b(?:you|your|du|tu|eres)\b.{0,40}\b(?:" + "|".join(SEED_WORDS[:24]) + r")\b", re.I | re.S),
}
_WORD = re.compile(r"[^\W\d_]+")


def marks_of(text: str) -> set[str]:
    """What mined voters can look for: ``w:word`` and ``b:beginning``."""
    words = set(_WORD.findall(text.lower()))
    marks = {f"w:{w}" for w in words}
    for n in BEGINNINGS:
        marks.update(f"b:{w[:n]}" for w in words if len(w) > n)
    return marks


@dataclass
class Model:
    voters: list[str]
    weights: np.ndarray  # one per voter, then "number of voters that fired", then the bias
    words: dict[str, int] = field(default_factory=dict)
    beginnings: dict[int, dict[str, int]] = field(default_factory=dict)
    patterns: list[tuple[int, re.Pattern]] = field(default_factory=list)

    def __post_init__(self):
        self.beginnings = {n: {} for n in BEGINNINGS}
        for i, name in enumerate(self.voters):
            kind, _, value = name.partition(":")
            if kind == "w":
                self.words[value] = i
            elif kind == "b":
                self.beginnings[len(value)][value] = i
            else:
                self.patterns.append((i, PATTERNS[value]))

    def fired(self, text: str | None) -> list[int]:
        text = text or ""
        words = set(_WORD.findall(text.lower()))
        found = [self.words[w] for w in words & self.words.keys()]
        for n, known in self.beginnings.items():
            if known:
                found += [known[b] for b in {w[:n] for w in words if len(w) > n} & known.keys()]
        return sorted(found + [i for i, p in self.patterns if p.search(text)])

    def score(self, found: list[int]) -> float:
        """From the voters that fired."""
        z = self.weights[-1] + self.weights[-2] * math.log1p(len(found))
        if found:
            z += float(self.weights[found].sum())
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def label_model(votes: np.ndarray, said: np.ndarray, rounds: int = 20) -> np.ndarray:
    """Posterior probability of the toxic class per row.

    ``votes``: rows x voters, 0 or 1. ``said``: the label voter, 1, 0 or nan where it abstains.
    """
    votes = votes.astype(np.float64)
    gold = ~np.isnan(said)
    spoken = np.where(gold, said, 0.0)
    if gold.any():
        p = np.where(gold, np.where(spoken == 1, 0.9, 0.1), 0.2)
    else:
        p = np.where(votes.any(axis=1), 0.8, 0.1)
    for _ in range(rounds):
        toxic, clean = p.sum() + 1e-9, (1 - p).sum() + 1e-9
        prior = (toxic + 1) / (toxic + clean + 2)
        hit = np.clip((p @ votes + 0.5) / (toxic + 1), 1e-6, 1 - 1e-6)
        false = np.clip(((1 - p) @ votes + 0.05) / (clean + 1), 1e-6, 1 - 1e-6)
        # Correlation of what the hidden class leaves unexplained.
        rest = votes - (np.outer(p, hit) + np.outer(1 - p, false))
        size = np.sqrt((rest**2).sum(axis=0)) + 1e-9
        together = np.clip((rest.T @ rest) / np.outer(size, size), 0, 1)
        voice = 1.0 / np.where(together > 0.15, together, 0).sum(axis=1).clip(1)
        z = math.log(prior / (1 - prior)) + votes @ (voice * np.log(hit / false))
        z += (1 - votes) @ (voice * np.log((1 - hit) / (1 - false)))
        if gold.any():
            right = np.clip((p[gold] @ spoken[gold] + 9) / (p[gold].sum() + 10), 0.5, 0.99)
            wrong = np.clip(((1 - p)[gold] @ spoken[gold] + 1) / ((1 - p)[gold].sum() + 10), 0.01, 0.5)
            z += np.where(gold, np.where(
                spoken == 1, math.log(right / wrong), math.log((1 - right) / (1 - wrong))
            ), 0.0)
        p = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))
    return p


def linear_fit(votes: np.ndarray, target: np.ndarray, ridge: float = 0.3, rounds: int = 12) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the bias is not penalised."""
    x = np.hstack([votes, np.log1p(votes.sum(axis=1, keepdims=True)), np.ones((len(votes), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        q = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (q - target) + penalty * w
        bend = (x * (q * (1 - q) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        w -= np.linalg.solve(bend, slope)
    return w


def fit(docs: DataFrame, labelled: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """``labelled``: doc_id, toxic, only rows that may be learnt from."""
    wanted = (
        labelled.where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("_toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    # An id may stand on many rows: one row for each id and text, and no more than the bound in all.
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("_key"))
    pairs = (
        rows.select("doc_id", "_key").join(F.broadcast(wanted), "doc_id")
        .groupBy("doc_id", "_key", "_toxic").agg(F.count("*").alias("_n"))
        .orderBy("_key", "doc_id").limit(fit_rows)
    )
    found = rows.join(F.broadcast(pairs), ["doc_id", "_key"])
    once = found.where("_n = 1").select("text", "_toxic")
    several = found.where("_n > 1").groupBy("doc_id", "_key", "_toxic").agg(F.max("text").alias("text"))
    sample = stage(once.union(several.select("text", "_toxic")), "toxicity-sample")

    def count(texts, toxic):
        counts = {0: Counter(), 1: Counter()}
        for text, label in zip(texts, toxic):
            counts[label].update(marks_of(text or ""))
        for mark in counts[1]:
            yield mark, counts[1][mark], 0
        for mark in counts[0]:
            yield mark, 0, counts[0][mark]

    schema = T.StructType([
        T.StructField("mark", T.StringType()), T.StructField("toxic", T.LongType()),
        T.StructField("clean", T.LongType()),
    ])
    totals = {r["_toxic"]: r["count"] for r in sample.groupBy("_toxic").count().collect()}
    n_toxic, n_clean = totals.get(1, 0), totals.get(0, 0)
    seeds = [f"w:{w}" for w in SEED_WORDS]
    mined: list[str] = []
    if n_toxic and n_clean:
        rate = F.log(
            ((F.col("toxic") + 0.5) / (n_toxic + 1)) / ((F.col("clean") + 0.5) / (n_clean + 1))
        )
        marks = map_slices(sample, schema, count, rows=4096).groupBy("mark").agg(
            F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
        )
        base = n_toxic / (n_toxic + n_clean)
        share = F.col("toxic") / (F.col("toxic") + F.col("clean"))
        evidence = F.col("toxic") * F.log(share / base) + F.when(
            F.col("clean") > 0, F.col("clean") * F.log((1 - share) / (1 - base))
        ).otherwise(0.0)
        chosen = (
            marks.where((evidence >= MIN_EVIDENCE) & (F.col("toxic") > F.col("clean")))
            .withColumn("worth", rate * F.sqrt("toxic"))
            .orderBy(F.desc("worth"), "mark").limit(MAX_VOTERS)
        )
        mined = [r["mark"] for r in chosen.collect()]
    voters = list(dict.fromkeys([*mined, *seeds, *(f"p:{p}" for p in PATTERNS)]))
    probe = Model(voters, np.zeros(len(voters) + 2))

    def vote(texts, toxic):
        yield from ((probe.fired(t), y) for t, y in zip(texts, toxic))

    out = T.StructType([
        T.StructField("fired", T.ArrayType(T.IntegerType())), T.StructField("said", T.IntegerType()),
    ])
    rows = map_slices(sample, out, vote).collect()  # at most about fit_rows short rows
    votes = np.zeros((len(rows) + 1, len(voters)), np.float32)
    said = np.full(len(rows) + 1, np.nan)
    for i, row in enumerate(rows):
        votes[i, row["fired"]] = 1
        said[i] = row["said"]
    if not (n_toxic and n_clean):  # nothing to learn from: each seed word speaks alike
        weights = np.zeros(len(voters) + 2)
        weights[[voters.index(s) for s in seeds]] = 4.0
        weights[-1] = -3.0
        return Model(voters, weights)
    return Model(voters, linear_fit(votes[:-1], label_model(votes[:-1], said[:-1])))


def score(
    docs: DataFrame, model: Model, keep: list[str], text: str = "text", names: bool = True
) -> DataFrame:
    """Columns ``keep`` plus ``score`` and ``fired``: the names of the voters that fired, null without ``names``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(*columns):
        own = shared.value
        for *left, value in zip(*columns):
            found = own.fired(value)
            yield (*left, own.score(found), [own.voters[i] for i in found] if names else None)

    inner = [T.StructField(f"_{i}", docs.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType([
        *inner, T.StructField("score", T.DoubleType()),
        T.StructField("fired", T.ArrayType(T.StringType())),
    ])
    picked = docs.select(
        *(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), F.col(text).alias("_text")
    )
    out = map_slices(picked, schema, work)
    return out.select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), "score", "fired")


def _held_out():
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    with scope(docs.sparkSession):
        return fit(docs, labels.select("doc_id", "toxic").where(~_held_out()))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, trained(docs, labels), ["doc_id"], names=False)
    return scored.select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""
    scored = score(docs, trained(docs, labels), docs.columns, names=False)
    return scored.where(F.col("score") < THRESHOLD).select(docs.columns)
