"""Issue classifier: TF-IDF and logistic regression with a rule fallback for small data."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from voxmill import lexicons as lx
from voxmill.functions import labels as lb
from voxmill.operators import tfidf
from voxmill.operators.evaluation import class_scores
from voxmill.sources.staging import stage

MIN_RECORDS = 30
SPLIT_BUCKETS = 65_536
FALLBACK_CONFIDENCE = 0.55


def with_primary_label(records: DataFrame) -> DataFrame:
    return records.withColumn("label", lb.primary_label(F.col("issue_labels")))


def class_counts(records: DataFrame) -> DataFrame:
    """(label, records), labels in order."""
    return (
        with_primary_label(records)
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("records"))
        .orderBy("label")
    )


def model_gate(records: DataFrame) -> DataFrame:
    """One row: classes, records, smallest class, and whether a model can be trained."""
    return (
        class_counts(records)
        .agg(
            F.count(F.lit(1)).alias("classes"),
            F.coalesce(F.sum("records"), F.lit(0)).alias("records"),
            F.coalesce(F.min("records"), F.lit(0)).alias("smallest_class"),
        )
        .withColumn("trainable", (F.col("classes") >= 2) & (F.col("records") >= MIN_RECORDS)
                    & (F.col("smallest_class") >= 2))
    )


def fallback_predict(records: DataFrame) -> DataFrame:
    label = lb.primary_label(F.col("issue_labels"))
    return records.withColumns({
        "ai_predicted_issue": label,
        "ai_confidence": F.lit(FALLBACK_CONFIDENCE),
        "ai_root_cause_suggestion": lb.label_suggestion(label),
    })


def test_quota(counts: dict[str, int], percent: int = 20) -> dict[str, int]:
    """Test rows per class: the rounded-down share, topped up by largest remainder."""
    total = math.ceil(sum(counts.values()) * percent / 100)
    quota = {label: n * percent // 100 for label, n in counts.items()}
    by_remainder = sorted(counts, key=lambda c: (-(counts[c] * percent % 100), c))
    for label in by_remainder[: total - sum(quota.values())]:
        quota[label] += 1
    return quota


def stratified_split(
    labelled: DataFrame, counts: dict[str, int], percent: int = 20, seed: int = 42
) -> DataFrame:
    """Add ``is_test``: exactly the quota of each class, drawn by a hash of ``seq``.

    A class may hold most of the rows, so it is not ranked in one piece. Hashes fall into buckets;
    bucket counts tell which buckets are test as a whole, and only the one bucket per class in
    which the quota ends is ranked row by row. The draw does not depend on partitioning.
    """
    spark = labelled.sparkSession
    quotas = spark.createDataFrame(list(test_quota(counts, percent).items()), "label string, _quota long")
    hashed = labelled.withColumn("_hash", F.xxhash64("seq", F.lit(seed))).withColumn(
        "_bucket", F.pmod("_hash", F.lit(SPLIT_BUCKETS))
    )
    # At most classes x SPLIT_BUCKETS rows.
    sizes = hashed.groupBy("label", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(W.partitionBy("label").orderBy("_bucket"))
    quota = F.coalesce("_quota", F.lit(0))
    cut = (
        sizes.withColumn("_upto", upto).join(F.broadcast(quotas), "label", "left")
        .withColumn("_room", quota - (F.col("_upto") - F.col("_n")))
        .where((F.col("_room") > 0) & (F.col("_room") <= F.col("_n")))
        # One row per class: the bucket where the quota ends and how many of its rows are test.
        .select("label", F.col("_bucket").alias("_cut"), "_room")
    )
    placed = hashed.join(F.broadcast(cut), "label", "left")
    last = placed.where("_bucket = _cut")
    rank = F.row_number().over(W.partitionBy("label").orderBy("_hash", "seq"))
    last = last.withColumn("is_test", rank <= F.col("_room"))
    rest = placed.where("_cut is null or _bucket <> _cut").withColumn(
        "is_test", F.coalesce(F.col("_bucket") < F.col("_cut"), F.lit(False))
    )
    return rest.unionByName(last).drop("_hash", "_bucket", "_cut", "_room")


@dataclass(frozen=True)
class IssueClassifier:
    features: tfidf.TfidfModel
    regression: LogisticRegressionModel
    labels: tuple[str, ...]


def fit_classifier(
    train: DataFrame, labels: Sequence[str], max_iter: int = 600, c: float = 1.0
) -> IssueClassifier:
    """Fit on (seq, text, label), or on a staged token table with labels.

    Classes weigh the same; regularisation is 1 / (c * rows).
    """
    if "_tokens" not in train.columns:
        train = stage(tfidf.tokenized(train), "train-tokens")
    model = tfidf.fit(train)
    per_class = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    n = sum(per_class.values())
    share = {k: n / (len(per_class) * count) for k, count in per_class.items()}
    # One row per class, like ``labels`` and the model's coefficients, which the driver holds too.
    classes = train.sparkSession.createDataFrame(
        [(label, float(i), share.get(label, 1.0)) for i, label in enumerate(labels)],
        "label string, _index double, _weight double",
    )
    weighed = tfidf.weigh_by_number(train, model, "features").join(F.broadcast(classes), "label", "left")
    ready = stage(
        weighed.select(
            "features", F.coalesce("_index", F.lit(0.0)).alias("_index"),
            F.coalesce("_weight", F.lit(1.0)).alias("_weight"),
        ),
        "training",
    )
    regression = LogisticRegression(
        featuresCol="features", labelCol="_index", weightCol="_weight", family="auto",
        maxIter=max_iter, tol=1e-7, regParam=1.0 / (c * n), elasticNetParam=0.0,
        standardization=False, probabilityCol="_probability", predictionCol="_prediction",
        rawPredictionCol="_raw",
    ).fit(ready)
    return IssueClassifier(model, regression, tuple(labels))


def predict(docs: DataFrame, classifier: IssueClassifier) -> DataFrame:
    """(seq, text) or a token table, with ``ai_predicted_issue`` and ``ai_confidence``."""
    rows = tfidf.weigh_by_number(docs, classifier.features, "features")
    scored = classifier.regression.transform(rows)
    names = F.array(*[F.lit(label) for label in classifier.labels])
    return scored.withColumns({
        "ai_predicted_issue": F.get(names, F.col("_prediction").cast("int")),
        "ai_confidence": F.round(F.array_max(vector_to_array("_probability")), 4),
    }).drop("features", "_raw", "_probability", "_prediction")


def predict_all(records: DataFrame, classifier: IssueClassifier) -> DataFrame:
    """Label and highest probability for every record, training rows included; a token table stays as it is."""
    docs = records if "_tokens" in records.columns else records.withColumn("text", tfidf.corpus_text())
    predicted = predict(docs, classifier)
    return predicted.withColumn(
        "ai_root_cause_suggestion", lb.label_suggestion(F.col("ai_predicted_issue"))
    )


@dataclass(frozen=True)
class ModelTables:
    """A classifier as two tables, which a join and a sum can score with.

    ``terms`` is (term, idf, coefficients), at most ``max_features`` rows, the coefficients in the order
    of ``labels``; ``labels`` is (position, label, intercept).
    """

    terms: DataFrame
    labels: DataFrame


def model_tables(classifier: IssueClassifier) -> ModelTables:
    regression = classifier.regression
    by_label = regression.coefficientMatrix.toArray()
    intercepts = list(regression.interceptVector)
    if regression.numClasses == 2 and len(by_label) == 1:
        # Two classes have one row of coefficients, that of the second class against the first.
        by_label = [[0.0] * by_label.shape[1], by_label[0]]
        intercepts = [0.0, intercepts[0]]
    spark = classifier.features.vocabulary.sparkSession
    columns = [list(c) for c in zip(*by_label)]
    coefficients = spark.createDataFrame(pa.table({
        "index": pa.array(range(len(columns)), pa.int32()),
        "coefficients": pa.array(columns, pa.list_(pa.float64())),
    }))
    terms = classifier.features.vocabulary.join(coefficients, "index")
    labels = [(i, label, float(b)) for i, (label, b) in enumerate(zip(classifier.labels, intercepts))]
    return ModelTables(
        terms.select("term", "idf", "coefficients"),
        spark.createDataFrame(labels, "position int, label string, intercept double"),
    )


def save_model(tables: ModelTables, path: str) -> str:
    tables.terms.write.parquet(f"{path}/terms")
    tables.labels.coalesce(1).write.parquet(f"{path}/labels")
    return path


def open_model(spark: SparkSession, path: str) -> ModelTables:
    return ModelTables(spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/labels"))


def score_by_tables(
    docs: DataFrame, tables: ModelTables, stopwords: Sequence[str] | None = None
) -> DataFrame:
    """(seq, ai_predicted_issue, ai_confidence, probabilities) from joins and sums alone.

    ``docs`` is (seq, text) or a token table; ``seq`` is unique. A document is counted in the workers, by the
    number of a vocabulary term, and is one row of the shuffle; one without any term keeps a row and gets the
    intercepts' label. Equal probabilities: the first label. An empty text is such a document.
    """
    labels = tables.labels.orderBy("position").collect()  # one row per class
    # At most max_features terms, whose bytes are checked when the model is fitted. Occurrences go by number.
    numbered = tables.terms.where("term is not null").withColumn("_place", F.dense_rank().over(W.orderBy("term")) - 1)
    terms = [r.term for r in numbered.select("term", "_place").distinct().orderBy("_place").collect()]
    counted = tfidf.term_counts(docs, terms, lx.default_stopwords() if stopwords is None else stopwords)
    known = counted.repartition("seq").select(
        "seq", F.inline_outer(F.arrays_zip(F.col("place").alias("_place"), F.col("n").alias("_n")))
    )
    cells = known.groupBy("seq", "_place").agg(F.sum("_n").alias("_n")).join(
        F.broadcast(numbered.select("_place", "idf", "coefficients")), "_place", "left"
    ).withColumn("_x", F.coalesce("_n", F.lit(0)) * F.coalesce("idf", F.lit(0.0)))
    zero = F.lit(0.0)
    sums = cells.groupBy("seq").agg(
        F.sqrt(F.sum(F.col("_x") * F.col("_x"))).alias("_norm"),
        *[F.sum(F.coalesce(F.col("_x") * F.get("coefficients", F.lit(r.position)), zero)).alias(f"_s{r.position}")
          for r in labels],
    )
    margins = F.array(*[
        F.lit(r.intercept) + F.when(F.col("_norm") > 0, F.col(f"_s{r.position}") / F.col("_norm")).otherwise(0.0)
        for r in labels
    ])
    # Shifted by the largest margin, so that no power overflows.
    powers = F.transform("_margins", lambda m: F.exp(m - F.array_max("_margins")))
    total = F.aggregate("_powers", zero, lambda a, p: a + p)
    names = F.array(*[F.lit(r.label) for r in labels])
    best = F.array_position("_margins", F.array_max("_margins")).cast("int") - 1
    return (
        sums.select("seq", margins.alias("_margins"))
        .withColumn("_powers", powers)
        .withColumn("probabilities", F.transform("_powers", lambda p: p / total))
        .select("seq", F.get(names, best).alias("ai_predicted_issue"),
                F.round(F.array_max("probabilities"), 4).alias("ai_confidence"), "probabilities")
    )


def holdout_metrics(predicted: DataFrame) -> DataFrame:
    """Sizes, accuracy, macro and weighted F1 from (label, ai_predicted_issue, is_test)."""
    sizes = predicted.agg(
        F.count_if(~F.col("is_test")).alias("train_size"),
        F.count_if("is_test").alias("test_size"),
        F.round(F.coalesce(F.avg(F.when(
            F.col("is_test"), (F.col("label") == F.col("ai_predicted_issue")).cast("int")
        )), F.lit(0.0)), 4).alias("accuracy"),
    )
    scores = class_scores(predicted.where("is_test"), "label", "ai_predicted_issue")
    weighted = F.sum(F.col("f1") * F.col("support")) / F.sum("support")
    f1 = scores.agg(
        F.round(F.coalesce(F.avg("f1"), F.lit(0.0)), 4).alias("macro_f1"),
        F.round(F.coalesce(weighted, F.lit(0.0)), 4).alias("weighted_f1"),
    )
    one = F.lit(1)
    return sizes.withColumn("_k", one).join(f1.withColumn("_k", one), "_k").drop("_k")


def train_and_predict(
    records: DataFrame, save_to: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(records with predictions, one-row metrics). Read ``records`` from a stage table.

    The text of the split is cut into tokens once; fitting and judging read these. Records with ``_tokens`` in
    place of the text are not cut at all. With ``save_to`` the model goes there as tables.
    """
    counts = {r.label: r.records for r in class_counts(records).collect()}
    labels = sorted(counts)
    names = F.array(*[F.lit(label) for label in labels]).cast("array<string>").alias("labels")
    if len(labels) < 2 or sum(counts.values()) < MIN_RECORDS or min(counts.values()) < 2:
        metrics = records.sparkSession.range(1).select(
            F.lit("fallback_rule_based").alias("model_used"),
            F.lit("insufficient label diversity, class size, or sample size").alias("reason"),
            names,
        )
        return fallback_predict(records.drop("_tokens")), metrics
    labelled = with_primary_label(records)
    if "_tokens" in records.columns:
        tokens = labelled.select("seq", "_tokens", "label")
    else:
        tokens = stage(tfidf.tokenized(labelled.select("seq", tfidf.corpus_text().alias("text"), "label")), "tokens")
    split = stage(stratified_split(tokens, counts), "split")
    classifier = fit_classifier(split.where("not is_test"), labels)
    if save_to:
        save_model(model_tables(classifier), save_to)
    judged = predict(split, classifier).select("label", "ai_predicted_issue", "is_test")
    metrics = holdout_metrics(judged).select(F.lit("tfidf_logreg").alias("model_used"), "*", names)
    return predict_all(records, classifier), metrics
