"""Intent classifiers: majority class, TF-IDF with logistic regression, neighbour vote."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from replyscope import fixed_values as fixed
from replyscope.operators.tfidf import Vocabulary, fit_vocabulary, sparse_texts
from replyscope.session import cut_lineage, tidy


FIT_PIECES_PER_CORE = 2


def majority_class(df: DataFrame, label: str) -> DataFrame:
    """One row: the most frequent label, its count, the total and its share; ties go to the lowest name."""
    counts = df.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_n"))
    top = F.min(F.struct((-F.col("_n")).alias("_order"), F.col("_label")))
    return counts.agg(top.alias("_top"), F.sum("_n").alias("n_total")).select(
        F.col("_top._label").alias("majority_intent"),
        (-F.col("_top._order")).alias("n_majority"),
        "n_total",
        (-F.col("_top._order") / F.col("n_total")).alias("share"),
    )


def majority_baseline(train: DataFrame, label: str, messages: DataFrame) -> DataFrame:
    """The majority class, confidence 1 and a canned reply for every message."""
    return messages.withColumns(
        {
            "intent": majority_class(train, label).select("majority_intent").scalar(),
            "confidence": F.lit(1.0),
            "draft_reply": F.lit(fixed.CANNED_REPLY),
            "decision": F.lit("auto_handle"),
            "reason": F.lit(fixed.TRIVIAL_REASON),
        }
    )


def best_label(scores: DataFrame, key: str, label: str = "label", score: str = "score") -> DataFrame:
    """(key, intent, confidence, top2_gap) from long scores; the gap is 1 with only one class.

    Equal scores go to the lowest label. A group has one row per class.
    """
    ranked = F.sort_array(F.collect_list(F.struct((-F.col(score)).alias("_order"), F.col(label).alias("_label"))))
    top = scores.groupBy(key).agg(ranked.alias("_ranked"))
    first, second = F.get("_ranked", F.lit(0)), F.get("_ranked", F.lit(1))
    return top.select(
        key,
        first["_label"].alias("intent"),
        (-first["_order"]).alias("confidence"),
        F.when(second.isNull(), 1.0).otherwise(second["_order"] - first["_order"]).alias("top2_gap"),
    )


def neighbour_scores(neighbours: DataFrame, key: str, label: str = "label", similarity: str = "similarity") -> DataFrame:
    """(key, label, score): share of the retrieved similarity that falls on each label."""
    sums = neighbours.groupBy(key, label).agg(F.sum(F.greatest(similarity, F.lit(0.0))).alias("_sum"))
    total = F.sum("_sum").over(Window.partitionBy(key))
    return sums.select(key, F.col(label).alias("label"), F.coalesce(F.try_divide("_sum", total), F.lit(0.0)).alias("score"))


def class_shares(rows: DataFrame, key: str, coefficients: np.ndarray, intercepts: np.ndarray) -> DataFrame:
    """(key, shares): class probabilities of sparse rows, computed for a whole Arrow batch at a time.

    The coefficients have one row per class and one column per vocabulary term; a model of two
    classes has only the row of the second.
    """
    if len(coefficients) == 1:
        coefficients = np.vstack([np.zeros_like(coefficients), coefficients])
        intercepts = np.concatenate([[0.0], intercepts])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, n = batch.column("terms"), batch.num_rows
            owner = np.repeat(np.arange(n), lists.value_lengths().to_numpy(zero_copy_only=False))
            at, weights = lists.flatten().to_numpy(), batch.column("weights").flatten().to_numpy()
            margins = np.column_stack([np.bincount(owner, weights * row[at], n) for row in coefficients]) + intercepts
            powers = np.exp(margins - margins.max(axis=1, keepdims=True))
            shares = pa.array((powers / powers.sum(axis=1, keepdims=True)).ravel())
            offsets = pa.array(np.arange(n + 1) * len(coefficients), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.ListArray.from_arrays(offsets, shares)], names=[key, "shares"])

    return rows.select(key, "terms", "weights").mapInArrow(
        tidy(score), StructType([rows.schema[key], StructField("shares", ArrayType(DoubleType()))])
    )


def as_vectors(rows: DataFrame, size: int, *keep: str) -> DataFrame:
    """(keep, features): sparse vectors made of the Arrow lists themselves."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            parts = {
                "type": pa.array(np.zeros(n, dtype=np.int8)),
                "size": pa.array(np.full(n, size, dtype=np.int32)),
                "indices": batch.column("terms"),
                "values": batch.column("weights"),
            }
            vectors = pa.StructArray.from_arrays(list(parts.values()), names=list(parts))
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in keep), vectors], names=[*keep, "features"])

    schema = StructType([*(rows.schema[name] for name in keep), StructField("features", VectorUDT())])
    return rows.select(*keep, "terms", "weights").mapInArrow(tidy(build), schema)


@dataclass(frozen=True)
class TextClassifier:
    """TF-IDF vocabulary, logistic regression and the label names in index order."""

    vocabulary: Vocabulary
    model: LogisticRegressionModel
    labels: list[str]

    def scores(self, df: DataFrame, key: str, text: str) -> DataFrame:
        """(key, label, score): the full distribution of every message."""
        weights = sparse_texts(df, key, text, self.vocabulary)
        names = F.array(*[F.lit(name) for name in self.labels])
        shares = class_shares(weights, key, self.model.coefficientMatrix.toArray(), self.model.interceptVector.toArray())
        return shares.select(key, F.posexplode("shares").alias("_index", "score")).select(
            key, F.get(names, F.col("_index")).alias("label"), "score"
        )

    def predict(self, df: DataFrame, key: str, text: str) -> DataFrame:
        return best_label(self.scores(df, key, text), key)

    def save(self, path: str) -> None:
        self.vocabulary.table.write.mode("overwrite").parquet(f"{path}/vocabulary")
        self.model.write().overwrite().save(f"{path}/model")
        spark = self.vocabulary.table.sparkSession
        info = spark.createDataFrame(
            [(self.labels, self.vocabulary.n_texts, self.vocabulary.max_features)],
            "labels array<string>, n_texts long, max_features int",
        )
        info.write.mode("overwrite").json(f"{path}/info")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TextClassifier":
        info = spark.read.schema("labels array<string>, n_texts long, max_features int").json(f"{path}/info").first()
        table = spark.read.parquet(f"{path}/vocabulary")
        model = LogisticRegressionModel.load(f"{path}/model")
        return TextClassifier(Vocabulary(table, info["n_texts"], info["max_features"]), model, list(info["labels"]))


def fit_text_classifier(
    df: DataFrame,
    key: str,
    text: str,
    label: str,
    *,
    c: float = 1.0,
    max_iter: int = 1000,
    tolerance: float = 1e-4,
    max_features: int = fixed.MAX_FEATURES,
    balanced: bool = True,
) -> TextClassifier:
    """Logistic regression on TF-IDF with class-balanced weights n / (classes * class size).

    Two classes give a binomial model, more a multinomial one. Penalty 1 / (c * n) on the mean
    loss equals an inverse strength c on the summed loss.
    """
    df = cut_lineage(df.select(key, text, label))
    fitted = fit_vocabulary(df, key, text, max_features)
    vocabulary = Vocabulary(cut_lineage(fitted.table), fitted.n_texts, max_features)
    # One row per class of the model, which the model holds on the driver as well
    counts = {row["_label"]: row["_n"] for row in df.groupBy(F.col(label).alias("_label")).agg(F.count("*").alias("_n")).collect()}
    labels, n = sorted(counts), sum(counts.values())
    index = F.create_map(*[F.lit(x) for pair in ((name, float(i)) for i, name in enumerate(labels)) for x in pair])
    weight = F.create_map(
        *[F.lit(x) for name in labels for x in (name, n / (len(labels) * counts[name]) if balanced else 1.0)]
    )
    rows = sparse_texts(df, key, text, vocabulary, keep=[label])
    training = cut_lineage(
        as_vectors(rows, max_features, label).select(
            "features",
            index[F.col(label)].alias("label"),
            weight[F.col(label)].alias("weight"),
        )
    )
    regression = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        weightCol="weight",
        regParam=1.0 / (c * n),
        standardization=False,
        maxIter=max_iter,
        tol=tolerance,
    )
    # Every step of the fit sends a gradient of classes x terms from each piece, so pieces follow the cores and not the texts
    pieces = FIT_PIECES_PER_CORE * df.sparkSession.sparkContext.defaultParallelism
    return TextClassifier(vocabulary, regression.fit(training.coalesce(pieces)), labels)


def simple_baseline(
    classifier: TextClassifier, messages: DataFrame, key: str, text: str, replies: DataFrame
) -> DataFrame:
    """Classifier label and confidence with the reply template of ``replies`` (key, draft_reply)."""
    return (
        classifier.predict(messages, key, text)
        .drop("top2_gap")
        .join(replies.select(key, "draft_reply"), key, "left")
        .withColumns({"decision": F.lit("auto_handle"), "reason": F.lit(fixed.SIMPLE_REASON)})
    )
