"""Classification, retrieval and agreement metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed


def pair_counts(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """(truth, predicted, n): the only pass over the rows; all class metrics start from it."""
    return df.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def accuracy(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Share of rows whose prediction is right; a missing prediction or truth is wrong."""
    right = F.coalesce((F.col(truth) == F.col(predicted)).cast("double"), F.lit(0.0))
    return df.agg(F.count("*").alias("n"), F.avg(right).alias("accuracy"))


def seen_labels(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Distinct labels of truth and prediction."""
    return (
        df.select(F.explode(F.array(F.col(truth), F.col(predicted))).alias("label"))
        .distinct()
        .where(F.col("label").isNotNull())
    )


def confusion_matrix(df: DataFrame, truth: str, predicted: str, labels: list[str] | None = None) -> DataFrame:
    """(truth, predicted, n) for every pair of labels, with zeros.

    Without a label list the labels seen are used; only the labels are combined, not the rows.
    """
    if labels is not None:
        names = F.array(*[F.lit(name) for name in labels])
        table = df.sparkSession.createDataFrame([(name,) for name in labels], "truth string")
    else:
        seen = seen_labels(df, truth, predicted)
        names = seen.agg(F.collect_set("label")).scalar()
        table = seen.select(F.col("label").alias("truth"))
    grid = table.select("truth", F.explode(names).alias("predicted"))
    counts = pair_counts(df, truth, predicted)
    return grid.join(counts, ["truth", "predicted"], "left").fillna(0, ["n"])


def wide_confusion(df: DataFrame, truth: str, predicted: str, labels: list[str]) -> DataFrame:
    """Confusion matrix with one column per predicted label."""
    matrix = confusion_matrix(df, truth, predicted, labels)
    return matrix.groupBy("truth").pivot("predicted", labels).agg(F.sum("n"))


def class_report(df: DataFrame, truth: str, predicted: str, labels: list[str] | None = None) -> DataFrame:
    """(label, precision, recall, f1, support); a zero denominator gives 0.

    With a label list exactly those labels are reported, else the labels seen.
    """
    hit = F.col("truth") == F.col("predicted")
    roles = pair_counts(df, truth, predicted).select(
        F.inline(
            F.array(
                F.struct(
                    F.col("truth").alias("label"),
                    F.when(hit, F.col("n")).otherwise(0).alias("tp"),
                    F.lit(0).cast("long").alias("n_predicted"),
                    F.col("n").alias("support"),
                ),
                F.struct(
                    F.col("predicted").alias("label"),
                    F.lit(0).cast("long").alias("tp"),
                    F.col("n").alias("n_predicted"),
                    F.lit(0).cast("long").alias("support"),
                ),
            )
        )
    )
    sums = roles.where(F.col("label").isNotNull()).groupBy("label").agg(
        *[F.sum(name).alias(name) for name in ("tp", "n_predicted", "support")]
    )
    if labels is not None:
        wanted = df.sparkSession.createDataFrame([(name,) for name in labels], "label string")
        sums = wanted.join(sums, "label", "left").fillna(0, ["tp", "n_predicted", "support"])

    def ratio(numerator, denominator):
        return F.coalesce(F.try_divide(numerator.cast("double"), denominator), F.lit(0.0))

    return sums.select(
        "label",
        ratio(F.col("tp"), F.col("n_predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("n_predicted") + F.col("support")).alias("f1"),
        "support",
    )


def macro_averages(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Macro and support-weighted averages over the labels seen in truth or prediction."""
    report = class_report(df, truth, predicted)
    plain = [F.avg(name).alias(f"macro_{name}") for name in ("precision", "recall", "f1")]
    weighted = [
        F.try_divide(F.sum(F.col(name) * F.col("support")), F.sum("support")).alias(f"weighted_{name}")
        for name in ("precision", "recall", "f1")
    ]
    return report.agg(F.count("*").alias("n_labels"), *plain, *weighted)


def retrieval_metrics(
    queries: DataFrame, results: DataFrame, key: str, similarity: str = "similarity", relevant: str | None = None
) -> DataFrame:
    """Mean best similarity, mean of per-query means, query count, queries without results.

    With a relevance column also the share of all queries whose first result is relevant.
    """
    first = F.col("rank") == 1
    aggregates = [
        F.max(F.when(first, F.col(similarity))).alias("_top"),
        F.avg(similarity).alias("_mean"),
    ]
    if relevant:
        aggregates.append(F.max(F.when(first, F.col(relevant).cast("int"))).alias("_hit"))
    per_query = queries.select(key).join(results.groupBy(key).agg(*aggregates), key, "left")
    totals = [
        F.coalesce(F.avg("_top"), F.lit(0.0)).alias("mean_top1_similarity"),
        F.coalesce(F.avg("_mean"), F.lit(0.0)).alias("mean_topk_similarity"),
        F.count("*").alias("n_queries"),
        F.count(F.when(F.col("_top").isNull(), 1)).alias("n_empty"),
    ]
    if relevant:
        totals.append(F.avg(F.coalesce(F.col("_hit"), F.lit(0)).cast("double")).alias("hit_rate_at_1"))
    return per_query.agg(*totals)


def judge_summary(df: DataFrame) -> DataFrame:
    """Mean judge score per dimension and overall."""
    names = [*fixed.JUDGE_DIMENSIONS, "average"]
    return df.agg(F.count("*").alias("n"), *[F.avg(name).alias(name) for name in names])


def cohens_kappa(df: DataFrame, human: str, judge: str) -> DataFrame:
    """Agreement of human scores with judge averages rounded half to even.

    Rows without a human score are left out; kappa is null without rows or when chance
    agreement is total.
    """
    rated = df.where(F.col(human).isNotNull() & F.col(judge).isNotNull()).select(
        F.col(human).cast("int").alias("_human"), F.bround(F.col(judge), 0).cast("int").alias("_judge")
    )
    counts = rated.groupBy("_human", "_judge").agg(F.count("*").alias("_n"))
    sides = counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("_human").alias("_score"),
                    F.col("_n").alias("_h"),
                    F.lit(0).cast("long").alias("_j"),
                    F.when(F.col("_human") == F.col("_judge"), F.col("_n")).otherwise(0).alias("_agree"),
                ),
                F.struct(
                    F.col("_judge").alias("_score"),
                    F.lit(0).cast("long").alias("_h"),
                    F.col("_n").alias("_j"),
                    F.lit(0).cast("long").alias("_agree"),
                ),
            )
        )
    )
    margins = sides.groupBy("_score").agg(*[F.sum(name).alias(name) for name in ("_h", "_j", "_agree")])
    sums = margins.agg(
        F.coalesce(F.sum("_h"), F.lit(0)).alias("n"),
        F.sum("_agree").alias("_agreed"),
        F.sum(F.col("_h").cast("double") * F.col("_j")).alias("_product"),
    )
    observed = F.try_divide(F.col("_agreed").cast("double"), F.col("n"))
    expected = F.try_divide(F.col("_product"), F.col("n").cast("double") * F.col("n"))
    return sums.select(
        "n",
        observed.alias("observed"),
        expected.alias("expected"),
        F.try_divide(observed - expected, 1 - expected).alias("kappa"),
    )

