"""Sampling for labelling and evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.functions.text import hash_key
from replyscope.operators.ranking import hash_sample, lowest_by_hash


def group_samples(df: DataFrame, identifier: str, group: str, n: int, seed: int = fixed.RANDOM_SEED) -> DataFrame:
    """Up to n rows of each group. The constant rank limit is applied before the shuffle."""
    order = Window.partitionBy(group).orderBy("_hash", identifier)
    return (
        df.withColumn("_hash", hash_key(F.col(identifier), seed))
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= n)
        .drop("_hash", "_rank")
    )


def stratified_split(
    df: DataFrame, identifier: str, label: str, fraction: float = fixed.EVAL_SPLIT, seed: int = fixed.RANDOM_SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, eval): of each label, the ceiling of the fraction goes to the eval part."""
    held_out = lowest_by_hash(
        df.select(identifier, label), identifier, [label], lambda size: F.ceil(size * F.lit(fraction)), seed
    ).select(identifier)
    return df.join(held_out, identifier, "left_anti"), df.join(held_out, identifier, "left_semi")


def edge_flags(
    df: DataFrame, words: str = "word_count", gap: str = "top2_gap", similarity: str = "top_similarity"
) -> DataFrame:
    """Add the three edge-case predicates and their disjunction."""
    return df.withColumns(
        {
            "is_edge_short": F.col(words) < fixed.EDGE_MAX_WORDS,
            "is_edge_ambiguous": F.col(gap) < fixed.EDGE_MAX_GAP,
            "is_edge_no_precedent": F.col(similarity) < fixed.EDGE_MIN_SIMILARITY,
        }
    ).withColumn("is_edge", F.col("is_edge_short") | F.col("is_edge_ambiguous") | F.col("is_edge_no_precedent"))


def golden_sample(
    candidates: DataFrame,
    identifier: str = "thread_id",
    intent: str = "predicted_intent",
    target: int = fixed.GOLDEN_TARGET,
    per_intent: int = fixed.GOLDEN_PER_INTENT,
    edge_fraction: float = fixed.GOLDEN_EDGE_FRACTION,
    intents: list[str] = fixed.INTENT_NAMES,
    seed: int = fixed.RANDOM_SEED,
) -> DataFrame:
    """Edge cases first, then rows of every intent, without repeats, capped at the target size."""
    n_edge = int(target * edge_fraction)
    per_class = max(per_intent, (target - n_edge) // len(intents))
    edges = hash_sample(candidates.where("is_edge"), identifier, n_edge, seed).withColumn("_part", F.lit(0))
    rest = candidates.join(edges.select(identifier), identifier, "left_anti").where(F.col(intent).isin(intents))
    classes = group_samples(rest, identifier, intent, per_class, seed).withColumn("_part", F.lit(1))
    return (
        edges.unionByName(classes)
        .withColumn("_hash", hash_key(F.col(identifier), seed))
        .orderBy("_part", "_hash", identifier)
        .limit(target)
        .drop("_part", "_hash")
    )
