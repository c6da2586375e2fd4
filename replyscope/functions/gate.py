"""Escalation gate: ordered rules over signals that are already columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.functions.text import word_count


def two_digits(value: Column) -> Column:
    return F.format_string("%.2f", F.bround(value.cast("double"), 2))


def escalation_gate(
    df: DataFrame,
    *,
    message: str = "message",
    intent: str = "intent",
    confidence: str = "confidence",
    top_similarity: str = "top_similarity",
    n_retrieved: str | None = None,
    urgency: str | None = None,
    sentiment: str | None = None,
    language: str | None = None,
    confidence_threshold: float = fixed.CONFIDENCE_THRESHOLD,
    similarity_threshold: float = fixed.SIMILARITY_THRESHOLD,
    urgency_threshold: float = fixed.URGENCY_THRESHOLD,
    denylist: Iterable[str] | None = None,
    min_words: int = fixed.MIN_WORDS,
) -> DataFrame:
    """Add decision, reason, signals and triggered_rules.

    ``denylist=None`` takes the default list; an empty list really means no denied intents.
    A missing similarity counts as 0, a missing urgency as 0 and a missing sentiment as
    neutral. The language rule needs a language column and passes where it is null.
    """
    denied = sorted(fixed.DENYLIST if denylist is None else denylist)
    name = F.col(intent)
    sure = F.col(confidence).cast("double")
    similar = F.coalesce(F.col(top_similarity).cast("double"), F.lit(0.0))
    urgent = F.coalesce(F.col(urgency).cast("double"), F.lit(0.0)) if urgency else F.lit(0.0)
    mood = F.coalesce(F.col(sentiment), F.lit("neutral")) if sentiment else F.lit("neutral")
    words = word_count(F.col(message))
    retrieved = F.col(n_retrieved) if n_retrieved else F.when(F.col(top_similarity).isNull(), 0).otherwise(1)
    foreign = F.coalesce(F.col(language) != "en", F.lit(False)) if language else F.lit(False)

    rules = [
        (
            "non_english",
            foreign,
            F.lit("Message appears to be non-English; requires specialized handling."),
        ),
        (
            "denylist",
            name.isin(denied) if denied else F.lit(False),
            F.concat(
                F.lit("Intent '"),
                name,
                F.lit(
                    "' is in the high-risk escalation denylist "
                    "(billing/account/security issues require human review)."
                ),
            ),
        ),
        (
            "low_confidence",
            sure < confidence_threshold,
            F.concat(
                F.lit("Classifier confidence is low ("),
                two_digits(sure),
                F.lit(f" < threshold {confidence_threshold:.2f}); the predicted intent '"),
                name,
                F.lit("' may be incorrect."),
            ),
        ),
        (
            "low_similarity",
            similar < similarity_threshold,
            F.concat(
                F.lit("Best retrieval similarity is "),
                two_digits(similar),
                F.lit(
                    f" (< threshold {similarity_threshold:.2f}); "
                    "no sufficiently similar historical resolution found to ground a safe reply."
                ),
            ),
        ),
        (
            "high_urgency",
            urgent >= urgency_threshold,
            F.concat(
                F.lit("Urgency score "),
                two_digits(urgent),
                F.lit(f" (>= threshold {urgency_threshold:.2f}); customer appears very distressed (sentiment: "),
                mood,
                F.lit(")."),
            ),
        ),
        (
            "too_short",
            words < min_words,
            F.concat(
                F.lit("Message is very short ("),
                words.cast("string"),
                F.lit(" words); insufficient context for reliable classification or reply generation."),
            ),
        ),
    ]
    hits = F.array_compact(
        F.array(*[F.when(hit, F.struct(F.lit(rule).alias("rule"), text.alias("text"))) for rule, hit, text in rules])
    )
    passed = F.concat(
        F.lit("Auto-handled: confidence "),
        two_digits(sure),
        F.lit(f" >= {confidence_threshold}; similarity "),
        two_digits(similar),
        F.lit(f" >= {similarity_threshold}; intent '"),
        name,
        F.lit("' not in denylist; urgency score "),
        two_digits(urgent),
        F.lit(" is acceptable."),
    )
    escalated = F.size("_hits") > 0
    signals = F.struct(
        name.alias("intent"),
        F.bround(sure, 3).alias("confidence"),
        F.bround(similar, 3).alias("top_similarity"),
        F.bround(urgent, 3).alias("urgency_score"),
        mood.alias("sentiment"),
        words.alias("word_count"),
        retrieved.alias("n_retrieved"),
    )
    return (
        df.withColumn("_hits", hits)
        .withColumns(
            {
                "decision": F.when(escalated, "escalate").otherwise("auto_handle"),
                "reason": F.when(
                    escalated, F.concat(F.lit("ESCALATE — "), F.array_join(F.col("_hits.text"), " | "))
                ).otherwise(passed),
                "signals": signals,
                "triggered_rules": F.col("_hits.rule"),
            }
        )
        .drop("_hits")
    )


def rule_counts(gated: DataFrame) -> DataFrame:
    """How often each rule fired."""
    return gated.select(F.explode("triggered_rules").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


def escalation_quality(df: DataFrame, decision: str = "decision", human: str = "human_escalate") -> DataFrame:
    """Escalation rate over all rows; precision and recall over rows a person has judged."""
    flagged = F.col(decision) == "escalate"
    wanted = F.col(human) == "escalate"
    judged = F.col(human).isin("escalate", "auto_handle")

    def total(condition: Column) -> Column:
        return F.sum(F.coalesce(condition, F.lit(False)).cast("int")).cast("double")

    return df.agg(
        F.count("*").alias("n"),
        (total(flagged) / F.count("*")).alias("escalation_rate"),
        F.try_divide(total(flagged & wanted), total(flagged & judged)).alias("precision"),
        F.try_divide(total(flagged & wanted), total(wanted)).alias("recall"),
    )
