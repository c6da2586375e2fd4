"""Intent taxonomy as a dimension table of ten rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.fixed_values import TAXONOMY

SCHEMA = (
    "intent_id int, intent string, description string, keywords array<string>, "
    "escalation_denylist boolean, examples array<string>"
)


def taxonomy(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(number, *row) for number, row in enumerate(TAXONOMY)], SCHEMA)


def intent_of(number: Column) -> Column:
    """Name of a 0-based intent id; null outside the taxonomy."""
    return F.get(F.array(*[F.lit(row[0]) for row in TAXONOMY]), number)


def with_intent_details(df: DataFrame, intent: str = "intent") -> DataFrame:
    """Attach id, description and denylist flag; an unknown name gets an empty description.

    The taxonomy always has ten rows, so it is broadcast.
    """
    details = taxonomy(df.sparkSession).select(
        F.col("intent").alias(intent), "intent_id", "description", "escalation_denylist"
    )
    return df.join(F.broadcast(details), intent, "left").fillna("", ["description"])


def known_intents(df: DataFrame, intent: str = "intent") -> DataFrame:
    """Rows whose label is a taxonomy name; null and unknown labels go."""
    return df.where(F.col(intent).isin([row[0] for row in TAXONOMY]))
