"""Statistics per brand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.operators.skew import lookup_join


def outbound(messages: DataFrame) -> DataFrame:
    return messages.where(~F.col("inbound"))


def inbound(messages: DataFrame) -> DataFrame:
    return messages.where(F.col("inbound"))


def brand_messages(messages: DataFrame, brand: str) -> DataFrame:
    """The brand's own messages, without regard to case."""
    return messages.where(F.lower("author_id") == brand.lower())


def answering_messages(messages: DataFrame) -> DataFrame:
    """Outbound messages that answer an inbound message of the data."""
    parent = "in_response_to_tweet_id"
    customers = inbound(messages).select(F.col("tweet_id").alias(parent)).distinct()
    replies = outbound(messages).where(F.col(parent).isNotNull())
    return lookup_join(replies, customers, parent, "left_semi").select(*messages.columns)


def outbound_counts(messages: DataFrame) -> DataFrame:
    return outbound(messages).groupBy("author_id").agg(F.count("*").alias("outbound_sent"))


def answered_counts(messages: DataFrame) -> DataFrame:
    """Distinct inbound messages each brand has answered.

    Pairs are made unique before the join, so neither a busy brand nor a message with very many
    replies ends up in one task.
    """
    customers = inbound(messages).select(F.col("tweet_id").alias("in_response_to_tweet_id")).distinct()
    pairs = (
        outbound(messages)
        .where(F.col("in_response_to_tweet_id").isNotNull())
        .select("author_id", "in_response_to_tweet_id")
        .distinct()
    )
    answered = pairs.join(customers, "in_response_to_tweet_id", "left_semi")
    return answered.groupBy("author_id").agg(F.count("*").alias("threads_with_reply"))


def completeness(answered: Column, sent: Column) -> Column:
    return F.bround(answered / F.greatest(sent, F.lit(1)) * 100.0, 1)


def completeness_band(percent: Column) -> Column:
    return (
        F.when(percent >= fixed.COMPLETENESS_GREEN, "green")
        .when(percent >= fixed.COMPLETENESS_YELLOW, "yellow")
        .otherwise("red")
    )


def brand_stats(messages: DataFrame, top_n: int = fixed.BRAND_TOP_N) -> DataFrame:
    """The brands with most outbound messages: volume, answered messages and completeness."""
    return (
        outbound_counts(messages)
        .join(answered_counts(messages), "author_id", "left")
        .fillna(0, ["threads_with_reply"])
        .withColumn("thread_completeness_pct", completeness(F.col("threads_with_reply"), F.col("outbound_sent")))
        .withColumnRenamed("author_id", "brand")
        .orderBy(F.desc("outbound_sent"), "brand")
        .limit(top_n)
    )


def recommended_brand(stats: DataFrame) -> DataFrame:
    """The first row of the statistics; equal volumes go to the first name."""
    return stats.orderBy(F.desc("outbound_sent"), "brand").limit(1)


def corpus_profile(messages: DataFrame) -> DataFrame:
    """Row count and distinct authors; authors are made unique before they are counted."""
    return (
        messages.groupBy("author_id")
        .agg(F.count("*").alias("_n"))
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n_messages"), F.count("author_id").alias("n_authors"))
    )
