"""Weak labelling: batches, distribution, success, and resuming human labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.operators.ranking import bucket_rank
from replyscope.session import cut_lineage


def in_batches(df: DataFrame, order: str, size: int = fixed.LABEL_BATCH) -> DataFrame:
    """Add batch (from 0) and index (1-based in the batch), following ``order``, a unique column.

    Ranges of about equally many rows are numbered side by side, however the values are spread; the cut
    is written once. Rows without an order come first.
    """
    ranges = cut_lineage(df.repartitionByRange(F.col(order)).withColumn("_range", F.spark_partition_id()))
    place = F.col("_seat") - 1
    return (
        bucket_rank(ranges, [], F.col("_range"), [order], "_seat")
        .withColumns({"batch": F.floor(place / size).cast("long"), "index": (place % size + 1).cast("int")})
        .drop("_seat", "_range")
    )


def batch_texts(batched: DataFrame, text: str = "text") -> DataFrame:
    """(batch, texts): the ordered messages of each batch."""
    members = F.array_sort(F.collect_list(F.struct("index", F.coalesce(F.col(text), F.lit("")).alias("_text"))))
    return batched.groupBy("batch").agg(members.alias("_members")).select("batch", F.col("_members._text").alias("texts"))


def label_distribution(df: DataFrame, label: str = "intent") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label)


def labelling_stats(df: DataFrame, label: str = "intent") -> DataFrame:
    """Attempted, labelled and failed messages and the success rate."""
    valid = F.col(label).isNotNull() & F.col(label).isin(fixed.INTENT_NAMES)
    labelled = F.sum(F.coalesce(valid, F.lit(False)).cast("long"))
    return df.agg(
        F.count("*").alias("total_attempted"),
        labelled.alias("total_labeled"),
        (F.count("*") - labelled).alias("n_failed"),
        F.try_divide(labelled.cast("double"), F.count("*")).alias("success_rate"),
    )


def resume_labels(
    work: DataFrame, earlier: DataFrame, key: str = "thread_id", label: str = "human_intent", order: str = "position"
) -> DataFrame:
    """Work list with earlier non-empty labels filled in; "" marks what is left to do.

    An earlier label replaces the one in the work list. ``earlier`` may list a key again;
    the non-empty entry with the highest ``order`` counts, of equal ones the highest label.
    """
    done = earlier.where(F.coalesce(F.col(label), F.lit("")) != "")
    latest = F.max(F.struct(F.col(order).alias("_order"), F.col(label).alias("_label")))
    done = done.groupBy(key).agg(latest.alias("_latest")).select(key, F.col("_latest._label").alias("_done"))
    merged = work.join(done, key, "left")
    return merged.withColumn(label, F.coalesce("_done", F.col(label), F.lit(""))).drop("_done")


def labelling_progress(df: DataFrame, label: str = "human_intent") -> DataFrame:
    done = F.sum((F.coalesce(F.col(label), F.lit("")) != "").cast("long"))
    return df.agg(F.count("*").alias("n_total"), done.alias("n_done"), (F.count("*") - done).alias("n_remaining"))
