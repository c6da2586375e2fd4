"""Exact ranks and seeded samples that never put a whole group into one task."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyscope.functions.text import hash_key

# Hash prefixes of four hexadecimal digits: at most 65,536 buckets in each group
PREFIX = 4
BUCKET_WIDTH = 1 << 20
STEPS_PER_DOUBLING = 64


def position_bucket(position: Column) -> Column:
    """Bucket of a unique whole-number position: never more than BUCKET_WIDTH rows."""
    return F.floor(position / F.lit(float(BUCKET_WIDTH))).cast("long")


def bucket_offsets(df: DataFrame, keys: list[str], bucket: str = "_bucket") -> DataFrame:
    """(keys, bucket, _size, _before): rows of the group that lie in earlier buckets."""
    sizes = df.groupBy(*keys, bucket).agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))


def bucket_rank(df: DataFrame, keys: list[str], bucket: Column, order: list[str | Column], name: str) -> DataFrame:
    """Add the 1-based rank of each row in its group.

    ``bucket`` must never decrease along ``order``. Rows are sorted only inside one
    (group, bucket), so a group that holds a third of the table is spread over many tasks;
    the rank is the position in the bucket plus the sizes of the earlier buckets.
    """
    parted = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        parted.withColumn("_place", F.row_number().over(inside))
        .join(bucket_offsets(parted, keys), [*keys, "_bucket"])
        .withColumn(name, (F.col("_before") + F.col("_place")).cast("long"))
        .drop("_bucket", "_place", "_size", "_before")
    )


def lowest_by_hash(
    df: DataFrame, identifier: str, keys: list[str], limit: Callable[[Column], Column], seed: int
) -> DataFrame:
    """The rows with the lowest hashes in each group; ``limit`` maps group size to row count.

    Exact: whole hash-prefix buckets are taken below the limit and only the bucket in which
    the limit falls is sorted.
    """
    hashed = df.withColumn("_hash", hash_key(F.col(identifier), seed)).withColumn(
        "_bucket", F.substring("_hash", 1, PREFIX)
    )
    whole = Window.partitionBy(*keys)
    wanted = (
        bucket_offsets(hashed, keys)
        .withColumn("_limit", limit(F.sum("_size").over(whole)))
        .where(F.col("_before") < F.col("_limit"))
    )
    if not keys:
        # One row per hash prefix; rows of other buckets are dropped before any shuffle
        wanted = F.broadcast(wanted)
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_hash", identifier)
    return (
        hashed.join(wanted, [*keys, "_bucket"])
        .withColumn("_place", F.row_number().over(inside))
        .where(F.col("_before") + F.col("_place") <= F.col("_limit"))
        .drop("_hash", "_bucket", "_size", "_before", "_limit", "_place")
    )


def highest_rows(df: DataFrame, n: int, value: str, tie: str) -> DataFrame:
    """The n rows with the highest positive values; equal values are ordered by ``tie``.

    Values are counted in steps of about one percent (some thousand steps), and only rows of
    the steps that reach the n-th row are sorted. ``df`` is read twice.
    """
    stepped = df.withColumn("_bucket", -F.floor(F.log2(value) * STEPS_PER_DOUBLING))
    reached = bucket_offsets(stepped, []).where(F.col("_before") < n).select("_bucket")
    kept = stepped.join(F.broadcast(reached), "_bucket", "left_semi").drop("_bucket")
    return kept.orderBy(F.desc(value), tie).limit(n)


def hash_sample(df: DataFrame, identifier: str, n: int | None, seed: int) -> DataFrame:
    """n rows chosen by hash order of the identifier; all rows when n is empty or too large."""
    if not n:
        return df
    return lowest_by_hash(df, identifier, [], lambda size: F.lit(n), seed)
