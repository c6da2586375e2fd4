"""Lookup join that keeps very frequent keys out of the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 1_000


def lookup_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", total: int | None = None, hot_rows: int | None = None
) -> DataFrame:
    """Join rows with a table that has one row (or a few) per key.

    A key is hot when it holds at least ``hot_rows`` rows and a thousandth of the left side, so
    there are never more than a thousand. Their right rows are broadcast and the left rows stay
    where they are; only the other keys are shuffled. Small inputs are joined plainly. ``total`` is the
    size of the left side, or an upper bound, where the caller knows it.
    """
    hot_rows = HOT_ROWS if hot_rows is None else hot_rows
    total = left.count() if total is None else total
    if total < hot_rows:
        return left.join(right, key, how)
    limit = max(hot_rows, -(-total // MAX_HOT_KEYS))
    hot = left.groupBy(key).agg(F.count("*").alias("_n")).where((F.col("_n") >= limit) & F.col(key).isNotNull()).select(key)
    hot_right = right.join(F.broadcast(hot), key, "left_semi")
    frequent = left.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(hot_right), key, how)
    rest = left.join(F.broadcast(hot), key, "left_anti").join(right, key, how)
    return frequent.unionByName(rest)
