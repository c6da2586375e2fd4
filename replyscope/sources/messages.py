"""Message tables: scans and the adapter for conversation logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.session import cut_lineage

MESSAGE_SCHEMA = (
    "tweet_id string, author_id string, inbound boolean, created_at string, text string, "
    "response_tweet_id string, in_response_to_tweet_id string"
)
POSITION = "position"
# A quoted empty field is "", an empty field without quotes is null
CSV_OPTIONS = dict(header=True, quote='"', escape='"', emptyValue="", nullValue="\u0000")
# Ids of conversation messages are conv_id * TURNS + turn
TURNS = 1_000_000


def load_messages(
    spark: SparkSession, path: str, format: str = "csv", limit: int | None = None, multi_line: bool = True
) -> DataFrame:
    """Scan raw messages with ids and created_at as text, optionally only ``limit`` rows.

    No type is inferred, so the files are read once. A CSV file with line breaks inside quotes is read
    by one task; say ``multi_line=False`` where there are none, or convert large input to Parquet.
    """
    reader = spark.read.schema(MESSAGE_SCHEMA)
    if format == "csv":
        reader = reader.options(**CSV_OPTIONS, multiLine=multi_line)
    df = reader.format(format).load(path)
    return df if limit is None else df.limit(limit)


def with_position(messages: DataFrame) -> DataFrame:
    """Add the order column, a unique whole number that is never null.

    Numeric message ids grow with time and are the order themselves. If any id is not a number, the
    order is that of created_at as text, then id, numbered over sorted ranges, so no task sorts all rows.
    """
    number = F.col("tweet_id").try_cast("long")
    if messages.where(number.isNull()).isEmpty():
        return messages.withColumn(POSITION, number)
    order = ["created_at", "tweet_id"]
    ranges = messages.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(ranges.withColumn(POSITION, F.monotonically_increasing_id()))


def conversations_to_messages(conversations: DataFrame) -> DataFrame:
    """Messages from a (conv_id, turn, role, text) log; every turn answers the turn before it.

    System rows are left out, so a turn after a system row has a parent that is not in the data.
    A turn outside 0 to ``TURNS`` - 1 raises an error, as its id would be that of another message.
    """
    fits = F.col("turn").between(0, TURNS - 1)
    turn = F.when(fits, F.col("turn")).otherwise(F.raise_error(F.lit("turn is out of range")).cast("long"))
    position = F.col("conv_id") * TURNS + turn
    is_reply = F.col("role") == "assistant"
    return conversations.where(F.col("role") != "system").select(
        position.cast("string").alias("tweet_id"),
        F.when(is_reply, F.concat(F.lit("brand"), (F.col("conv_id") % 5).cast("string")))
        .otherwise(F.concat(F.lit("cust"), F.col("conv_id").cast("string")))
        .alias("author_id"),
        (F.col("role") == "user").alias("inbound"),
        F.lit(None).cast("string").alias("created_at"),
        "text",
        F.lit(None).cast("string").alias("response_tweet_id"),
        F.when(F.col("turn") > 0, (position - 1).cast("string")).alias("in_response_to_tweet_id"),
        position.alias(POSITION),
    )
