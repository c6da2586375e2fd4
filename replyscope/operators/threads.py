"""Reply threads from a flat message table.

Messages form reply trees. The walk from a root follows the first reply at each step, at most
20 turns; a root belongs to a brand when one of the brand's messages lies 1 to 11 levels below
it. Both need the way from a message up to its root, so that is computed once for all messages
by path doubling: each round joins paths of length n with paths of length n, and five joins of
narrow id rows cover every depth that matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.operators.ranking import bucket_rank, hash_sample, position_bucket
from replyscope.operators.skew import lookup_join
from replyscope.session import cut_lineage


def reply_edges(messages: DataFrame, order: str = "position") -> DataFrame:
    """(parent_id, child_id, pos): the replies of each message, numbered in ``order``.

    ``order`` is a unique whole-number column. A parent with any number of replies is ranked
    in bounded pieces.
    """
    edges = messages.where(F.col("in_response_to_tweet_id").isNotNull()).select(
        F.col("in_response_to_tweet_id").alias("parent_id"), F.col("tweet_id").alias("child_id"), F.col(order)
    )
    return bucket_rank(edges, ["parent_id"], position_bucket(F.col(order)), [order], "pos").drop(order)


def first_replies(messages: DataFrame, order: str = "position") -> DataFrame:
    """(parent_id, first_child): the earliest reply; partial aggregation happens before the shuffle."""
    return (
        messages.where(F.col("in_response_to_tweet_id").isNotNull())
        .groupBy(F.col("in_response_to_tweet_id").alias("parent_id"))
        .agg(F.min_by("tweet_id", order).alias("first_child"))
    )


def root_candidates(messages: DataFrame) -> DataFrame:
    """Inbound messages whose parent is null or not in the data.

    Messages without a parent need no lookup and stay out of the shuffle.
    """
    parent = F.col("in_response_to_tweet_id")
    present = messages.select(F.col("tweet_id").alias("in_response_to_tweet_id")).distinct()
    inbound = messages.where(F.coalesce("inbound", F.lit(True)))
    replies = inbound.where(parent.isNotNull())
    orphans = lookup_join(replies, present, "in_response_to_tweet_id", "left_anti").select(*messages.columns)
    return inbound.where(parent.isNull()).unionByName(orphans)


def reply_paths(
    messages: DataFrame, order: str = "position", max_depth: int = max(fixed.MAX_TURNS - 1, fixed.MAX_REPLY_LEVEL)
) -> DataFrame:
    """(tweet_id, root_id, depth, on_walk, root_inbound): the way from each message up to its root.

    ``on_walk`` tells whether every step of the way is a first reply. Ways longer than
    ``max_depth`` and ways that end in a cycle are left out. An id listed twice under two
    parents has two ways.
    """
    rows = messages.select(
        "tweet_id",
        F.col("in_response_to_tweet_id").alias("parent_id"),
        F.coalesce("inbound", F.lit(True)).alias("inbound"),
    ).distinct()
    present = messages.select(F.col("tweet_id").alias("parent_id")).distinct()
    parents = first_replies(messages, order).join(present, "parent_id", "left_semi")
    replies = rows.where(F.col("parent_id").isNotNull())
    linked = lookup_join(replies, parents, "parent_id", "left", total=messages.count())
    tops = rows.where(F.col("parent_id").isNull()).withColumn("first_child", F.lit(None).cast("string"))
    is_top = F.col("first_child").isNull()
    paths = cut_lineage(
        linked.unionByName(tops).select(
            "tweet_id",
            F.when(is_top, F.col("tweet_id")).otherwise(F.col("parent_id")).alias("root_id"),
            F.when(is_top, 0).otherwise(1).alias("depth"),
            (is_top | (F.col("first_child") == F.col("tweet_id"))).alias("on_walk"),
            is_top.alias("done"),
            F.when(is_top, F.col("inbound")).alias("root_inbound"),
        )
    )
    reach = 1
    while reach <= max_depth and (open_paths := paths.where(~F.col("done")).count()):
        lower = paths.where(~F.col("done")).select("tweet_id", "root_id", "depth", "on_walk")
        upper = paths.select(
            F.col("tweet_id").alias("root_id"),
            F.col("root_id").alias("_root"),
            F.col("depth").alias("_depth"),
            F.col("on_walk").alias("_on_walk"),
            "done",
            "root_inbound",
        )
        longer = lookup_join(lower, upper, "root_id", total=open_paths).select(
            "tweet_id",
            F.col("_root").alias("root_id"),
            (F.col("depth") + F.col("_depth")).alias("depth"),
            (F.col("on_walk") & F.col("_on_walk")).alias("on_walk"),
            "done",
            "root_inbound",
        )
        paths = cut_lineage(paths.where("done").unionByName(longer.where(F.col("depth") <= max_depth)))
        reach *= 2
    return paths.where("done").drop("done")


def brand_roots(messages: DataFrame, paths: DataFrame, brand: str | None = None) -> DataFrame:
    """(thread_id, brand): inbound roots with a message of the brand 1 to 11 levels below.

    Without a brand every author of an outbound message counts as one.
    """
    own = messages.where(brand_is(brand)) if brand else messages.where(~F.coalesce("inbound", F.lit(True)))
    name = F.lit(brand) if brand else F.col("author_id")
    authors = own.select("tweet_id", name.alias("brand"))
    level = F.col("depth").between(1, fixed.MAX_REPLY_LEVEL)
    return (
        paths.where(F.col("root_inbound") & level)
        .select("tweet_id", F.col("root_id").alias("thread_id"))
        .join(authors, "tweet_id")
        .select("thread_id", "brand")
        .distinct()
    )


def brand_is(brand: str) -> Column:
    return F.lower("author_id") == brand.lower()


def thread_turns(
    messages: DataFrame, paths: DataFrame, roots: DataFrame, order: str = "position", max_turns: int = fixed.MAX_TURNS
) -> DataFrame:
    """(thread_id, turn, tweet_id, ...): the walk from each root, turns numbered from 1."""
    last_rows = messages.groupBy("tweet_id").agg(F.max(order).alias(order))
    steps = (
        paths.where(F.col("root_inbound") & F.col("on_walk") & (F.col("depth") < max_turns))
        .groupBy(F.col("root_id").alias("thread_id"), "tweet_id")
        .agg((F.min("depth") + 1).alias("turn"))
        .join(roots.select("thread_id").distinct(), "thread_id", "left_semi")
        .join(last_rows, "tweet_id")
    )
    content = messages.select(
        "tweet_id", order, "author_id", "text", F.coalesce("inbound", F.lit(True)).alias("inbound"), "created_at"
    )
    return steps.join(content, ["tweet_id", order]).select(
        "thread_id", "turn", "tweet_id", "author_id", "text", "inbound", "created_at"
    )


def threads_from_turns(turns: DataFrame, roots: DataFrame, min_length: int = fixed.MIN_THREAD_LENGTH) -> DataFrame:
    """One row per (thread, brand) with the turn array, first customer text and first reply.

    A group never holds more than the 20 turns of one walk.
    """
    gathered = turns.groupBy("thread_id").agg(
        F.array_sort(
            F.collect_list(F.struct("turn", "tweet_id", "author_id", "text", "inbound", "created_at"))
        ).alias("_turns")
    )
    array = F.transform("_turns", lambda turn: turn.dropFields("turn"))
    first_customer = F.get(F.filter("turns", lambda turn: turn["inbound"]), F.lit(0))["text"]
    first_reply = F.get(F.filter("turns", lambda turn: ~turn["inbound"]), F.lit(0))["text"]
    return (
        gathered.select("thread_id", array.alias("turns"))
        .where(F.size("turns") >= min_length)
        .join(roots, "thread_id")
        .select(
            "thread_id",
            "brand",
            "turns",
            F.coalesce(first_customer, F.get("turns", F.lit(0))["text"]).alias("customer_text"),
            first_reply.alias("brand_reply"),
            F.size("turns").alias("n_turns"),
        )
    )


def reconstruct_threads(
    messages: DataFrame,
    brand: str | None = None,
    min_length: int = fixed.MIN_THREAD_LENGTH,
    sample_size: int | None = None,
    seed: int = fixed.RANDOM_SEED,
    order: str = "position",
) -> DataFrame:
    """Threads of a brand (or of all brands). The root sample is drawn before the length filter."""
    paths = reply_paths(messages, order)
    roots = brand_roots(messages, paths, brand)
    if sample_size:
        chosen = hash_sample(roots.select("thread_id").distinct(), "thread_id", sample_size, seed)
        roots = roots.join(chosen, "thread_id", "left_semi")
    return threads_from_turns(thread_turns(messages, paths, roots, order), roots, min_length)


def resolved(threads: DataFrame, reply: str = "brand_reply") -> DataFrame:
    """Threads with a reply that is present and not blank."""
    return threads.where(F.coalesce(F.col(reply), F.lit("")).rlike(r"(?U)[^\s\x1c-\x1f]"))


def flatten_threads(threads: DataFrame) -> DataFrame:
    """Threads with the turn array as JSON text."""
    return threads.select(
        "thread_id",
        "brand",
        "customer_text",
        "brand_reply",
        "n_turns",
        F.to_json("turns", {"ignoreNullFields": "false"}).alias("turns_json"),
    )


def recent_customer_text(turns: Column, separator: str = " ", n: int = 3) -> Column:
    """The last n customer turns in order; a turn without an inbound flag is the customer's."""
    texts = F.transform(
        F.filter(turns, lambda turn: F.coalesce(turn["inbound"], F.lit(True))), lambda turn: turn["text"]
    )
    return F.array_join(F.slice(texts, F.greatest(F.size(texts) - (n - 1), F.lit(1)), F.lit(n)), separator)
