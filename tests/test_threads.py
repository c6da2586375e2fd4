import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from replyscope.operators import skew, threads

SCHEMA = (
    "tweet_id string, author_id string, inbound boolean, created_at string, text string, "
    "response_tweet_id string, in_response_to_tweet_id string, position long"
)


def table(spark, rows):
    """rows: (id, author, inbound, parent)"""
    full = [(i, a, inbound, None, f"text {i} {n}", None, parent, n) for n, (i, a, inbound, parent) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def expected_threads(rows, brand, min_length=2):
    """The definition, message by message."""
    children, last = defaultdict(list), {}
    for n, (i, author, inbound, parent) in enumerate(rows):
        last[i] = (n, author, inbound)
        if parent is not None:
            children[parent].append(i)
    ids = set(last)
    own = {i for i, author, _, _ in rows if author.lower() == brand.lower()}

    def answered(i, level=1):
        return level <= 11 and any(c in own or answered(c, level + 1) for c in children[i])

    found = {}
    for i, _, inbound, parent in rows:
        if inbound and (parent is None or parent not in ids) and answered(i):
            walk, current = [], i
            while current is not None and len(walk) < 20 and current not in walk:
                walk.append(current)
                current = children[current][0] if children[current] else None
            if len(walk) >= min_length:
                found[i] = walk
    return found


def walks(df):
    return {row.thread_id: [turn.tweet_id for turn in row.turns] for row in df.collect()}


def chain(prefix, length, brand_at):
    rows = []
    for n in range(length):
        parent = f"{prefix}{n - 1}" if n else None
        rows.append((f"{prefix}{n}", "Acme" if n in brand_at else f"c{prefix}", n not in brand_at, parent))
    return rows


CASES = {
    "two children": [("1", "c", True, None), ("2", "x", True, "1"), ("3", "Acme", False, "1")],
    "parent absent": [("2", "c", True, "1"), ("3", "acme", False, "2")],
    "no brand reply": [("1", "c", True, None), ("2", "other", False, "1")],
    "outbound root": [("1", "Acme", False, None), ("2", "c", True, "1"), ("3", "Acme", False, "2")],
    "cycle": [("1", "c", True, "3"), ("2", "Acme", False, "1"), ("3", "c", True, "2")],
    "cycle below a root": [("0", "c", True, None), ("1", "Acme", False, "0"), ("2", "c", True, "1"), ("1", "Acme", False, "2")],
    "25 turns": chain("a", 25, {1}),
    "reply at level 11": chain("b", 14, {11}),
    "reply at level 12": chain("c", 14, {12}),
    "duplicate id": [("1", "c", True, None), ("2", "Acme", False, "1"), ("2", "Acme", False, "1"), ("3", "c", True, "2")],
    "id under two parents": [("1", "c", True, None), ("2", "d", True, None), ("3", "Acme", False, "1"), ("3", "Acme", False, "2")],
    "self reply": [("1", "c", True, "1"), ("2", "Acme", False, "1")],
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    rows = CASES[name]
    assert walks(threads.reconstruct_threads(table(spark, rows), "ACME")) == expected_threads(rows, "acme")


def forest(seed, n=400):
    random.seed(seed)
    rows = []
    for i in range(n):
        # A third of all messages answer the same message
        parent = "0" if i and random.random() < 0.33 else (str(random.randrange(i)) if i and random.random() < 0.8 else None)
        if parent is None and random.random() < 0.3:
            parent = f"gone{i}"
        outbound = random.random() < 0.4
        rows.append((str(i), "Acme" if outbound and random.random() < 0.7 else f"u{i % 9}", not outbound, parent))
    return rows


def test_random_forest_with_a_hot_message(spark, monkeypatch):
    rows = forest(1)
    expected = expected_threads(rows, "acme")
    plain = threads.reconstruct_threads(table(spark, rows), "acme")
    assert walks(plain) == expected
    monkeypatch.setattr(skew, "HOT_ROWS", 20)
    shuffled = table(spark, rows).orderBy(F.rand(3)).repartition(7)
    assert walks(threads.reconstruct_threads(shuffled, "acme")) == expected


def test_texts_and_order(spark):
    rows = [("1", "Acme", False, "9"), ("2", "c", True, "x"), ("3", "Acme", False, "2"), ("4", "c", True, "3")]
    row = threads.reconstruct_threads(table(spark, rows)).first()
    assert (row.thread_id, row.brand, row.customer_text, row.brand_reply, row.n_turns) == ("2", "Acme", "text 2 1", "text 3 2", 3)
    assert all(len(t.turns) <= 20 for t in threads.reconstruct_threads(table(spark, CASES["25 turns"])).collect())


def test_unanswered_branch_keeps_the_root(spark):
    row = threads.reconstruct_threads(table(spark, CASES["two children"]), "acme").first()
    assert row.brand_reply is None and threads.resolved(threads.reconstruct_threads(table(spark, CASES["two children"]))).isEmpty()


def test_reply_edges_across_buckets(spark, monkeypatch):
    from replyscope.operators import ranking

    monkeypatch.setattr(ranking, "BUCKET_WIDTH", 16)
    rows = forest(2)
    children = defaultdict(list)
    for i, _, _, parent in rows:
        if parent is not None:
            children[parent].append(i)
    found = {(row.parent_id, row.child_id): row.pos for row in threads.reply_edges(table(spark, rows)).collect()}
    assert found == {(p, c): n for p, cs in children.items() for n, c in enumerate(cs, 1)}


def test_sample_is_fixed_and_before_the_length_filter(spark):
    rows = table(spark, forest(3))
    first = threads.reconstruct_threads(rows, "acme", sample_size=10)
    second = threads.reconstruct_threads(rows.repartition(5), "acme", sample_size=10)
    assert walks(first) == walks(second) and first.count() <= 10


def test_recent_text(spark):
    turns = "array<struct<text:string,inbound:boolean>>"
    rows = spark.createDataFrame([([("a", True), ("b", False), ("c", None), ("d", True), ("e", True)],)], f"turns {turns}")
    assert rows.select(threads.recent_customer_text(F.col("turns")).alias("t")).first().t == "c d e"
    assert rows.select(threads.recent_customer_text(F.col("turns"), " [SEP] ").alias("t")).first().t == "c [SEP] d [SEP] e"


def test_text_ids_lose_no_row(spark):
    """The same two messages give the same thread whether their ids are numbers or not."""
    from replyscope.operators.threads import reconstruct_threads
    from replyscope.sources.messages import MESSAGE_SCHEMA, with_position

    for first, second in (("1", "2"), ("a1", "a2"), ("b9", "a2")):
        rows = [
            (first, "cust", True, "2020-01-01 00:00", "help", second, None),
            (second, "brand", False, "2020-01-01 00:01", "sure", None, first),
        ]
        messages = with_position(spark.createDataFrame(rows, MESSAGE_SCHEMA))
        assert messages.where("position is null").count() == 0
        (thread,) = reconstruct_threads(messages).collect()
        assert thread["thread_id"] == first and len(thread["turns"]) == 2


def test_long_conversations_keep_their_ids_apart(spark):
    from replyscope.sources.messages import conversations_to_messages

    rows = [(1, turn, "user", "x") for turn in range(101)] + [(2, 0, "user", "y")]
    found = conversations_to_messages(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert found.select("tweet_id").distinct().count() == 102
