"""Ranks, batches, top rows and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.catalog import common
from replyscope.catalog.aggregates import STATS
from replyscope.catalog.common import MESSAGES, NEIGHBOURS, PREDICTIONS, THREADS, query, sql_redact
from replyscope.functions.prompts import history_text
from replyscope.operators import brands, classify, labelling, similarity, threads
from replyscope.operators.metrics import seen_labels
from replyscope.operators.ranking import hash_sample
from replyscope.operators.sampling import group_samples
from replyscope.plans.jobs import brand_report


@query(
    "first_replies",
    f"""WITH {MESSAGES}
SELECT parent AS parent_id, arg_min(tweet_id, position) AS first_child FROM messages WHERE parent IS NOT NULL GROUP BY 1""",
)
def first_replies(spark, sf_dir):
    return threads.first_replies(common.messages(spark, sf_dir))


CLEAN_TURNS = f"""{THREADS},
clean_turns AS (
  SELECT t.thread_id, t.turn, t.inbound, {sql_redact('t.text')} AS text, r.brand
  FROM turns t JOIN threads r ON r.thread_id = t.thread_id)"""


@query(
    "turn_numbers",
    f"""WITH RECURSIVE {CLEAN_TURNS}
SELECT thread_id, CAST(turn AS BIGINT) AS turn, inbound, md5(text) AS digest, count(*) OVER (PARTITION BY thread_id) AS n_turns
FROM clean_turns""",
)
def turn_numbers(spark, sf_dir):
    rows = common.clean_threads(spark, sf_dir).select("thread_id", "n_turns", F.posexplode("turns").alias("place", "turn"))
    return rows.select(
        "thread_id",
        (F.col("place") + 1).cast("long").alias("turn"),
        "turn.inbound",
        F.md5("turn.text").alias("digest"),
        F.col("n_turns").cast("long").alias("n_turns"),
    )


@query(
    "first_texts",
    f"WITH RECURSIVE {THREADS} SELECT thread_id, md5(customer_text) AS customer_digest, md5(brand_reply) AS reply_digest FROM threads",
)
def first_texts(spark, sf_dir):
    """First customer text and first reply of each thread, before redaction."""
    rows, paths = common.messages(spark, sf_dir), common.paths(spark, sf_dir)
    roots = threads.brand_roots(rows, paths)
    found = threads.threads_from_turns(threads.thread_turns(rows, paths, roots), roots)
    return found.select("thread_id", F.md5("customer_text").alias("customer_digest"), F.md5("brand_reply").alias("reply_digest"))


@query(
    "recent_customer_text",
    f"""WITH RECURSIVE {CLEAN_TURNS},
last_three AS (
  SELECT thread_id, turn, text FROM clean_turns WHERE inbound
  QUALIFY row_number() OVER (PARTITION BY thread_id ORDER BY turn DESC) <= 3)
SELECT thread_id, md5(string_agg(text, ' ' ORDER BY turn)) AS query_digest, md5(string_agg(text, ' [SEP] ' ORDER BY turn)) AS context_digest
FROM last_three GROUP BY 1""",
)
def recent_customer_text(spark, sf_dir):
    turns = F.col("turns")
    return common.clean_threads(spark, sf_dir).select(
        "thread_id",
        F.md5(threads.recent_customer_text(turns)).alias("query_digest"),
        F.md5(threads.recent_customer_text(turns, " [SEP] ")).alias("context_digest"),
    )


@query(
    "conversation_history",
    f"""WITH RECURSIVE {CLEAN_TURNS},
last_six AS (
  SELECT thread_id, turn, CASE WHEN inbound THEN 'Customer' ELSE brand END || ': ' || text AS line FROM clean_turns
  QUALIFY row_number() OVER (PARTITION BY thread_id ORDER BY turn DESC) <= 6)
SELECT thread_id, md5(string_agg(line, chr(10) ORDER BY turn)) AS digest FROM last_six GROUP BY 1""",
)
def conversation_history(spark, sf_dir):
    rows = common.clean_threads(spark, sf_dir)
    return rows.select("thread_id", F.md5(history_text(F.col("turns"), F.col("brand"))).alias("digest"))


@query("retrieval_ranks", f"WITH {NEIGHBOURS} SELECT vec_id, match_id, rank FROM neighbours")
def retrieval_ranks(spark, sf_dir):
    """Ranks of retrieved rows, from similarities alone."""
    rows = common.neighbours(spark, sf_dir).drop("rank")
    return rows.select("vec_id", "match_id", similarity.similarity_rank("vec_id", "match_id").cast("long").alias("rank"))


@query("top_two_gap", f"WITH {PREDICTIONS} SELECT vec_id, top2_gap FROM predictions")
def top_two_gap(spark, sf_dir):
    found = classify.best_label(common.scores(spark, sf_dir), "vec_id")
    return found.select("vec_id", F.round("top2_gap", 6).alias("top2_gap"))


@query("best_class", f"WITH {PREDICTIONS} SELECT vec_id, intent, confidence FROM predictions")
def best_class(spark, sf_dir):
    return classify.best_label(common.scores(spark, sf_dir), "vec_id").drop("top2_gap")


@query(
    "input_batches",
    f"""WITH {MESSAGES}, placed AS (SELECT tweet_id, row_number() OVER (ORDER BY position) - 1 AS place FROM messages)
SELECT tweet_id, place // 20 AS batch, CAST(place % 20 + 1 AS INT) AS index FROM placed""",
)
def input_batches(spark, sf_dir):
    rows = common.messages(spark, sf_dir).select("tweet_id", "position")
    return labelling.in_batches(rows, "position").drop("position")


@query("busiest_brands", f"WITH {STATS} SELECT brand, outbound_sent FROM stats ORDER BY outbound_sent DESC, brand LIMIT 3")
def busiest_brands(spark, sf_dir):
    return brands.brand_stats(common.messages(spark, sf_dir), top_n=3).select("brand", "outbound_sent")


@query("recommended_brand", f"WITH {STATS} SELECT * FROM stats ORDER BY outbound_sent DESC, brand LIMIT 1")
def recommended_brand(spark, sf_dir):
    return brands.recommended_brand(brands.brand_stats(common.messages(spark, sf_dir)))


@query(
    "completeness_bands",
    f"""WITH {STATS}
SELECT brand, CASE WHEN thread_completeness_pct >= 60 THEN 'green' WHEN thread_completeness_pct >= 30 THEN 'yellow' ELSE 'red' END AS band
FROM stats""",
)
def completeness_bands(spark, sf_dir):
    return brand_report(common.messages(spark, sf_dir)).select("brand", "band")


@query("first_messages", f"WITH {MESSAGES} SELECT tweet_id, position FROM messages ORDER BY position LIMIT 10")
def first_messages(spark, sf_dir):
    """The first ten messages, the default size of a trial run."""
    return common.messages(spark, sf_dir).orderBy("position").limit(10).select("tweet_id", "position")


@query(
    "label_ranking",
    f"""WITH {PREDICTIONS}, counts AS (SELECT intent, count(*) AS n FROM predictions GROUP BY 1)
SELECT intent, n, row_number() OVER (ORDER BY n DESC, intent) AS place FROM counts""",
)
def label_ranking(spark, sf_dir):
    """Labels by falling frequency."""
    counts = labelling.label_distribution(common.predictions(spark, sf_dir).select("intent"))
    # One row per taxonomy name
    return counts.selectExpr("intent", "n", "cast(row_number() over (order by n desc, intent) as bigint) as place")


@query(
    "capped_sample",
    f"WITH {PREDICTIONS} SELECT vec_id, intent FROM predictions ORDER BY md5('42:' || vec_id), vec_id LIMIT 200",
)
def capped_sample(spark, sf_dir):
    """Sample cut at the target size after a fixed order."""
    return hash_sample(common.predictions(spark, sf_dir), "vec_id", fixed.GOLDEN_TARGET, fixed.RANDOM_SEED).select("vec_id", "intent")


PARTS = f"""{PREDICTIONS},
edges AS (SELECT vec_id FROM predictions WHERE top2_gap < 0.02 ORDER BY md5('42:' || vec_id), vec_id LIMIT 40),
classes AS (
  SELECT vec_id FROM predictions QUALIFY row_number() OVER (PARTITION BY intent ORDER BY md5('42:' || vec_id), vec_id) <= 15)"""


def sample_parts(spark, sf_dir):
    rows = common.predictions(spark, sf_dir)
    edges = hash_sample(rows.where(F.col("top2_gap") < 0.02), "vec_id", 40, fixed.RANDOM_SEED).select("vec_id")
    return edges, group_samples(rows, "vec_id", "intent", 15).select("vec_id")


@query("sample_union", f"WITH {PARTS} SELECT vec_id FROM edges UNION SELECT vec_id FROM classes")
def sample_union(spark, sf_dir):
    edges, classes = sample_parts(spark, sf_dir)
    return edges.unionByName(classes).dropDuplicates(["vec_id"])


@query("sample_difference", f"WITH {PARTS} SELECT vec_id FROM predictions WHERE vec_id NOT IN (SELECT vec_id FROM edges)")
def sample_difference(spark, sf_dir):
    edges, _ = sample_parts(spark, sf_dir)
    return common.predictions(spark, sf_dir).select("vec_id").join(edges, "vec_id", "left_anti")


@query("seen_labels", f"WITH {PREDICTIONS} SELECT truth AS label FROM predictions UNION SELECT intent FROM predictions")
def labels_seen(spark, sf_dir):
    return seen_labels(common.predictions(spark, sf_dir), "truth", "intent")
