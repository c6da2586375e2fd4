"""Joins: reply graph, brand counts, retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyscope.catalog import common
from replyscope.catalog.common import CLEAN, MESSAGES, NAMES, THREADS, query, sql_text, table
from replyscope.fixed_values import RANDOM_SEED, TAXONOMY
from replyscope.operators import brands, similarity, threads
from replyscope.operators.labelling import labelling_progress, resume_labels
from replyscope.operators.ranking import hash_sample
from replyscope.operators.tfidf import fit_vocabulary, template_replies
from replyscope.sources.taxonomy import intent_of, with_intent_details


@query(
    "reply_edges",
    f"""WITH {MESSAGES}
SELECT parent AS parent_id, tweet_id AS child_id, row_number() OVER (PARTITION BY parent ORDER BY position) AS pos
FROM messages WHERE parent IS NOT NULL""",
)
def reply_edges(spark, sf_dir):
    return threads.reply_edges(common.messages(spark, sf_dir))


@query("root_candidates", f"WITH RECURSIVE {THREADS} SELECT tweet_id FROM tops")
def root_candidates(spark, sf_dir):
    return threads.root_candidates(common.messages(spark, sf_dir)).select("tweet_id")


@query("brand_roots", f"WITH RECURSIVE {THREADS} SELECT thread_id, brand FROM roots")
def brand_roots(spark, sf_dir):
    return threads.brand_roots(common.messages(spark, sf_dir), common.paths(spark, sf_dir))


@query("thread_walk", f"WITH RECURSIVE {THREADS} SELECT thread_id, CAST(turn AS BIGINT) AS turn, tweet_id FROM turns")
def thread_walk(spark, sf_dir):
    rows, paths = common.messages(spark, sf_dir), common.paths(spark, sf_dir)
    turns = threads.thread_turns(rows, paths, threads.brand_roots(rows, paths))
    return turns.select("thread_id", F.col("turn").cast("long").alias("turn"), "tweet_id")


@query(
    "sent_and_answered",
    f"""WITH {MESSAGES},
sent AS (SELECT author_id, count(*) AS outbound_sent FROM messages WHERE NOT inbound GROUP BY 1),
answered AS (
  SELECT author_id, count(DISTINCT parent) AS threads_with_reply FROM messages
  WHERE NOT inbound AND parent IN (SELECT tweet_id FROM messages WHERE inbound) GROUP BY 1)
SELECT s.author_id, outbound_sent, coalesce(threads_with_reply, 0) AS threads_with_reply
FROM sent s LEFT JOIN answered a ON a.author_id = s.author_id""",
)
def sent_and_answered(spark, sf_dir):
    rows = common.messages(spark, sf_dir)
    joined = brands.outbound_counts(rows).join(brands.answered_counts(rows), "author_id", "left")
    return joined.fillna(0, ["threads_with_reply"])


@query(
    "answering_messages",
    f"""WITH {MESSAGES}
SELECT tweet_id, author_id FROM messages WHERE NOT inbound AND parent IN (SELECT tweet_id FROM messages WHERE inbound)""",
)
def answering_messages(spark, sf_dir):
    return brands.answering_messages(common.messages(spark, sf_dir)).select("tweet_id", "author_id")


@query(
    "held_out_removed",
    f"""WITH RECURSIVE {CLEAN},
golden AS (SELECT thread_id FROM clean ORDER BY md5('42:' || thread_id) LIMIT 20)
SELECT thread_id FROM clean WHERE regexp_matches(brand_reply, '\\S') AND thread_id NOT IN (SELECT thread_id FROM golden)""",
)
def held_out_removed(spark, sf_dir):
    """Retrieval corpus without the threads of a golden sample."""
    rows = common.clean_threads(spark, sf_dir)
    golden = hash_sample(rows.select("thread_id"), "thread_id", 20, RANDOM_SEED)
    return similarity.without_held_out(threads.resolved(rows), golden).select("thread_id")


DETAILS = (
    "names AS (SELECT unnest([" + ", ".join(str(i) for i in range(len(TAXONOMY))) + "]) AS intent_id, "
    f"unnest({NAMES}) AS intent, unnest([" + ", ".join(sql_text(row[1]) for row in TAXONOMY) + "]) AS description, "
    "unnest([" + ", ".join(str(row[3]).lower() for row in TAXONOMY) + "]) AS denied)"
)


@query(
    "intent_details",
    f"""WITH {DETAILS},
rows AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN 'something_else' ELSE {NAMES}[label + 1] END AS intent FROM embeddings)
SELECT r.vec_id, r.intent, CAST(n.intent_id AS BIGINT) AS intent_id, coalesce(n.description, '') AS description, n.denied
FROM rows r LEFT JOIN names n ON n.intent = r.intent""",
)
def intent_details(spark, sf_dir):
    name = F.when(F.col("vec_id") % 7 == 0, "something_else").otherwise(intent_of(F.col("label")))
    rows = with_intent_details(common.vectors(spark, sf_dir).select("vec_id", name.alias("intent")))
    return rows.select(
        "vec_id",
        "intent",
        F.col("intent_id").cast("long").alias("intent_id"),
        "description",
        F.col("escalation_denylist").alias("denied"),
    )


def label_work(spark, sf_dir):
    """A work list and the labels of an earlier session: some empty, each entered twice, the second time for good."""
    number = F.col("vec_id")
    work = common.vectors(spark, sf_dir).select(
        "vec_id", F.when(number % 5 == 0, "delivery_problem").otherwise("").alias("human_intent")
    )
    done = (number % 2 == 0) & (number % 6 != 0)
    entered = common.vectors(spark, sf_dir).withColumn("position", F.explode(F.array(F.lit(1), F.lit(2))))
    name = F.when(F.col("position") == 2, intent_of(F.col("label"))).otherwise("withdrawn")
    earlier = entered.select("vec_id", "position", F.when(done, name).otherwise("").alias("human_intent"))
    return work, earlier


RESUMED = f"""resumed AS (
  SELECT vec_id, CASE WHEN vec_id % 2 = 0 AND vec_id % 6 <> 0 THEN {NAMES}[label + 1]
                      WHEN vec_id % 5 = 0 THEN 'delivery_problem' ELSE '' END AS human_intent FROM embeddings)"""


@query("resumed_labels", f"WITH {RESUMED} SELECT vec_id, human_intent FROM resumed")
def resumed_labels(spark, sf_dir):
    return resume_labels(*label_work(spark, sf_dir), "vec_id")


@query(
    "labelling_progress",
    f"""WITH {RESUMED}
SELECT count(*) AS n_total, count(*) FILTER (WHERE human_intent <> '') AS n_done,
       count(*) FILTER (WHERE human_intent = '') AS n_remaining FROM resumed""",
)
def progress(spark, sf_dir):
    return labelling_progress(resume_labels(*label_work(spark, sf_dir), "vec_id"))


@query(
    "aligned_predictions",
    f"""WITH {common.PREDICTIONS}
SELECT l.doc_id, l.quality, p.intent, p.confidence FROM labels l JOIN predictions p ON p.vec_id = l.doc_id""",
)
def aligned_predictions(spark, sf_dir):
    """Human rows and predictions joined by key."""
    human = table(spark, sf_dir, "labels").select("doc_id", "quality")
    found = common.predictions(spark, sf_dir).select(F.col("vec_id").alias("doc_id"), "intent", "confidence")
    return human.join(found, "doc_id")


@query(
    "top_k_vectors",
    """WITH pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS match_id,
         round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 6) AS similarity
  FROM embeddings q, embeddings c)
SELECT query_id, match_id, similarity, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, match_id) AS rank
FROM pairs QUALIFY rank <= 5""",
)
def top_k_vectors(spark, sf_dir):
    rows = common.vectors(spark, sf_dir)
    found = similarity.knn(
        rows.withColumnRenamed("vec_id", "query_id"), rows.withColumnRenamed("vec_id", "match_id"), corpus_key="match_id"
    )
    return found.withColumn("rank", F.col("rank").cast("long"))


@query(
    "thread_retrieval",
    f"""WITH RECURSIVE {CLEAN},
corpus AS (SELECT c.thread_id, e.embedding FROM clean c JOIN embeddings e ON e.vec_id = CAST(c.thread_id AS BIGINT) // 1000000
           WHERE regexp_matches(c.brand_reply, '\\S')),
pairs AS (
  SELECT q.vec_id, c.thread_id,
         round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 6) AS similarity
  FROM embeddings q, corpus c)
SELECT vec_id, thread_id, similarity, row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, thread_id) AS rank
FROM pairs QUALIFY rank <= 3""",
)
def thread_retrieval(spark, sf_dir):
    """Every vector against the resolved threads, text keys, k = 3."""
    corpus = threads.resolved(common.thread_vectors(spark, sf_dir))
    found = similarity.knn(common.vectors(spark, sf_dir), corpus, 3, query_key="vec_id")
    return found.withColumn("rank", F.col("rank").cast("long"))


TERMS = """singles AS (
  SELECT key, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS w FROM texts),
grams AS (
  SELECT key, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM singles),
counts AS (SELECT key, term, count(*) AS tf FROM grams GROUP BY 1, 2)"""


@query(
    "template_reply",
    f"""WITH RECURSIVE {CLEAN},
texts AS (SELECT 'q' || tweet_id AS key, text FROM messages WHERE inbound
          UNION ALL SELECT 'd' || thread_id, customer_text FROM clean WHERE regexp_matches(brand_reply, '\\S')),
{TERMS},
fitted AS (SELECT term, count(*) AS df, sum(tf) AS total FROM counts WHERE key LIKE 'q%' GROUP BY 1 HAVING count(*) >= 2),
vocabulary AS (
  SELECT term, ln((1.0 + (SELECT count(*) FROM messages WHERE inbound)) / (1.0 + df)) + 1 AS idf
  FROM fitted ORDER BY total DESC, term LIMIT 30000),
raw AS (SELECT key, c.term, (1 + ln(tf)) * idf AS w FROM counts c JOIN vocabulary v ON v.term = c.term),
unit AS (SELECT key, term, w / sqrt(sum(w * w) OVER (PARTITION BY key)) AS w FROM raw),
scored AS (
  SELECT q.key AS qk, d.key AS dk, round(sum(q.w * d.w), 6) AS similarity FROM unit q JOIN unit d ON d.term = q.term
  WHERE q.key LIKE 'q%' AND d.key LIKE 'd%' GROUP BY 1, 2),
best AS (SELECT *, row_number() OVER (PARTITION BY qk ORDER BY similarity DESC, dk) AS r FROM scored WHERE similarity > 0),
answers AS (
  SELECT m.tweet_id, coalesce(substring(b.dk, 2), (SELECT min(thread_id) FROM clean WHERE regexp_matches(brand_reply, '\\S'))) AS thread_id,
         coalesce(b.similarity, 0.0) AS similarity
  FROM messages m LEFT JOIN best b ON b.qk = 'q' || m.tweet_id AND b.r = 1 WHERE m.inbound)
SELECT a.tweet_id, a.thread_id, a.similarity, md5(c.brand_reply) AS digest FROM answers a JOIN clean c ON c.thread_id = a.thread_id""",
)
def template_reply(spark, sf_dir):
    """Every customer message with the reply given to the most similar resolved message."""
    asked = brands.inbound(common.messages(spark, sf_dir)).select("tweet_id", "text")
    pairs = threads.resolved(common.clean_threads(spark, sf_dir))
    vocabulary = fit_vocabulary(asked, "tweet_id", "text")
    found = template_replies(asked, "tweet_id", "text", pairs, vocabulary)
    return found.select("tweet_id", "thread_id", "similarity", F.md5("draft_reply").alias("digest"))


@query(
    "near_duplicate_vectors",
    """SELECT a.vec_id, min(b.vec_id) AS duplicate_of FROM embeddings a JOIN embeddings b ON b.vec_id < a.vec_id
WHERE round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) > 0.4 GROUP BY 1""",
)
def near_duplicate_vectors(spark, sf_dir):
    """Vectors that resemble one of lower id; the test vectors are random, so the cut is low."""
    return similarity.near_duplicates(common.vectors(spark, sf_dir), "vec_id", threshold=0.4)


@query(
    "vectors_without_near_duplicates",
    """SELECT a.vec_id FROM embeddings a WHERE NOT EXISTS (SELECT 1 FROM embeddings b WHERE b.vec_id < a.vec_id
AND round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) > 0.4)""",
)
def vectors_without_near_duplicates(spark, sf_dir):
    return similarity.without_near_duplicates(common.vectors(spark, sf_dir), "vec_id", threshold=0.4).select("vec_id")
