"""Jobs that start from messages alone: weak labels, stored vectors, triage in batch and on a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.catalog import common
from replyscope.catalog.common import CLEAN, MESSAGES, query, sql_redact
from replyscope.catalog.models import LETTERS, letter_model
from replyscope.catalog.tables import sql_detected, sql_profiles
from replyscope.catalog.texts import BATCHED, label_answers
from replyscope.catalog.whole_jobs import CONFIDENCE, sql_rules, template_draft
from replyscope.functions.language import language_detector, language_profiles
from replyscope.functions.text import hash_key
from replyscope.operators.encoder import encode_with
from replyscope.operators.ranking import hash_sample
from replyscope.plans import jobs
from replyscope.plans.bundle import fit_bundle
from replyscope.session import scratch_path
from replyscope.sources.messages import conversations_to_messages
from replyscope.sources.vectors import write_index
from replyscope.streaming.triage import message_stream, start_triage

SAMPLE, HELD_OUT, SIMILARITY = 150, 20, 0.97

MESSAGE_GRAMS = """message_grams AS (
  SELECT tweet_id, substring(t, CAST(i AS BIGINT), 3) AS gram
  FROM (SELECT tweet_id, lower(asked) AS t, unnest(range(1, length(asked) - 1)) AS i FROM inquiries))"""


def taught(spark, sf_dir):
    return common.documents(spark, sf_dir, "text", "lang")


@query(
    "language_accuracy_unseen",
    f"""WITH {sql_profiles("substring(md5('42:' || doc_id), 1, 1) NOT IN ('0', '1', '2', '3')")},
{sql_detected('doc_id', 'grams')}
SELECT d.lang, count(*) AS n, sum(CAST(coalesce(x.detected, 'en') = d.lang AS BIGINT))::BIGINT AS n_right
FROM documents d LEFT JOIN detected x ON x.doc_id = d.doc_id WHERE substring(md5('42:' || d.doc_id), 1, 1) IN ('0', '1', '2', '3') GROUP BY 1""",
)
def language_accuracy_unseen(spark, sf_dir):
    """Accuracy on a quarter of the documents, by profiles that only the others taught."""
    docs = common.documents(spark, sf_dir, "doc_id", "text", "lang")
    unseen = F.substring(hash_key(F.col("doc_id"), fixed.RANDOM_SEED), 1, 1).isin("0", "1", "2", "3")
    detect = language_detector(language_profiles(docs.where(~unseen), "text", "lang"))
    found = docs.where(unseen).select("lang", detect("text").alias("detected"))
    right = F.coalesce("detected", F.lit("en")) == F.col("lang")
    return found.groupBy("lang").agg(F.count("*").alias("n"), F.sum(right.cast("long")).alias("n_right"))


@query(
    "weak_labels_of_sample",
    f"""WITH {MESSAGES},
inquiries AS (
  SELECT tweet_id, position, text, coalesce(text, '') AS asked FROM messages WHERE inbound ORDER BY md5('42:' || tweet_id), tweet_id LIMIT {SAMPLE}),
{sql_profiles()},
{MESSAGE_GRAMS},
{sql_detected('tweet_id', 'message_grams')},
placed AS (
  SELECT i.*, row_number() OVER (ORDER BY position) - 1 AS place FROM inquiries i LEFT JOIN detected d ON d.tweet_id = i.tweet_id
  WHERE coalesce(d.detected, 'en') = 'en'),
{BATCHED[BATCHED.index("batched AS"):]}
SELECT tweet_id, md5(text) AS digest, l.intent FROM labelled l JOIN batched b USING (tweet_id) WHERE l.intent IS NOT NULL""",
)
def weak_labels_of_sample(spark, sf_dir):
    """A seeded sample of all customer messages, English ones only, labelled in batches."""
    rows = common.messages(spark, sf_dir).where("inbound").select("tweet_id", "position", "text")
    detect = language_detector(language_profiles(taught(spark, sf_dir), "text", "lang"))
    found, _, _ = jobs.weak_labels(rows, label_answers, "position", n_samples=SAMPLE, detect=detect)
    return found.select("tweet_id", F.md5("text").alias("digest"), "intent")


def letters(df, text):
    """The vector of letter shares, in place of a sentence model."""
    return encode_with(df, text, letter_model)


def sql_letters(source: str, text: str, columns: str) -> str:
    """Rows of a table with the vector of letter shares, in single precision as stored."""
    counts = LETTERS.replace("text", text)
    return f"""(SELECT {columns}, list_transform(c, lambda x: CAST(CASE WHEN s > 0 THEN x / s ELSE 0 END AS FLOAT)) AS vector
  FROM (SELECT *, sqrt(list_sum(list_transform(c, lambda x: x * x))) AS s FROM (SELECT *, [{counts}] AS c FROM {source})))"""


CORPUS = f"""golden AS (SELECT thread_id FROM clean ORDER BY md5('42:' || thread_id), thread_id LIMIT {HELD_OUT}),
resolved_pairs AS (
  SELECT * FROM clean WHERE regexp_matches(brand_reply, '\\S') AND thread_id NOT IN (SELECT thread_id FROM golden)),
corpus AS {sql_letters("resolved_pairs", "customer_text", "thread_id, customer_text, brand_reply")}"""


def held_out(rows):
    return hash_sample(rows.select("thread_id"), "thread_id", HELD_OUT, fixed.RANDOM_SEED)


@query(
    "stored_retrieval_index",
    f"""WITH RECURSIVE {CLEAN},
{CORPUS}
SELECT thread_id, md5(customer_text) AS digest, CAST(len(vector) AS BIGINT) AS dim,
       round(CAST(vector[1] AS DOUBLE), 5) AS first_value, round(CAST(vector[8] AS DOUBLE), 5) AS last_value FROM corpus""",
)
def stored_retrieval_index(spark, sf_dir):
    """Threads to resolved pairs, to vectors, to an index stored by cell, read back."""
    rows = common.clean_threads(spark, sf_dir)
    pairs = jobs.retrieval_table(rows, held_out(rows), lambda kept: letters(kept, "customer_text"))
    index = write_index(pairs, scratch_path(spark, "index"))
    value = lambda i: F.round(F.get("embedding", F.lit(i)).cast("double"), 5)
    return index.rows().select(
        "thread_id",
        F.md5("customer_text").alias("digest"),
        F.size("embedding").cast("long").alias("dim"),
        value(0).alias("first_value"),
        value(7).alias("last_value"),
    )


RULES = sql_rules(CONFIDENCE, SIMILARITY).replace("list_filter([", "list_filter([CASE WHEN detected <> 'en' THEN 'non_english' END, ", 1)

FROM_TEXT = f"""WITH RECURSIVE {CLEAN},
{BATCHED[len(MESSAGES) + 2:]},
{CORPUS},
inquiries AS (SELECT tweet_id, {sql_redact('text')} AS asked FROM messages WHERE inbound),
asked_vectors AS {sql_letters("inquiries", "asked", "tweet_id, asked")},
pairs AS (
  SELECT a.tweet_id, c.thread_id AS match_id, l.intent,
         coalesce(round(list_cosine_similarity(CAST(a.vector AS DOUBLE[]), CAST(c.vector AS DOUBLE[])), 6), 0) AS similarity
  FROM asked_vectors a CROSS JOIN corpus c LEFT JOIN labelled l ON l.tweet_id = c.thread_id),
nearest AS (
  SELECT *, row_number() OVER (PARTITION BY tweet_id ORDER BY similarity DESC, match_id) AS rank FROM pairs QUALIFY rank <= 5),
sums AS (SELECT tweet_id, intent, sum(greatest(similarity, 0)) AS s FROM nearest WHERE intent IS NOT NULL GROUP BY 1, 2),
shares AS (SELECT tweet_id, intent, round(coalesce(s / nullif(sum(s) OVER (PARTITION BY tweet_id), 0), 0), 6) AS score FROM sums),
voted AS (SELECT * FROM shares QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY score DESC, intent) = 1),
{sql_profiles()},
{MESSAGE_GRAMS},
{sql_detected('tweet_id', 'message_grams')},
signals AS (
  SELECT i.tweet_id, i.asked AS message, v.intent, coalesce(v.score, 0) AS confidence, n.similarity, 0.0 AS urgency, d.detected
  FROM inquiries i LEFT JOIN voted v ON v.tweet_id = i.tweet_id LEFT JOIN nearest n ON n.tweet_id = i.tweet_id AND n.rank = 1
  LEFT JOIN detected d ON d.tweet_id = i.tweet_id),
ruled AS (SELECT *, {RULES} AS rules FROM signals)
SELECT tweet_id, md5(message) AS digest, intent, CAST(round_even(confidence, 4) AS DOUBLE) AS confidence,
       CAST(round_even(similarity, 3) AS DOUBLE) AS top_similarity,
       CASE WHEN len(rules) > 0 THEN 'escalate' ELSE 'auto_handle' END AS decision, array_to_string(rules, ',') AS rules FROM ruled"""


def letter_bundle(spark, sf_dir):
    """A bundle fitted on the conversations: their threads, and weak labels of the first messages."""
    rows = common.clean_threads(spark, sf_dir)
    asked = common.messages(spark, sf_dir).where("inbound").select("tweet_id", "position", "text")
    weak, _, _ = jobs.weak_labels(asked, label_answers, "position")
    labels = weak.select(F.col("tweet_id").alias("thread_id"), "intent")
    return fit_bundle(
        rows,
        scratch_path(spark, "bundle"),
        labels=labels,
        held_out=held_out(rows),
        languages=taught(spark, sf_dir),
        encode=letters,
        classifier=False,
    )


def decided(bundle, messages):
    rows = messages.where("inbound").select("tweet_id", "text")
    options = dict(confidence_threshold=CONFIDENCE, similarity_threshold=SIMILARITY)
    return bundle.triage(rows, template_draft, "tweet_id", "text", **options).select(
        "tweet_id",
        F.md5("message").alias("digest"),
        "intent",
        "confidence",
        F.get("retrieved_examples", F.lit(0))["similarity"].alias("top_similarity"),
        "decision",
        F.array_join("triggered_rules", ",").alias("rules"),
    )


@query("triage_from_text", FROM_TEXT)
def triage_from_text(spark, sf_dir):
    """Every customer message to a decision by a bundle fitted on the conversations."""
    return decided(letter_bundle(spark, sf_dir), common.messages(spark, sf_dir))


@query("streamed_triage_from_text", FROM_TEXT)
def streamed_triage_from_text(spark, sf_dir):
    """The same decisions on a stream."""
    bundle = letter_bundle(spark, sf_dir)
    output = scratch_path(spark, "triaged")
    stream = message_stream(spark, f"{sf_dir}/conversations*.parquet", "conv_id long, turn long, role string, text string")
    handle = lambda batch: decided(bundle, conversations_to_messages(batch))
    start_triage(stream, handle, output, scratch_path(spark, "stream")).awaitTermination()
    return spark.read.parquet(output).drop("batch")
