"""Scans, sinks, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.catalog import common
from replyscope.catalog.common import CLEAN, MESSAGES, NAMES, PREDICTIONS, THREADS, query, sql_redact, table
from replyscope.functions.gate import escalation_gate
from replyscope.functions.language import keep_language, language_detector, language_profiles
from replyscope.functions.redaction import redact
from replyscope.functions.text import word_count
from replyscope.operators import brands, metrics
from replyscope.operators.sampling import edge_flags
from replyscope.operators.threads import resolved
from replyscope.plans.jobs import compact_examples, long_form, nested_examples, nested_report
from replyscope.session import scratch_path
from replyscope.sources import sinks, vectors
from replyscope.sources.messages import MESSAGE_SCHEMA, load_messages
from replyscope.sources.taxonomy import intent_of, known_intents, taxonomy

@query(
    "scan_messages",
    f"""WITH {MESSAGES}
SELECT tweet_id, author_id, inbound, md5(text) AS digest, length(text) AS n_chars, parent AS in_response_to_tweet_id
FROM messages""",
)
def scan_messages(spark, sf_dir):
    """Messages written as CSV and scanned with the explicit schema."""
    path = scratch_path(spark, "messages")
    columns = [field.split()[0] for field in MESSAGE_SCHEMA.split(", ")]
    sinks.write_csv(common.messages(spark, sf_dir).select(*columns), path)
    scanned = load_messages(spark, path)
    return scanned.select(
        "tweet_id",
        "author_id",
        "inbound",
        F.md5("text").alias("digest"),
        F.length("text").cast("long").alias("n_chars"),
        "in_response_to_tweet_id",
    )


@query(
    "sink_threads",
    f"""WITH RECURSIVE {CLEAN}
SELECT thread_id, brand, md5(customer_text) AS customer_digest, md5(brand_reply) AS reply_digest, n_turns FROM clean""",
)
def sink_threads(spark, sf_dir):
    """Threads written as Parquet, with their turn arrays, and read back."""
    path = scratch_path(spark, "threads")
    sinks.write_table(common.clean_threads(spark, sf_dir), path)
    return spark.read.parquet(path).select(
        "thread_id",
        "brand",
        F.md5("customer_text").alias("customer_digest"),
        F.md5("brand_reply").alias("reply_digest"),
        F.size("turns").cast("long").alias("n_turns"),
    )


@query(
    "sink_resolved_pairs",
    f"""WITH RECURSIVE {CLEAN}
SELECT thread_id, md5(customer_text) AS customer_digest, md5(brand_reply) AS reply_digest, n_turns
FROM clean WHERE regexp_matches(brand_reply, '\\S')""",
)
def sink_resolved_pairs(spark, sf_dir):
    """Resolved pairs written as CSV and read back without losing line breaks or quotes."""
    path = scratch_path(spark, "pairs")
    pairs = resolved(common.clean_threads(spark, sf_dir)).select("thread_id", "customer_text", "brand_reply", "n_turns")
    sinks.write_csv(pairs, path)
    back = sinks.read_csv(spark, path, "thread_id string, customer_text string, brand_reply string, n_turns long")
    return back.select(
        "thread_id",
        F.md5("customer_text").alias("customer_digest"),
        F.md5("brand_reply").alias("reply_digest"),
        "n_turns",
    )


@query(
    "sink_metric_report",
    f"""WITH {PREDICTIONS}
SELECT round(avg(CAST(correct AS INT)), 6) AS accuracy, CAST(count(*) AS DOUBLE) AS n FROM predictions""",
)
def sink_metric_report(spark, sf_dir):
    """Metrics written as one nested JSON row and read back."""
    path = scratch_path(spark, "report")
    rows = common.predictions(spark, sf_dir)
    report = nested_report(long_form(metrics.accuracy(rows, "truth", "intent"), "classification"))
    sinks.write_report(report, path)
    back = spark.read.schema("report map<string, string>").json(path)
    values = F.from_json(F.col("report")["classification"], "accuracy double, n double")
    return back.select(F.round(values["accuracy"], 6).alias("accuracy"), values["n"].alias("n"))


@query(
    "vector_store",
    f"""WITH RECURSIVE {CLEAN}
SELECT c.thread_id, md5(c.customer_text) AS customer_digest, md5(c.brand_reply) AS reply_digest, c.n_turns,
       CAST(len(e.embedding) AS BIGINT) AS dim, round(CAST(e.embedding[1] AS DOUBLE), 6) AS first_value
FROM clean c JOIN embeddings e ON e.vec_id = CAST(c.thread_id AS BIGINT) // 1000000
WHERE regexp_matches(c.brand_reply, '\\S')""",
)
def vector_store(spark, sf_dir):
    """Resolved pairs with vectors, written as one table and read back."""
    path = scratch_path(spark, "vectors")
    vectors.write_vectors(common.thread_vectors(spark, sf_dir), path)
    return vectors.read_vectors(spark, path).select(
        "thread_id",
        F.md5("customer_text").alias("customer_digest"),
        F.md5("brand_reply").alias("reply_digest"),
        F.col("n_turns").cast("long").alias("n_turns"),
        F.size("embedding").cast("long").alias("dim"),
        F.round(F.get("embedding", F.lit(0)).cast("double"), 6).alias("first_value"),
    )


@query(
    "taxonomy_dimension",
    f"""WITH names AS (SELECT unnest({NAMES}) AS intent, unnest(range(0, 10)) AS intent_id)
SELECT CAST(n.intent_id AS BIGINT) AS intent_id, n.intent,
       n.intent IN ('billing_payment', 'account_access', 'seller_complaint') AS escalation_denylist,
       count(e.vec_id) AS n_messages
FROM names n LEFT JOIN embeddings e ON e.label = n.intent_id GROUP BY 1, 2, 3""",
)
def taxonomy_dimension(spark, sf_dir):
    """The taxonomy with the number of messages of each intent."""
    counts = common.vectors(spark, sf_dir).groupBy(F.col("label").alias("intent_id")).agg(F.count("*").alias("n_messages"))
    return (
        taxonomy(spark)
        .join(counts, "intent_id", "left")
        .fillna(0, ["n_messages"])
        .select(F.col("intent_id").cast("long").alias("intent_id"), "intent", "escalation_denylist", "n_messages")
    )


@query(
    "brand_messages",
    f"WITH {MESSAGES} SELECT tweet_id, author_id FROM messages WHERE lower(author_id) = lower('BRAND1')",
)
def brand_messages(spark, sf_dir):
    return brands.brand_messages(common.messages(spark, sf_dir), "BRAND1").select("tweet_id", "author_id")


@query(
    "inbound_outbound",
    f"""WITH {MESSAGES}
SELECT CASE WHEN inbound THEN 'inbound' ELSE 'outbound' END AS direction, tweet_id FROM messages""",
)
def inbound_outbound(spark, sf_dir):
    rows = common.messages(spark, sf_dir)
    parts = [("inbound", brands.inbound(rows)), ("outbound", brands.outbound(rows))]
    left, right = [part.select(F.lit(name).alias("direction"), "tweet_id") for name, part in parts]
    return left.unionByName(right)


@query(
    "resolved_threads",
    f"""WITH RECURSIVE {CLEAN}
SELECT thread_id, brand FROM clean WHERE regexp_matches(brand_reply, '\\S')""",
)
def resolved_threads(spark, sf_dir):
    return resolved(common.clean_threads(spark, sf_dir)).select("thread_id", "brand")


@query("long_threads", f"WITH RECURSIVE {THREADS} SELECT thread_id, n_turns FROM threads WHERE n_turns >= 4")
def long_threads(spark, sf_dir):
    """Threads with at least four turns."""
    rows = common.clean_threads(spark, sf_dir).where(F.size("turns") >= 4)
    return rows.select("thread_id", F.col("n_turns").cast("long").alias("n_turns"))


def noisy_labels(spark, sf_dir):
    """Labels of which some are null or no taxonomy name."""
    number = F.col("vec_id")
    return common.vectors(spark, sf_dir).select(
        "vec_id",
        F.when(number % 11 == 0, None).when(number % 7 == 0, "something_else").otherwise(intent_of(F.col("label"))).alias("intent"),
    )


NOISY = f"""noisy AS (
  SELECT vec_id, CASE WHEN vec_id % 11 = 0 THEN NULL WHEN vec_id % 7 = 0 THEN 'something_else'
                      ELSE {NAMES}[label + 1] END AS intent FROM embeddings)"""


@query("known_labels", f"WITH {NOISY} SELECT vec_id, intent FROM noisy WHERE intent IS NOT NULL AND list_contains({NAMES}, intent)")
def known_labels(spark, sf_dir):
    return known_intents(noisy_labels(spark, sf_dir))


@query(
    "labelled_projection",
    f"""WITH RECURSIVE {CLEAN}
SELECT thread_id, md5(customer_text) AS digest, brand AS brand_name, '' AS human_intent, '' AS notes FROM clean""",
)
def labelled_projection(spark, sf_dir):
    """Output columns with renames and empty label fields."""
    return (
        common.clean_threads(spark, sf_dir)
        .withColumnRenamed("brand", "brand_name")
        .select(
            "thread_id",
            F.md5("customer_text").alias("digest"),
            "brand_name",
            F.lit("").alias("human_intent"),
            F.lit("").alias("notes"),
        )
    )


def sql_profiles(taught: str = "true") -> str:
    """Trigrams of all documents and the language profiles of those that are ``taught``."""
    return f"""grams AS (
  SELECT doc_id, lang, substring(t, CAST(i AS BIGINT), 3) AS gram
  FROM (SELECT doc_id, lang, lower(text) AS t, unnest(range(1, length(text) - 1)) AS i FROM documents)),
counted AS (SELECT lang, gram, count(*) AS n FROM grams WHERE {taught} GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS r FROM counted),
profile AS (SELECT lang, gram, n, sum(n) OVER (PARTITION BY lang) AS total FROM ranked WHERE r <= 1000),
floors AS (SELECT lang, ln(1.0 / (max(total) + 1000)) AS low FROM profile GROUP BY 1)"""


def sql_detected(key: str, grams: str) -> str:
    """``detected``: the language of each text whose trigrams are rows of the table ``grams``."""
    return f"""found AS (
  SELECT g.{key}, p.lang, sum(ln((p.n + 1.0) / (p.total + 1000)) - f.low) AS gain
  FROM (SELECT {key}, gram FROM {grams}) g JOIN profile p ON p.gram = g.gram JOIN floors f ON f.lang = p.lang GROUP BY 1, 2),
sizes AS (SELECT {key}, count(*) AS n FROM {grams} GROUP BY 1),
totals AS (
  SELECT s.{key}, f.lang, s.n * f.low + coalesce(x.gain, 0) AS score
  FROM sizes s JOIN floors f ON true LEFT JOIN found x ON x.{key} = s.{key} AND x.lang = f.lang
  WHERE s.{key} IN (SELECT {key} FROM found)),
detected AS (
  SELECT {key}, lang AS detected FROM (
    SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, lang) AS r FROM totals) WHERE r = 1)"""


LANGUAGE = f"{sql_profiles()},\n{sql_detected('doc_id', 'grams')}"


def detected_documents(spark, sf_dir):
    docs = common.documents(spark, sf_dir, "doc_id", "text", "lang")
    detect = language_detector(language_profiles(docs, "text", "lang"))
    return docs.select("doc_id", "lang", detect("text").alias("detected"))


@query(
    "language_filter",
    f"""WITH {LANGUAGE}
SELECT d.doc_id, d.lang, x.detected FROM documents d LEFT JOIN detected x ON x.doc_id = d.doc_id
WHERE coalesce(x.detected, 'en') = 'en'""",
)
def language_filter(spark, sf_dir):
    """Documents kept as English by trigram profiles of all documents, whole texts."""
    return keep_language(detected_documents(spark, sf_dir), "detected")


@query(
    "language_accuracy",
    f"""WITH {LANGUAGE}
SELECT d.lang, count(*) AS n, sum(CAST(coalesce(x.detected, 'en') = d.lang AS BIGINT))::BIGINT AS n_right
FROM documents d LEFT JOIN detected x ON x.doc_id = d.doc_id GROUP BY 1""",
)
def language_accuracy(spark, sf_dir):
    right = F.coalesce("detected", F.lit("en")) == F.col("lang")
    return (
        detected_documents(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n"), F.sum(right.cast("long")).alias("n_right"))
    )


def document_examples(spark, sf_dir):
    """Neighbours with document texts as the retrieved messages and replies."""
    texts = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("match_id"), F.col("source").alias("customer_text"), F.col("text").alias("brand_reply")
    )
    return common.neighbours(spark, sf_dir).join(texts, "match_id")


@query(
    "compact_retrieval",
    f"""WITH {common.NEIGHBOURS}
SELECT n.vec_id, row_number() OVER (PARTITION BY n.vec_id ORDER BY n.rank) AS place, n.rank,
       round_even(n.similarity, 3) AS similarity, md5(substring(d.text, 1, 100)) AS digest
FROM neighbours n JOIN documents d ON d.doc_id = n.match_id QUALIFY place <= 3""",
)
def compact_retrieval(spark, sf_dir):
    """First three retrieved rows with rounded similarity and the start of the reply."""
    nested = nested_examples(document_examples(spark, sf_dir), "vec_id")
    rows = nested.select("vec_id", F.posexplode(compact_examples(F.col("examples"))).alias("place", "row"))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).cast("long").alias("place"),
        F.col("row.rank").cast("long").alias("rank"),
        "row.similarity",
        F.md5("row.brand_reply").alias("digest"),
    )


@query(
    "edge_case_flags",
    f"""WITH {PREDICTIONS},
wide AS (
  SELECT d.doc_id, len(regexp_extract_all(d.text, '\\S+')) < 10 AS is_edge_short, coalesce(p.top2_gap, 0) < 0.15 AS is_edge_ambiguous,
         coalesce(n.similarity, 0) < 0.5 AS is_edge_no_precedent
  FROM documents d LEFT JOIN predictions p ON p.vec_id = d.doc_id LEFT JOIN neighbours n ON n.vec_id = d.doc_id AND n.rank = 1)
SELECT *, is_edge_short OR is_edge_ambiguous OR is_edge_no_precedent AS is_edge FROM wide""",
)
def edge_case_flags(spark, sf_dir):
    """All documents; one without a prediction is ambiguous, one without a neighbour has no precedent."""
    best = common.neighbours(spark, sf_dir).where("rank = 1").select("vec_id", F.col("similarity").alias("top_similarity"))
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("vec_id"), word_count(F.col("text")).alias("word_count"))
    rows = texts.join(common.predictions(spark, sf_dir), "vec_id", "left").join(best, "vec_id", "left")
    rows = rows.fillna(0.0, ["top2_gap", "top_similarity"]).withColumnRenamed("vec_id", "doc_id")
    return edge_flags(rows).select("doc_id", "is_edge_short", "is_edge_ambiguous", "is_edge_no_precedent", "is_edge")


@query(
    "default_signals",
    f"""WITH {MESSAGES}
SELECT tweet_id, CASE WHEN position % 3 = 0 THEN 0.0::DOUBLE ELSE (position % 10) / 10.0::DOUBLE END AS urgency_score,
       CASE WHEN position % 4 = 0 THEN 'neutral' ELSE 'negative' END AS sentiment,
       CASE WHEN position % 3 <> 0 AND (position % 10) / 10.0::DOUBLE >= 0.8 THEN 'escalate' ELSE 'auto_handle' END AS decision
FROM messages""",
)
def default_signals(spark, sf_dir):
    """Missing urgency counts as 0 and missing sentiment as neutral."""
    number = F.col("position")
    rows = common.messages(spark, sf_dir).select(
        "tweet_id",
        redact(F.col("text")).alias("message"),
        F.lit(fixed.INTENT_NAMES[0]).alias("intent"),
        F.lit(0.9).alias("confidence"),
        F.lit(0.9).alias("top_similarity"),
        F.when(number % 3 != 0, (number % 10) / 10.0).alias("urgency"),
        F.when(number % 4 != 0, "negative").alias("mood"),
    )
    gated = escalation_gate(rows, urgency="urgency", sentiment="mood")
    return gated.select(
        "tweet_id", "signals.urgency_score", "signals.sentiment", "decision"
    )
