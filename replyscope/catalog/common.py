"""Registry of the runnable queries and the tables they start from."""

from __future__ import annotations

from collections.abc import Callable

from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.fixed_values import INTENT_NAMES, REDACTION_RULES
from replyscope.operators import similarity, threads
from replyscope.operators.classify import best_label, neighbour_scores
from replyscope.plans.jobs import redact_threads
from replyscope.session import cut_lineage, spread
from replyscope.sources.messages import TURNS, conversations_to_messages
from replyscope.sources.taxonomy import intent_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SHARED: dict[tuple, DataFrame] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where one exists, the SQL that gives the same rows."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Long texts, spread over all cores for work on every character."""
    return spread(table(spark, sf_dir, "documents").select(*columns))


def shared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A checkpointed table that several queries of one session start from."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in SHARED:
        SHARED[key] = cut_lineage(build())
    return SHARED[key]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations_to_messages(table(spark, sf_dir, "conversations"))


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "paths", lambda: threads.reply_paths(messages(spark, sf_dir)))


def raw_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads of all brands."""
    return shared(spark, sf_dir, "raw threads", lambda: threads.reconstruct_threads(messages(spark, sf_dir)))


def clean_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redacted threads of all brands."""
    return shared(spark, sf_dir, "threads", lambda: redact_threads(raw_threads(spark, sf_dir)))


def vector_id(thread_id: str = "thread_id") -> Column:
    """Conversation number of a message id, which is also the id of its vector."""
    return F.floor(F.col(thread_id).cast("long") / TURNS)


def thread_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redacted threads with the vector whose id is the conversation number."""
    rows = clean_threads(spark, sf_dir).withColumn("vec_id", vector_id())
    return rows.join(vectors(spark, sf_dir).select("vec_id", "embedding"), "vec_id")


def thread_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(thread_id, match_id, similarity, rank, customer_text, brand_reply): similar resolved threads."""

    def build() -> DataFrame:
        rows = thread_vectors(spark, sf_dir)
        corpus = threads.resolved(rows).withColumnRenamed("thread_id", "match_id")
        found = similarity.knn(rows, corpus, query_key="thread_id", corpus_key="match_id", exclude_same_id=True)
        return found.join(corpus.select("match_id", "customer_text", "brand_reply"), "match_id")

    return shared(spark, sf_dir, "thread neighbours", build)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings")


def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, match_id, similarity, rank): the five nearest other vectors of each vector."""

    def build() -> DataFrame:
        rows = vectors(spark, sf_dir)
        return similarity.knn(
            rows.withColumnRenamed("vec_id", "query_id"),
            rows.withColumnRenamed("vec_id", "match_id"),
            corpus_key="match_id",
            exclude_same_id=True,
        ).withColumnRenamed("query_id", "vec_id")

    return shared(spark, sf_dir, "neighbours", build)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, label, score) from the vote of the neighbours, rounded so that ties are plain."""

    def build() -> DataFrame:
        labels = vectors(spark, sf_dir).select(F.col("vec_id").alias("match_id"), intent_of(F.col("label")).alias("label"))
        voted = neighbour_scores(neighbours(spark, sf_dir).join(labels, "match_id"), "vec_id")
        return voted.withColumn("score", F.round("score", 6))

    return shared(spark, sf_dir, "scores", build)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, truth, intent, confidence, top2_gap, correct)."""

    def build() -> DataFrame:
        truth = vectors(spark, sf_dir).select("vec_id", intent_of(F.col("label")).alias("truth"))
        return (
            truth.join(best_label(scores(spark, sf_dir), "vec_id"), "vec_id")
            .withColumn("top2_gap", F.round("top2_gap", 6))
            .withColumn("correct", F.col("truth") == F.col("intent"))
        )

    return shared(spark, sf_dir, "predictions", build)


# SQL fragments: common table expressions that build the same tables

NAMES = "[" + ", ".join(f"'{name}'" for name in INTENT_NAMES) + "]"

MESSAGES = """messages AS (
  SELECT CAST(conv_id * 1000000 + turn AS VARCHAR) AS tweet_id,
         CASE WHEN role = 'assistant' THEN 'brand' || CAST(conv_id % 5 AS VARCHAR)
              ELSE 'cust' || CAST(conv_id AS VARCHAR) END AS author_id,
         role = 'user' AS inbound, text,
         CASE WHEN turn > 0 THEN CAST(conv_id * 1000000 + turn - 1 AS VARCHAR) END AS parent,
         conv_id * 1000000 + turn AS position
  FROM conversations WHERE role <> 'system')"""

THREADS = f"""{MESSAGES},
first_child AS (SELECT parent, arg_min(tweet_id, position) AS child FROM messages WHERE parent IS NOT NULL GROUP BY 1),
tops AS (SELECT m.* FROM messages m WHERE inbound AND NOT EXISTS (SELECT 1 FROM messages p WHERE p.tweet_id = m.parent)),
walk(thread_id, tweet_id, turn) AS (
  SELECT tweet_id, tweet_id, 1 FROM tops
  UNION ALL
  SELECT w.thread_id, f.child, w.turn + 1 FROM walk w JOIN first_child f ON f.parent = w.tweet_id WHERE w.turn < 20),
below(thread_id, tweet_id, depth) AS (
  SELECT tweet_id, tweet_id, 0 FROM tops
  UNION ALL
  SELECT b.thread_id, m.tweet_id, b.depth + 1 FROM below b JOIN messages m ON m.parent = b.tweet_id WHERE b.depth < 11),
roots AS (
  SELECT DISTINCT b.thread_id, m.author_id AS brand FROM below b JOIN messages m ON m.tweet_id = b.tweet_id
  WHERE b.depth BETWEEN 1 AND 11 AND NOT m.inbound),
turns AS (
  SELECT w.thread_id, w.turn, m.tweet_id, m.author_id, m.text, m.inbound
  FROM walk w JOIN messages m ON m.tweet_id = w.tweet_id WHERE w.thread_id IN (SELECT thread_id FROM roots)),
threads AS (
  SELECT t.thread_id, r.brand,
         coalesce(arg_min(t.text, t.turn) FILTER (WHERE t.inbound), arg_min(t.text, t.turn)) AS customer_text,
         arg_min(t.text, t.turn) FILTER (WHERE NOT t.inbound) AS brand_reply,
         count(*) AS n_turns
  FROM turns t JOIN roots r ON r.thread_id = t.thread_id GROUP BY 1, 2 HAVING count(*) >= 2)"""

def sql_replace(column: str, rules: list[str]) -> str:
    for name, pattern, ignore_case, token in REDACTION_RULES:
        if name in rules:
            column = f"regexp_replace({column}, '{pattern}', '{token}', '{'gi' if ignore_case else 'g'}')"
    return column


def sql_redact(column: str, rules: list[str] | None = None) -> str:
    """Redaction as SQL: "" for null, blank text unchanged, otherwise replaced and stripped."""
    filled = f"coalesce({column}, '')"
    replaced = sql_replace(filled, [rule[0] for rule in REDACTION_RULES] if rules is None else rules)
    return (
        f"CASE WHEN regexp_matches({filled}, '\\S') THEN "
        f"regexp_replace({replaced}, '^\\s+|\\s+$', '', 'g') ELSE {filled} END"
    )


CLEAN = f"""{THREADS},
clean AS (
  SELECT thread_id, brand, {sql_redact('customer_text')} AS customer_text, {sql_redact('brand_reply')} AS brand_reply,
         n_turns, CAST(thread_id AS BIGINT) // 1000000 AS vec_id FROM threads)"""

THREAD_NEIGHBOURS = """thread_pairs AS (
  SELECT q.thread_id, c.thread_id AS match_id, c.customer_text, c.brand_reply,
         round(list_cosine_similarity(CAST(x.embedding AS DOUBLE[]), CAST(y.embedding AS DOUBLE[])), 6) AS similarity
  FROM clean q JOIN embeddings x ON x.vec_id = q.vec_id
  JOIN clean c ON c.thread_id <> q.thread_id AND regexp_matches(c.brand_reply, '\\S') JOIN embeddings y ON y.vec_id = c.vec_id),
thread_neighbours AS (
  SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY similarity DESC, match_id) AS rank FROM thread_pairs
  QUALIFY rank <= 5)"""

NEIGHBOURS = """neighbours AS (
  SELECT vec_id, match_id, similarity, rank FROM (
    SELECT q.vec_id, c.vec_id AS match_id, c.label,
           round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 6) AS similarity,
           row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(
             CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 6) DESC, c.vec_id) AS rank
    FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id) WHERE rank <= 5)"""

SCORES = f"""{NEIGHBOURS},
votes AS (
  SELECT n.vec_id, {NAMES}[e.label + 1] AS label, sum(greatest(n.similarity, 0)) AS s
  FROM neighbours n JOIN embeddings e ON e.vec_id = n.match_id GROUP BY 1, 2),
scores AS (
  SELECT vec_id, label, round(coalesce(s / nullif(sum(s) OVER (PARTITION BY vec_id), 0), 0), 6) AS score FROM votes)"""

PREDICTIONS = f"""{SCORES},
ordered AS (
  SELECT vec_id, label, score, row_number() OVER w AS place,
         lead(score) OVER w AS second
  FROM scores WINDOW w AS (PARTITION BY vec_id ORDER BY score DESC, label)),
predictions AS (
  SELECT o.vec_id, {NAMES}[e.label + 1] AS truth, o.label AS intent, o.score AS confidence,
         CASE WHEN o.second IS NULL THEN 1.0 ELSE round(o.score - o.second, 6) END AS top2_gap,
         {NAMES}[e.label + 1] = o.label AS correct
  FROM ordered o JOIN embeddings e ON e.vec_id = o.vec_id WHERE o.place = 1)"""


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_fill(template: str, **values: str) -> str:
    """A text template as a SQL concatenation."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(sql_text(literal))
        if name is not None:
            parts.append(f"CAST({values[name]} AS VARCHAR)")
    return "(" + " || ".join(parts) + ")"
