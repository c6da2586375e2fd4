"""Samples, vectors, clusters, classifiers and batched scoring."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.catalog import common
from replyscope.catalog.aggregates import CLUSTERS, document_clusters
from replyscope.catalog.common import MESSAGES, PREDICTIONS, THREADS, query, sql_text, table
from replyscope.catalog.joins import TERMS
from replyscope.operators import classify, clusters, density, encoder, metrics, tfidf, threads
from replyscope.operators.ranking import hash_sample
from replyscope.operators.sampling import golden_sample, group_samples, stratified_split
from replyscope.operators.scoring import score_batches
from replyscope.session import scratch_path


@query(
    "sampled_roots",
    f"""WITH RECURSIVE {THREADS},
chosen AS (SELECT thread_id FROM (SELECT DISTINCT thread_id FROM roots) ORDER BY md5('42:' || thread_id), thread_id LIMIT 30)
SELECT thread_id, n_turns FROM threads WHERE thread_id IN (SELECT thread_id FROM chosen)""",
)
def sampled_roots(spark, sf_dir):
    """Thirty roots drawn before the length filter."""
    rows = threads.reconstruct_threads(common.messages(spark, sf_dir), sample_size=30)
    return rows.select("thread_id", F.col("n_turns").cast("long").alias("n_turns"))


@query(
    "sampled_messages",
    f"WITH {MESSAGES} SELECT tweet_id FROM messages WHERE inbound ORDER BY md5('42:' || tweet_id), tweet_id LIMIT 150",
)
def sampled_messages(spark, sf_dir):
    rows = common.messages(spark, sf_dir).where("inbound").select("tweet_id")
    return hash_sample(rows, "tweet_id", 150, fixed.RANDOM_SEED)


@query(
    "cluster_samples",
    f"""WITH {CLUSTERS}
SELECT doc_id, cluster FROM clusters QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY md5('42:' || doc_id), doc_id) <= 10""",
)
def cluster_samples(spark, sf_dir):
    return group_samples(document_clusters(spark, sf_dir), "doc_id", "cluster", 10)


GOLDEN = f"""{PREDICTIONS},
best AS (SELECT vec_id, similarity FROM neighbours WHERE rank = 1),
candidates AS (
  SELECT p.vec_id, p.intent, p.top2_gap < 0.15 AND p.vec_id % 3 = 0 OR b.similarity < 0.3 AS is_edge
  FROM predictions p JOIN best b ON b.vec_id = p.vec_id),
edges AS (SELECT * FROM candidates WHERE is_edge ORDER BY md5('42:' || vec_id), vec_id LIMIT 40),
classes AS (
  SELECT * FROM candidates WHERE vec_id NOT IN (SELECT vec_id FROM edges)
  QUALIFY row_number() OVER (PARTITION BY intent ORDER BY md5('42:' || vec_id), vec_id) <= 16),
golden AS (
  SELECT vec_id, intent, is_edge FROM (SELECT *, 0 AS part FROM edges UNION ALL SELECT *, 1 FROM classes)
  ORDER BY part, md5('42:' || vec_id), vec_id LIMIT 200)"""


@query("golden_sample", f"WITH {GOLDEN} SELECT vec_id, intent, is_edge FROM golden")
def golden(spark, sf_dir):
    """Edge cases, then every predicted intent, capped at 200."""
    best = common.neighbours(spark, sf_dir).where("rank = 1").select("vec_id", "similarity")
    edge = ((F.col("top2_gap") < 0.15) & (F.col("vec_id") % 3 == 0)) | (F.col("similarity") < 0.3)
    rows = common.predictions(spark, sf_dir).join(best, "vec_id").select("vec_id", "intent", edge.alias("is_edge"))
    return golden_sample(rows, "vec_id", "intent")


@query(
    "stratified_split",
    f"""WITH {PREDICTIONS},
placed AS (
  SELECT vec_id, truth, row_number() OVER (PARTITION BY truth ORDER BY md5('42:' || vec_id), vec_id) AS r,
         count(*) OVER (PARTITION BY truth) AS n FROM predictions)
SELECT vec_id, truth, CASE WHEN r <= ceil(n * 0.1::DOUBLE) THEN 'eval' ELSE 'train' END AS part FROM placed""",
)
def split(spark, sf_dir):
    rows = common.predictions(spark, sf_dir).select("vec_id", "truth")
    train, held_out = stratified_split(rows, "vec_id", "truth")
    return train.withColumn("part", F.lit("train")).unionByName(held_out.withColumn("part", F.lit("eval")))


@query(
    "text_vectors",
    """SELECT doc_id, CAST(384 AS BIGINT) AS dim, CASE WHEN regexp_matches(text, '[\\p{L}\\p{N}_]') THEN 1.0 ELSE 0.0 END::DOUBLE AS squares
FROM documents""",
)
def text_vectors(spark, sf_dir):
    """Hashed TF-IDF vectors of whole documents: their dimension and squared length."""
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    rows = encoder.encode(docs, "text", encoder.fit_encoder(docs, "text"))
    squares = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return rows.select("doc_id", F.size("embedding").cast("long").alias("dim"), F.round(squares, 4).alias("squares"))


def letter_model():
    """A stand-in for a sentence model: shares of a few letters."""

    def encode(texts):
        return np.array([[text.count(letter) for letter in "aeinorst"] for text in texts], dtype=float)

    return encode


LETTERS = ", ".join(f"length(text) - length(replace(text, '{letter}', ''))" for letter in "aeinorst")


@query(
    "caller_model_vectors",
    f"""WITH counted AS (SELECT doc_id, [{LETTERS}] AS c FROM documents),
sized AS (SELECT doc_id, c, sqrt(list_sum(list_transform(c, lambda x: x * x))) AS s FROM counted)
SELECT doc_id, CAST(len(c) AS BIGINT) AS dim, round(CAST(CAST(CASE WHEN s > 0 THEN c[1] / s ELSE 0 END AS FLOAT) AS DOUBLE), 5) AS first_value,
       round(CAST(CAST(CASE WHEN s > 0 THEN c[8] / s ELSE 0 END AS FLOAT) AS DOUBLE), 5) AS last_value FROM sized""",
)
def caller_model_vectors(spark, sf_dir):
    """Vectors from a function of the caller, applied in batches."""
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    rows = encoder.encode_with(docs, "text", letter_model)
    value = lambda i: F.round(F.get("embedding", F.lit(i)).cast("double"), 5)
    return rows.select(
        "doc_id", F.size("embedding").cast("long").alias("dim"), value(0).alias("first_value"), value(7).alias("last_value")
    )


@query("kmeans_clusters")
def kmeans_clusters(spark, sf_dir):
    return clusters.cluster_kmeans(common.vectors(spark, sf_dir), "vec_id")


@query(
    "density_clusters",
    """WITH RECURSIVE close AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM embeddings a, embeddings b
  WHERE round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) >= 0.38),
core AS (SELECT u FROM close GROUP BY 1 HAVING count(*) >= 3),
links AS (SELECT u, v FROM close WHERE u IN (SELECT u FROM core) AND v IN (SELECT u FROM core)),
reach(u, v) AS (SELECT u, u FROM core UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
roots AS (SELECT u, min(v) AS root FROM reach GROUP BY 1),
kept AS (SELECT root, row_number() OVER (ORDER BY md5(CAST(root AS VARCHAR))) - 1 AS cluster FROM (
  SELECT root FROM roots GROUP BY 1 HAVING count(*) >= 4))
SELECT e.vec_id, CAST(coalesce(k.cluster, -1) AS INT) AS cluster FROM embeddings e
LEFT JOIN roots r ON r.u = e.vec_id LEFT JOIN kept k ON k.root = r.root""",
)
def density_clusters(spark, sf_dir):
    """Clusters of dense regions, with noise; the cut suits random vectors."""
    return density.cluster_density(
        common.vectors(spark, sf_dir), "vec_id", similarity=0.38, min_samples=3, min_cluster_size=4
    )


WEIGHTS = f"""texts AS (SELECT doc_id AS key, text FROM documents),
{TERMS},
vocabulary AS (
  SELECT term, df, ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1 AS idf
  FROM (SELECT term, count(*) AS df, sum(tf) AS total FROM counts GROUP BY 1 HAVING count(*) >= 2)
  ORDER BY total DESC, term LIMIT 30000),
raw AS (SELECT key, c.term, (1 + ln(tf)) * idf AS w FROM counts c JOIN vocabulary v ON v.term = c.term)"""


@query("tfidf_vocabulary", f"WITH {WEIGHTS} SELECT term, df, round(idf, 6) AS idf FROM vocabulary")
def tfidf_vocabulary(spark, sf_dir):
    vocabulary = tfidf.fit_vocabulary(common.documents(spark, sf_dir, "doc_id", "text"), "doc_id", "text")
    return vocabulary.table.select("term", "df", F.round("idf", 6).alias("idf"))


@query(
    "tfidf_weights",
    f"""WITH {WEIGHTS}
SELECT key AS doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY key)), 6) AS weight FROM raw""",
)
def tfidf_weights(spark, sf_dir):
    """Weights of all terms of whole documents."""
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    weights = tfidf.tfidf(docs, "doc_id", "text", tfidf.fit_vocabulary(docs, "doc_id", "text"))
    return weights.select("doc_id", "term", F.round("weight", 6).alias("weight"))


def labelled_documents(spark, sf_dir):
    """Documents with their quality label as a name."""
    label = F.when(F.col("quality") == 1, "good").otherwise("poor").alias("label")
    return table(spark, sf_dir, "labels").select("doc_id", label).join(
        common.documents(spark, sf_dir, "doc_id", "text"), "doc_id"
    )


CLASSIFIERS: dict[tuple, classify.TextClassifier] = {}


def document_classifier(spark, sf_dir):
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in CLASSIFIERS:
        train, _ = stratified_split(labelled_documents(spark, sf_dir), "doc_id", "label")
        CLASSIFIERS[key] = classify.fit_text_classifier(train, "doc_id", "text", "label")
    return CLASSIFIERS[key]


@query("classified_documents")
def classified_documents(spark, sf_dir):
    """Label and confidence of every document from a classifier trained on the labelled ones."""
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    return document_classifier(spark, sf_dir).predict(docs, "doc_id", "text")


@query("class_scores")
def class_scores(spark, sf_dir):
    """Full distribution over the classes for every document."""
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    return document_classifier(spark, sf_dir).scores(docs, "doc_id", "text")


@query("saved_classifier", "SELECT count(*) AS n, count(*) AS n_equal FROM documents")
def saved_classifier(spark, sf_dir):
    """A classifier that was saved and loaded gives the same answers."""
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    first = document_classifier(spark, sf_dir)
    path = scratch_path(spark, "classifier")
    first.save(path)
    second = classify.TextClassifier.load(spark, path).predict(docs, "doc_id", "text")
    both = first.predict(docs, "doc_id", "text").join(
        second.select("doc_id", F.col("intent").alias("other"), F.col("confidence").alias("other_confidence")), "doc_id"
    )
    equal = (F.col("intent") == F.col("other")) & (F.abs(F.col("confidence") - F.col("other_confidence")) < 1e-9)
    return both.agg(F.count("*").alias("n"), F.sum(equal.cast("long")).alias("n_equal"))


@query(
    "majority_baseline",
    f"""WITH {PREDICTIONS},
top AS (SELECT truth AS m FROM predictions GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT vec_id, m AS intent, 1.0::DOUBLE AS confidence, {sql_text(fixed.CANNED_REPLY)} AS draft_reply FROM predictions, top""",
)
def majority_baseline(spark, sf_dir):
    rows = common.predictions(spark, sf_dir)
    found = classify.majority_baseline(rows, "truth", rows.select("vec_id"))
    return found.select("vec_id", "intent", "confidence", "draft_reply")


@query(
    "majority_baseline_metrics",
    f"""WITH {PREDICTIONS},
counts AS (SELECT truth, count(*) AS n FROM predictions GROUP BY 1),
size AS (SELECT count(*) AS labels, sum(n) AS n, max(n) AS top FROM counts)
SELECT labels AS n_labels, round(top / n, 6) AS accuracy, round(2 * (top / n) / (top / n + 1) / labels, 6) AS macro_f1 FROM size""",
)
def majority_metrics(spark, sf_dir):
    rows = common.predictions(spark, sf_dir).select("vec_id", "truth")
    found = classify.majority_baseline(rows, "truth", rows)
    averages = metrics.macro_averages(found, "truth", "intent")
    share = metrics.accuracy(found, "truth", "intent").select("accuracy").scalar()
    return averages.select("n_labels", F.round(share, 6).alias("accuracy"), F.round("macro_f1", 6).alias("macro_f1"))


@query("simple_baseline_metrics")
def simple_metrics(spark, sf_dir):
    """Classifier metrics on the held-out part of the labelled documents."""
    _, held_out = stratified_split(labelled_documents(spark, sf_dir), "doc_id", "label")
    found = document_classifier(spark, sf_dir).predict(held_out, "doc_id", "text")
    return metrics.macro_averages(held_out.join(found, "doc_id"), "label", "intent")


def length_model():
    return lambda texts: [len(text) for text in texts]


@query("batched_scores", "SELECT doc_id, CAST(length(text) AS BIGINT) AS score FROM documents")
def batched_scores(spark, sf_dir):
    """A function of the caller over whole texts, one result per row."""
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    return score_batches(docs, "doc_id", "text", length_model, "score", "bigint")
