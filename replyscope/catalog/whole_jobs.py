"""Whole jobs, also on a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.catalog import common, models  # noqa: F401  (models registers the SQL of density_clusters)
from replyscope.catalog.aggregates import STATS
from replyscope.catalog.common import CLEAN, PREDICTIONS, THREAD_NEIGHBOURS, THREADS, query, sql_redact, sql_text, table
from replyscope.catalog.texts import BATCHED, CONFIGURED, FIRST_NAME, label_answers
from replyscope.operators import classify, similarity, threads
from replyscope.operators.encoder import encode, fit_encoder
from replyscope.operators.ranking import hash_sample
from replyscope.operators.sampling import stratified_split
from replyscope.plans import jobs
from replyscope.session import scratch_path
from replyscope.sources.messages import conversations_to_messages
from replyscope.sources.vectors import read_vectors, write_vectors
from replyscope.streaming.triage import message_stream, start_triage

CONFIDENCE, SIMILARITY = 0.22, 0.15


@query(
    "brand_statistics",
    f"""WITH {STATS}
SELECT *, CASE WHEN thread_completeness_pct >= 60 THEN 'green' WHEN thread_completeness_pct >= 30 THEN 'yellow' ELSE 'red' END AS band FROM stats""",
)
def brand_statistics(spark, sf_dir):
    return jobs.brand_report(common.messages(spark, sf_dir))


@query(
    "reconstructed_threads",
    f"""WITH RECURSIVE {THREADS}
SELECT thread_id, brand, md5(customer_text) AS customer_digest, md5(brand_reply) AS reply_digest, n_turns FROM threads""",
)
def reconstructed_threads(spark, sf_dir):
    rows = threads.reconstruct_threads(common.messages(spark, sf_dir))
    return rows.select(
        "thread_id",
        "brand",
        F.md5("customer_text").alias("customer_digest"),
        F.md5("brand_reply").alias("reply_digest"),
        F.col("n_turns").cast("long").alias("n_turns"),
    )


@query(
    "threads_of_one_brand",
    f"""WITH RECURSIVE {THREADS} SELECT thread_id, 'BRAND2' AS brand, n_turns FROM threads WHERE brand = 'brand2'""",
)
def threads_of_one_brand(spark, sf_dir):
    """The brand is given without regard to case."""
    rows = threads.reconstruct_threads(common.messages(spark, sf_dir), "BRAND2")
    return rows.select("thread_id", "brand", F.col("n_turns").cast("long").alias("n_turns"))


@query(
    "prepared_threads",
    f"""WITH RECURSIVE {CLEAN}
SELECT thread_id, md5(customer_text) AS customer_digest, md5(brand_reply) AS reply_digest, n_turns FROM clean
WHERE regexp_matches(brand_reply, '\\S')""",
)
def prepared_threads(spark, sf_dir):
    """Resolved pairs from messages: threads, redaction, filter, sinks."""
    path = scratch_path(spark, "prepared")
    jobs.save_prepared_threads(common.messages(spark, sf_dir), path)
    pairs = spark.read.parquet(f"{path}/resolved_pairs")
    return pairs.select(
        "thread_id",
        F.md5("customer_text").alias("customer_digest"),
        F.md5("brand_reply").alias("reply_digest"),
        F.col("n_turns").cast("long").alias("n_turns"),
    )


DENSITY = dict(similarity=0.38, min_samples=3, min_cluster_size=4)


@query(
    "discovered_density_clusters",
    f"""SELECT x.vec_id, x.cluster, e.label FROM ({common.ORACLES["density_clusters"]}) x JOIN embeddings e ON e.vec_id = x.vec_id
QUALIFY row_number() OVER (PARTITION BY x.cluster ORDER BY md5('42:' || x.vec_id), x.vec_id) <= 10""",
)
def discovered_density_clusters(spark, sf_dir):
    """Up to ten sample rows of each dense region, and of the noise."""
    _, _, samples = jobs.discover_clusters(common.vectors(spark, sf_dir), "vec_id", method="density", **DENSITY)
    return samples.select("vec_id", "cluster", "label")


@query("discovered_clusters")
def discovered_clusters(spark, sf_dir):
    """Seeded sample, KMeans and up to ten sample rows per cluster."""
    _, _, samples = jobs.discover_clusters(common.vectors(spark, sf_dir), "vec_id")
    return samples.select("vec_id", "cluster", "label")


def weak(spark, sf_dir):
    rows = common.messages(spark, sf_dir).where("inbound").select("tweet_id", "position", "text")
    return jobs.weak_labels(rows, label_answers, "position")


@query("weak_labels", f"WITH {BATCHED} SELECT tweet_id, md5(text) AS digest, l.intent FROM labelled l JOIN batched b USING (tweet_id) WHERE l.intent IS NOT NULL")
def weak_labels(spark, sf_dir):
    """Messages labelled in batches from model answers; only taxonomy names stay."""
    return weak(spark, sf_dir)[0].select("tweet_id", F.md5("text").alias("digest"), "intent")


@query(
    "weak_label_stats",
    f"""WITH {BATCHED}
SELECT count(*) AS total_attempted, count(intent) AS total_labeled, count(*) - count(intent) AS n_failed,
       round(count(intent) / count(*), 6) AS success_rate FROM labelled""",
)
def weak_label_stats(spark, sf_dir):
    return weak(spark, sf_dir)[1].withColumn("success_rate", F.round("success_rate", 6))


@query(
    "retrieval_table",
    f"""WITH RECURSIVE {CLEAN},
golden AS (SELECT thread_id FROM clean ORDER BY md5('42:' || thread_id), thread_id LIMIT 20)
SELECT c.thread_id, md5(c.customer_text) AS digest, CAST(len(e.embedding) AS BIGINT) AS dim FROM clean c JOIN embeddings e ON e.vec_id = c.vec_id
WHERE regexp_matches(c.brand_reply, '\\S') AND c.thread_id NOT IN (SELECT thread_id FROM golden)""",
)
def retrieval_table(spark, sf_dir):
    """Resolved pairs outside a held-out sample, with vectors."""
    rows = common.clean_threads(spark, sf_dir)
    held_out = hash_sample(rows.select("thread_id"), "thread_id", 20, fixed.RANDOM_SEED)
    vectors = common.vectors(spark, sf_dir).select("vec_id", "embedding")
    built = jobs.retrieval_table(
        rows, held_out, lambda pairs: pairs.withColumn("vec_id", common.vector_id()).join(vectors, "vec_id")
    )
    return built.select("thread_id", F.md5("customer_text").alias("digest"), F.size("embedding").cast("long").alias("dim"))


@query("thread_context_retrieval")
def thread_context_retrieval(spark, sf_dir):
    """Resolved threads similar to the recent customer turns of each thread, by hashed text vectors."""
    rows = common.clean_threads(spark, sf_dir)
    model = fit_encoder(rows, "customer_text")
    path = scratch_path(spark, "corpus")
    write_vectors(encode(rows, "customer_text", model), path)
    return jobs.retrieve_for_threads(rows, read_vectors(spark, path), lambda asked: encode(asked, "query_text", model))


def template_draft(passed):
    """A draft from the signals, in place of a text model."""
    draft = F.concat(
        F.lit("We will look into "), F.col("intent"), F.lit(" within "), (F.length("message") % 5 + 1).cast("string"),
        F.lit(" business days, or you get a 50% refund."),
    )
    return passed.withColumn("draft_reply", draft)


def thread_signals(spark, sf_dir):
    """Urgency answers for threads; short first messages have none."""
    number = common.vector_id()
    return common.raw_threads(spark, sf_dir).where(F.length("customer_text") >= 150).select(
        "thread_id",
        F.when(number % 4 == 0, "negative").otherwise("neutral").alias("sentiment"),
        (number % 11 / F.lit(10.0)).alias("urgency_score"),
    )


def triaged(spark, sf_dir):
    rows = common.raw_threads(spark, sf_dir)
    found = common.predictions(spark, sf_dir)
    predicted = rows.select("thread_id", common.vector_id().alias("vec_id")).join(found, "vec_id")
    return jobs.triage(
        rows,
        predicted,
        common.thread_neighbours(spark, sf_dir),
        template_draft,
        urgency=thread_signals(spark, sf_dir),
        turns="turns",
        confidence_threshold=CONFIDENCE,
        similarity_threshold=SIMILARITY,
    )


def sql_rules(confidence: float = CONFIDENCE, low: float = SIMILARITY) -> str:
    return f"""list_filter([
      CASE WHEN intent IN ('billing_payment', 'account_access', 'seller_complaint') THEN 'denylist' END,
      CASE WHEN confidence < {confidence}::DOUBLE THEN 'low_confidence' END,
      CASE WHEN coalesce(similarity, 0) < {low}::DOUBLE THEN 'low_similarity' END,
      CASE WHEN urgency >= 0.8 THEN 'high_urgency' END,
      CASE WHEN len(regexp_extract_all(message, '\\S+')) < 3 THEN 'too_short' END], lambda x: x IS NOT NULL)"""


TRIAGED = f"""{CLEAN},
{THREAD_NEIGHBOURS},
{PREDICTIONS},
inputs AS (
  SELECT c.thread_id, c.vec_id, t.customer_text, c.customer_text AS message, p.intent, p.confidence, n.similarity, n.brand_reply AS top_reply,
         CASE WHEN length(t.customer_text) >= 150 THEN CAST(c.vec_id % 11 AS DOUBLE) / 10.0 ELSE 0 END AS urgency,
         CASE WHEN length(t.customer_text) >= 150 AND c.vec_id % 4 = 0 THEN 'negative' ELSE 'neutral' END AS sentiment
  FROM clean c JOIN threads t ON t.thread_id = c.thread_id JOIN predictions p ON p.vec_id = c.vec_id
  LEFT JOIN thread_neighbours n ON n.thread_id = c.thread_id AND n.rank = 1),
ruled AS (SELECT *, {sql_rules()} AS rules FROM inputs),
decided AS (
  SELECT *, CASE WHEN len(rules) > 0 THEN 'escalate' ELSE 'auto_handle' END AS decision,
         CASE WHEN len(rules) > 0 THEN {sql_text(fixed.ESCALATED_MARKER)}
              ELSE 'We will look into ' || intent || ' within ' || (length(message) % 5 + 1) || ' business days, or you get a 50% refund.' END AS draft_reply
  FROM ruled),
precedents AS (SELECT thread_id, lower(string_agg(brand_reply, ' ' ORDER BY rank)) AS known, count(*) AS n FROM thread_neighbours GROUP BY 1),
hits AS ({" UNION ALL ".join(
    f"SELECT d.thread_id, unnest(regexp_extract_all(d.draft_reply, '(?i){pattern}')) AS hit, p.known FROM decided d "
    "LEFT JOIN precedents p ON p.thread_id = d.thread_id WHERE decision = 'auto_handle'"
    for pattern, _ in CONFIGURED
)}),
flagged AS (SELECT thread_id, count(*) AS n_flags FROM hits WHERE NOT contains(coalesce(known, ''), lower(hit)) GROUP BY 1)"""


@query(
    "triage_decisions",
    f"""WITH RECURSIVE {TRIAGED}
SELECT d.thread_id, md5(d.customer_text) AS input_digest, md5(message) AS message_digest, intent, CAST(round_even(confidence, 4) AS DOUBLE) AS confidence,
       decision, array_to_string(rules, ',') AS rules, draft_reply, coalesce(f.n_flags, 0) AS n_flags, coalesce(p.n, 0) AS n_retrieved,
       CAST(round_even(similarity, 3) AS DOUBLE) AS top_similarity, md5(substring(top_reply, 1, 100)) AS top_reply_digest,
       sentiment, CAST(round_even(urgency, 3) AS DOUBLE) AS urgency_score
FROM decided d LEFT JOIN flagged f ON f.thread_id = d.thread_id LEFT JOIN precedents p ON p.thread_id = d.thread_id""",
)
def triage_decisions(spark, sf_dir):
    """Messages to decisions: threads, redaction, prediction, retrieval, gate, draft, guardrails."""
    first = F.get("retrieved_examples", F.lit(0))
    return triaged(spark, sf_dir).select(
        "thread_id",
        F.md5("input_text").alias("input_digest"),
        F.md5("message").alias("message_digest"),
        "intent",
        "confidence",
        "decision",
        F.array_join("triggered_rules", ",").alias("rules"),
        "draft_reply",
        F.size("guardrail_flags").cast("long").alias("n_flags"),
        F.coalesce(F.size("examples"), F.lit(0)).cast("long").alias("n_retrieved"),
        first["similarity"].alias("top_similarity"),
        F.md5(first["brand_reply"]).alias("top_reply_digest"),
        "sentiment",
        "urgency_score",
    )


@query(
    "golden_set",
    f"""WITH RECURSIVE {CLEAN},
{THREAD_NEIGHBOURS},
{PREDICTIONS},
candidates AS (
  SELECT c.thread_id, c.customer_text, p.intent, coalesce(p.confidence, 0) AS confidence, coalesce(n.similarity, 0) AS top_similarity,
         CAST(len(regexp_extract_all(c.customer_text, '\\S+')) AS BIGINT) AS word_count,
         len(regexp_extract_all(c.customer_text, '\\S+')) < 10 OR coalesce(p.top2_gap, 0) < 0.15 OR coalesce(n.similarity, 0) < 0.5 AS is_edge
  FROM clean c LEFT JOIN predictions p ON p.vec_id = c.vec_id LEFT JOIN thread_neighbours n ON n.thread_id = c.thread_id AND n.rank = 1),
edges AS (SELECT * FROM candidates WHERE is_edge ORDER BY md5('42:' || thread_id), thread_id LIMIT 10),
classes AS (
  SELECT * FROM candidates WHERE thread_id NOT IN (SELECT thread_id FROM edges)
  QUALIFY row_number() OVER (PARTITION BY intent ORDER BY md5('42:' || thread_id), thread_id) <= 4),
golden AS (
  SELECT * FROM (SELECT *, 0 AS part FROM edges UNION ALL SELECT *, 1 FROM classes) ORDER BY part, md5('42:' || thread_id), thread_id LIMIT 50)
SELECT thread_id, md5(customer_text) AS digest, intent AS predicted_intent, confidence, round(top_similarity, 6) AS top_similarity, word_count,
       is_edge, '' AS human_intent, '' AS notes FROM golden""",
)
def golden_set(spark, sf_dir):
    """Candidates scored, flagged and sampled for labelling; target 50, four per intent."""
    rows = common.clean_threads(spark, sf_dir).withColumn("vec_id", common.vector_id())
    scores = rows.select("thread_id", "vec_id").join(common.scores(spark, sf_dir), "vec_id")
    best = common.thread_neighbours(spark, sf_dir).where("rank = 1")
    candidates = jobs.golden_candidates(rows, scores, best)
    chosen = jobs.build_golden_set(candidates, target=50, per_intent=4)
    return chosen.select(
        "thread_id",
        F.md5("customer_text").alias("digest"),
        "predicted_intent",
        "confidence",
        F.round("top_similarity", 6).alias("top_similarity"),
        F.col("word_count").cast("long").alias("word_count"),
        "is_edge",
        "human_intent",
        "notes",
    )


def labelled(spark, sf_dir):
    """(vec_id, human_intent) of every label: that of the vector of the same number, else one by number."""
    kinds = common.vectors(spark, sf_dir).select("vec_id", "label")
    golden = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("vec_id")).join(kinds, "vec_id", "left")
    kind = F.coalesce("label", (F.col("vec_id") % len(common.INTENT_NAMES)).cast("int"))
    return golden.select("vec_id", common.intent_of(kind).alias("human_intent"))


def simple_answers(spark, sf_dir, golden):
    """The simple baseline for all labels: a classifier taught by the larger part of them, and template replies."""
    docs = common.documents(spark, sf_dir, "doc_id", "text").withColumnRenamed("doc_id", "vec_id")
    rows = golden.join(docs, "vec_id")
    train, _ = stratified_split(rows, "vec_id", "human_intent")
    model = classify.fit_text_classifier(train, "vec_id", "text", "human_intent")
    replies = rows.select("vec_id", F.lit(fixed.CANNED_REPLY).alias("draft_reply"))
    return classify.simple_baseline(model, rows, "vec_id", "text", replies)


def report(spark, sf_dir, simple=False):
    """The report of all labels, next to the majority class and, if wanted, the simple baseline."""
    number = F.col("vec_id")
    golden = labelled(spark, sf_dir)
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    replies = docs.select(F.col("doc_id").alias("match_id"), F.col("text").alias("brand_reply"))
    retrieved = common.spread(common.neighbours(spark, sf_dir)).join(replies, "match_id")
    drafts = common.predictions(spark, sf_dir).select("vec_id", "intent", "confidence").join(
        docs.select(F.col("doc_id").alias("vec_id"), F.col("text").alias("draft_reply")), "vec_id", "left"
    )
    scores = [(number % step + 1).cast("int").alias(name) for step, name in zip((5, 4, 3, 2), fixed.JUDGE_DIMENSIONS)]
    total = sum((F.col(name) for name in fixed.JUDGE_DIMENSIONS[1:]), F.col(fixed.JUDGE_DIMENSIONS[0]))
    judged = golden.select("vec_id", *scores).withColumns(
        {
            "average": F.bround(total / F.lit(4.0), 2),
            "human_judge_score": F.when(number % 3 == 0, (number % 4 + 1).cast("int")),
        }
    )
    trivial = classify.majority_baseline(golden, "human_intent", golden.select("vec_id"))
    baselines = {"trivial": trivial}
    if simple:
        baselines["simple"] = simple_answers(spark, sf_dir, golden)
    return jobs.evaluation_report(golden, drafts, retrieved, judged, key="vec_id", baselines=baselines)


EVALUATED = f"""{PREDICTIONS},
truths AS (
  SELECT l.doc_id AS vec_id, {common.NAMES}[coalesce(e.label, l.doc_id % {len(common.INTENT_NAMES)}) + 1] AS truth
  FROM labels l LEFT JOIN embeddings e ON e.vec_id = l.doc_id),
kept AS (
  SELECT t.vec_id, t.truth, p.intent, coalesce(p.confidence, 0) AS confidence, coalesce(t.truth = p.intent, false) AS correct
  FROM truths t LEFT JOIN predictions p ON p.vec_id = t.vec_id),
seen AS (SELECT truth AS label FROM kept UNION SELECT intent FROM kept WHERE intent IS NOT NULL),
report AS (
  SELECT s.label, count(*) FILTER (WHERE x.truth = s.label AND x.intent = s.label) AS tp,
         count(*) FILTER (WHERE x.intent = s.label) AS predicted, count(*) FILTER (WHERE x.truth = s.label) AS support
  FROM seen s JOIN kept x ON x.truth = s.label OR x.intent = s.label GROUP BY 1),
per_class AS (
  SELECT label, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall, 2 * tp / (predicted + support) AS f1, support FROM report),
edges AS (SELECT i::INT AS bin, i * 0.1::DOUBLE AS low, CASE WHEN i = 9 THEN 1.0::DOUBLE ELSE (i + 1) * 0.1::DOUBLE END AS high FROM range(0, 10) t(i)),
bins AS (SELECT e.bin, count(*) AS n, avg(p.confidence) AS conf, avg(CAST(p.correct AS INT)) AS acc
         FROM kept p JOIN edges e ON p.confidence >= e.low AND p.confidence < e.high GROUP BY 1),
steps AS (SELECT i::INT AS step, 0.5::DOUBLE + i * 0.025000000000000022::DOUBLE AS threshold FROM range(0, 20) t(i)),
sweep AS (SELECT s.threshold, count(p.confidence) AS n_kept, count(*) FILTER (WHERE p.correct) AS n_right
          FROM steps s LEFT JOIN kept p ON p.confidence >= s.threshold GROUP BY 1),
found AS (SELECT n.vec_id, n.rank, n.similarity FROM neighbours n JOIN kept k ON k.vec_id = n.vec_id JOIN documents d ON d.doc_id = n.match_id),
per_query AS (
  SELECT k.vec_id, max(f.similarity) FILTER (WHERE f.rank = 1) AS top1, avg(f.similarity) AS topk
  FROM kept k LEFT JOIN found f ON f.vec_id = k.vec_id GROUP BY 1),
judged AS (
  SELECT vec_id % 5 + 1 AS a, vec_id % 4 + 1 AS b, vec_id % 3 + 1 AS c, vec_id % 2 + 1 AS d,
         round_even((vec_id % 5 + vec_id % 4 + vec_id % 3 + vec_id % 2 + 4) / 4.0::DOUBLE, 2) AS average,
         CASE WHEN vec_id % 3 = 0 THEN vec_id % 4 + 1 END AS human FROM kept),
pairs AS (SELECT human AS h, CAST(round_even(average, 0) AS INT) AS j FROM judged WHERE human IS NOT NULL),
agreed AS (SELECT count(*) AS n, avg(CAST(h = j AS INT)) AS po FROM pairs),
chance AS (SELECT sum(x.n * y.n) AS s FROM (SELECT h, count(*) AS n FROM pairs GROUP BY 1) x JOIN (SELECT j, count(*) AS n FROM pairs GROUP BY 1) y ON x.h = y.j),
counts AS (SELECT truth, count(*) AS n FROM kept GROUP BY 1),
trivial AS (SELECT count(*) AS labels, sum(n) AS n, max(n) AS top FROM counts),
rows AS (
  SELECT 'classification' AS section, 'n' AS metric, CAST(count(*) AS DOUBLE) AS value FROM kept
  UNION ALL SELECT 'classification', 'accuracy', avg(CAST(correct AS INT)) FROM kept
  UNION ALL SELECT 'classification', 'n_labels', count(*) FROM per_class
  UNION ALL SELECT 'classification', 'macro_precision', avg(precision) FROM per_class
  UNION ALL SELECT 'classification', 'macro_recall', avg(recall) FROM per_class
  UNION ALL SELECT 'classification', 'macro_f1', avg(f1) FROM per_class
  UNION ALL SELECT 'classification', 'weighted_precision', sum(precision * support) / sum(support) FROM per_class
  UNION ALL SELECT 'classification', 'weighted_recall', sum(recall * support) / sum(support) FROM per_class
  UNION ALL SELECT 'classification', 'weighted_f1', sum(f1 * support) / sum(support) FROM per_class
  UNION ALL SELECT 'per_class_f1', label, f1 FROM per_class UNION ALL SELECT 'per_class_support', label, support FROM per_class
  UNION ALL SELECT 'per_class_precision', label, precision FROM per_class UNION ALL SELECT 'per_class_recall', label, recall FROM per_class
  UNION ALL SELECT 'bin_n', CAST(bin AS VARCHAR), n FROM bins UNION ALL SELECT 'bin_confidence', CAST(bin AS VARCHAR), conf FROM bins
  UNION ALL SELECT 'bin_accuracy', CAST(bin AS VARCHAR), acc FROM bins
  UNION ALL SELECT 'calibration', 'ece', round_even(sum(n * abs(acc - conf)) / (SELECT count(*) FROM kept), 4) FROM bins
  UNION ALL SELECT 'calibration', 'threshold', coalesce(max(threshold) FILTER (WHERE n_right / nullif(n_kept, 0) >= 0.9), 0.9) FROM sweep
  UNION ALL SELECT 'retrieval', 'mean_top1_similarity', avg(top1) FROM per_query
  UNION ALL SELECT 'retrieval', 'mean_topk_similarity', avg(topk) FROM per_query
  UNION ALL SELECT 'retrieval', 'n_queries', count(*) FROM per_query
  UNION ALL SELECT 'retrieval', 'n_empty', count(*) FILTER (WHERE top1 IS NULL) FROM per_query
  UNION ALL SELECT 'judge', 'n', count(*) FROM judged
  UNION ALL SELECT 'judge', 'correctness', avg(a) FROM judged UNION ALL SELECT 'judge', 'tone', avg(b) FROM judged
  UNION ALL SELECT 'judge', 'groundedness', avg(c) FROM judged UNION ALL SELECT 'judge', 'conciseness', avg(d) FROM judged
  UNION ALL SELECT 'judge', 'average', avg(average) FROM judged
  UNION ALL SELECT 'agreement', 'n', n FROM agreed UNION ALL SELECT 'agreement', 'observed', po FROM agreed
  UNION ALL SELECT 'agreement', 'expected', s / (n * n) FROM agreed, chance
  UNION ALL SELECT 'agreement', 'kappa', (po - s / (n * n)) / (1 - s / (n * n)) FROM agreed, chance
  UNION ALL SELECT 'trivial', 'n', n FROM trivial UNION ALL SELECT 'trivial', 'accuracy', top / n FROM trivial
  UNION ALL SELECT 'trivial', 'macro_f1', 2 * (top / n) / (top / n + 1) / labels FROM trivial)"""


@query("evaluation_report", f"WITH {EVALUATED} SELECT section, metric, round(value, 6) AS value FROM rows")
def evaluation_report(spark, sf_dir):
    """All metrics but the text overlap, which SQL cannot give."""
    rows = report(spark, sf_dir).where(F.col("section") != "groundedness")
    return rows.select("section", "metric", F.round("value", 6).alias("value"))


@query("evaluation_report_nested")
def evaluation_report_nested(spark, sf_dir):
    """The whole report with both baselines as one nested row."""
    return jobs.nested_report(report(spark, sf_dir, simple=True)).select(F.to_json("report").alias("report"))


@query(
    "auto_labelled_golden",
    f"""WITH RECURSIVE {CLEAN},
{PREDICTIONS},
answers AS (
  SELECT c.thread_id, CASE WHEN c.vec_id % 5 = 0 THEN 'ERROR: timeout' WHEN c.vec_id % 5 = 1 THEN 'I think it is ' || upper(p.intent)
                           ELSE p.intent END AS answer
  FROM clean c JOIN predictions p ON p.vec_id = c.vec_id)
SELECT thread_id, {FIRST_NAME} AS human_intent, {sql_text(fixed.AUTO_LABEL_NOTE)} AS notes FROM answers""",
)
def auto_labelled_golden(spark, sf_dir):
    """Threads labelled from free-text answers, with a fallback label."""
    number = common.vector_id()
    rows = common.clean_threads(spark, sf_dir).withColumn("vec_id", number)
    found = rows.select("thread_id", "vec_id").join(common.predictions(spark, sf_dir).select("vec_id", "intent"), "vec_id")

    def answer(asked):
        text = (
            F.when(F.col("vec_id") % 5 == 0, "ERROR: timeout")
            .when(F.col("vec_id") % 5 == 1, F.concat(F.lit("I think it is "), F.upper("intent")))
            .otherwise(F.col("intent"))
        )
        return asked.join(found, "thread_id").select("thread_id", text.alias("raw"))

    golden = rows.join(found.select("thread_id"), "thread_id", "left_semi").select("thread_id", "customer_text")
    return jobs.auto_label_golden(golden, answer).select("thread_id", "human_intent", "notes")


@query(
    "escalation_evaluation",
    f"""WITH RECURSIVE {TRIAGED},
joined AS (
  SELECT decision, rules, CASE WHEN vec_id % 5 <> 0 THEN CASE WHEN vec_id % 2 = 0 THEN 'escalate' ELSE 'auto_handle' END END AS human FROM decided)
SELECT 'rate' AS metric, round(avg(CAST(decision = 'escalate' AS INT)), 6) AS value FROM joined
UNION ALL SELECT 'precision', round(count(*) FILTER (WHERE decision = 'escalate' AND human = 'escalate')
  / nullif(count(*) FILTER (WHERE decision = 'escalate' AND human IS NOT NULL), 0), 6) FROM joined
UNION ALL SELECT 'recall', round(count(*) FILTER (WHERE decision = 'escalate' AND human = 'escalate')
  / nullif(count(*) FILTER (WHERE human = 'escalate'), 0), 6) FROM joined
UNION ALL SELECT rule, CAST(count(*) AS DOUBLE) FROM (SELECT unnest(rules) AS rule FROM joined) GROUP BY 1""",
)
def escalation_evaluation(spark, sf_dir):
    """Gate quality against human decisions and the hit count of each rule."""
    rows = triaged(spark, sf_dir)
    number = common.vector_id()
    human = F.when(number % 5 != 0, F.when(number % 2 == 0, "escalate").otherwise("auto_handle"))
    golden = common.raw_threads(spark, sf_dir).select("thread_id", human.alias("human_escalate"))
    quality, rules = jobs.escalation_report(rows, golden)
    values = quality.select(
        F.inline(
            F.array(
                F.struct(F.lit("rate").alias("metric"), F.round("escalation_rate", 6).alias("value")),
                F.struct(F.lit("precision").alias("metric"), F.round("precision", 6).alias("value")),
                F.struct(F.lit("recall").alias("metric"), F.round("recall", 6).alias("value")),
            )
        )
    )
    return values.unionByName(rules.select(F.col("rule").alias("metric"), F.col("n").cast("double").alias("value")))


@query(
    "streamed_triage",
    f"""WITH RECURSIVE {CLEAN},
{PREDICTIONS},
corpus AS (SELECT c.thread_id, e.embedding FROM clean c JOIN embeddings e ON e.vec_id = c.vec_id WHERE regexp_matches(c.brand_reply, '\\S')),
best AS (
  SELECT q.vec_id, max(round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])), 6)) AS similarity
  FROM embeddings q, corpus c GROUP BY 1),
inputs AS (
  SELECT m.tweet_id, {sql_redact('m.text')} AS message, p.intent, coalesce(p.confidence, 0.0) AS confidence, b.similarity, 0.0 AS urgency
  FROM messages m LEFT JOIN predictions p ON p.vec_id = m.position // 1000000 LEFT JOIN best b ON b.vec_id = m.position // 1000000 WHERE m.inbound),
ruled AS (SELECT *, {sql_rules(CONFIDENCE, 0.9)} AS rules FROM inputs)
SELECT tweet_id, md5(message) AS digest, intent, CASE WHEN len(rules) > 0 THEN 'escalate' ELSE 'auto_handle' END AS decision,
       array_to_string(rules, ',') AS rules FROM ruled""",
)
def streamed_triage(spark, sf_dir):
    """Every customer message of a stream, with the same job as in batch."""
    corpus = threads.resolved(common.thread_vectors(spark, sf_dir))
    predicted = common.predictions(spark, sf_dir).select("vec_id", "intent", "confidence")
    vectors = common.vectors(spark, sf_dir).select("vec_id", "embedding")
    cells = similarity.corpus_cells(corpus)

    def handle(batch):
        rows = conversations_to_messages(batch).where("inbound").withColumn("vec_id", common.vector_id("tweet_id"))
        rows = rows.select("tweet_id", "vec_id", "text")
        found = similarity.knn(rows.join(vectors, "vec_id"), corpus, query_key="tweet_id", cells=cells)
        examples = found.join(corpus.select("thread_id", "customer_text", "brand_reply"), "thread_id")
        return jobs.triage(
            rows,
            rows.select("tweet_id", "vec_id").join(predicted, "vec_id"),
            examples.withColumnRenamed("thread_id", "match_id"),
            template_draft,
            key="tweet_id",
            text="text",
            confidence_threshold=CONFIDENCE,
            similarity_threshold=0.9,
        ).select(
            "tweet_id", F.md5("message").alias("digest"), "intent", "decision", F.array_join("triggered_rules", ",").alias("rules")
        )

    output = scratch_path(spark, "triaged")
    stream = message_stream(spark, f"{sf_dir}/conversations*.parquet", "conv_id long, turn long, role string, text string")
    start_triage(stream, handle, output, scratch_path(spark, "stream")).awaitTermination()
    return spark.read.parquet(output).drop("batch")
