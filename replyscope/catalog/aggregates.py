"""Aggregates: brand numbers, labels, classification, calibration, agreement."""

from __future__ import annotations

from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.catalog import common
from replyscope.catalog.common import CLEAN, MESSAGES, NAMES, PREDICTIONS, query, sql_redact, sql_text, table
from replyscope.catalog.tables import NOISY, noisy_labels
from replyscope.fixed_values import REDACTION_RULES
from replyscope.functions.gate import escalation_gate, escalation_quality, rule_counts
from replyscope.functions.model_output import judge_scores
from replyscope.functions.redaction import redact, redaction_audit
from replyscope.operators import brands, calibration, classify, clusters, labelling, metrics
from replyscope.operators.ranking import hash_sample
from replyscope.operators.sampling import edge_flags
from replyscope.plans.jobs import prepare_threads, sample_summary
from replyscope.functions.overlap import groundedness


@query(
    "messages_per_brand",
    f"WITH {MESSAGES} SELECT author_id, count(*) AS outbound_sent FROM messages WHERE NOT inbound GROUP BY 1",
)
def messages_per_brand(spark, sf_dir):
    return brands.outbound_counts(common.messages(spark, sf_dir))


@query(
    "answered_per_brand",
    f"""WITH {MESSAGES}
SELECT author_id, count(DISTINCT parent) AS threads_with_reply FROM messages
WHERE NOT inbound AND parent IN (SELECT tweet_id FROM messages WHERE inbound) GROUP BY 1""",
)
def answered_per_brand(spark, sf_dir):
    return brands.answered_counts(common.messages(spark, sf_dir))


STATS = f"""{MESSAGES},
sent AS (SELECT author_id, count(*) AS outbound_sent FROM messages WHERE NOT inbound GROUP BY 1),
answered AS (
  SELECT author_id, count(DISTINCT parent) AS n FROM messages
  WHERE NOT inbound AND parent IN (SELECT tweet_id FROM messages WHERE inbound) GROUP BY 1),
stats AS (
  SELECT s.author_id AS brand, outbound_sent, coalesce(n, 0) AS threads_with_reply,
         CAST(round_even(coalesce(n, 0) / greatest(outbound_sent, 1) * 100.0::DOUBLE, 1) AS DOUBLE) AS thread_completeness_pct
  FROM sent s LEFT JOIN answered a ON a.author_id = s.author_id)"""


@query("thread_completeness", f"WITH {STATS} SELECT brand, thread_completeness_pct FROM stats")
def thread_completeness(spark, sf_dir):
    return brands.brand_stats(common.messages(spark, sf_dir)).select("brand", "thread_completeness_pct")


@query(
    "corpus_profile",
    f"WITH {MESSAGES} SELECT count(*) AS n_messages, count(DISTINCT author_id) AS n_authors FROM messages",
)
def corpus_profile(spark, sf_dir):
    return brands.corpus_profile(common.messages(spark, sf_dir))


@query(
    "label_distribution",
    f"WITH {NOISY} SELECT intent, count(*) AS n FROM noisy WHERE list_contains({NAMES}, intent) GROUP BY 1",
)
def label_distribution(spark, sf_dir):
    rows = noisy_labels(spark, sf_dir)
    return labelling.label_distribution(rows.where(F.col("intent").isin(fixed.INTENT_NAMES)))


@query(
    "labelling_success",
    f"""WITH {NOISY}, marked AS (SELECT coalesce(list_contains({NAMES}, intent), false) AS good FROM noisy)
SELECT count(*) AS total_attempted, count(*) FILTER (WHERE good) AS total_labeled,
       count(*) FILTER (WHERE NOT good) AS n_failed, avg(CAST(good AS INT)) AS success_rate FROM marked""",
)
def labelling_success(spark, sf_dir):
    return labelling.labelling_stats(noisy_labels(spark, sf_dir))


@query(
    "majority_class",
    f"""WITH {PREDICTIONS}, counts AS (SELECT truth, count(*) AS n FROM predictions GROUP BY 1)
SELECT truth AS majority_intent, n AS n_majority, CAST((SELECT sum(n) FROM counts) AS BIGINT) AS n_total,
       round(n / (SELECT sum(n) FROM counts), 6) AS share FROM counts ORDER BY n DESC, truth LIMIT 1""",
)
def majority(spark, sf_dir):
    found = classify.majority_class(common.predictions(spark, sf_dir), "truth")
    return found.withColumn("share", F.round("share", 6))


def document_clusters(spark, sf_dir):
    """Documents with their source as cluster; every seventh is noise."""
    number = F.regexp_extract("source", r"(\d+)", 1).cast("int")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 7 == 0, -1).otherwise(number).alias("cluster")
    )


CLUSTERS = """clusters AS (
  SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN -1 ELSE CAST(regexp_extract(source, '(\\d+)', 1) AS INT) END AS cluster FROM documents)"""


@query("cluster_sizes", f"WITH {CLUSTERS} SELECT cluster, count(*) AS size FROM clusters WHERE cluster >= 0 GROUP BY 1")
def cluster_sizes(spark, sf_dir):
    return clusters.cluster_sizes(document_clusters(spark, sf_dir))


@query(
    "cluster_stats",
    f"""WITH {CLUSTERS}
SELECT count(DISTINCT cluster) FILTER (WHERE cluster >= 0) AS n_clusters, count(*) FILTER (WHERE cluster = -1) AS noise_count,
       count(*) AS total_points FROM clusters""",
)
def cluster_stats(spark, sf_dir):
    return clusters.cluster_stats(document_clusters(spark, sf_dir))


@query("accuracy", f"WITH {PREDICTIONS} SELECT count(*) AS n, round(avg(CAST(correct AS INT)), 6) AS accuracy FROM predictions")
def accuracy(spark, sf_dir):
    found = metrics.accuracy(common.predictions(spark, sf_dir), "truth", "intent")
    return found.withColumn("accuracy", F.round("accuracy", 6))


@query(
    "confusion_matrix",
    f"""WITH {PREDICTIONS},
grid AS (SELECT t.truth, p.predicted FROM (SELECT unnest({NAMES}) AS truth) t, (SELECT unnest({NAMES}) AS predicted) p)
SELECT g.truth, g.predicted, count(x.vec_id) AS n FROM grid g
LEFT JOIN predictions x ON x.truth = g.truth AND x.intent = g.predicted GROUP BY 1, 2""",
)
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(common.predictions(spark, sf_dir), "truth", "intent", fixed.INTENT_NAMES)


@query(
    "confusion_matrix_wide",
    f"""WITH {PREDICTIONS}, t AS (SELECT unnest({NAMES}) AS truth)
SELECT t.truth, {", ".join(f"count(*) FILTER (WHERE x.intent = '{name}') AS {name}" for name in fixed.INTENT_NAMES)}
FROM t LEFT JOIN predictions x ON x.truth = t.truth GROUP BY 1""",
)
def confusion_matrix_wide(spark, sf_dir):
    return metrics.wide_confusion(common.predictions(spark, sf_dir), "truth", "intent", fixed.INTENT_NAMES)


REPORT = f"""{PREDICTIONS},
seen AS (SELECT truth AS label FROM predictions UNION SELECT intent FROM predictions),
report AS (
  SELECT s.label, count(*) FILTER (WHERE x.truth = s.label AND x.intent = s.label) AS tp,
         count(*) FILTER (WHERE x.intent = s.label) AS predicted, count(*) FILTER (WHERE x.truth = s.label) AS support
  FROM seen s JOIN predictions x ON x.truth = s.label OR x.intent = s.label GROUP BY 1),
per_class AS (
  SELECT label, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE tp / support END AS recall, 2 * tp / (predicted + support) AS f1, support FROM report)"""


@query(
    "class_report",
    f"WITH {REPORT} SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM per_class",
)
def class_report(spark, sf_dir):
    found = metrics.class_report(common.predictions(spark, sf_dir), "truth", "intent")
    return found.withColumns({name: F.round(name, 6) for name in ("precision", "recall", "f1")})


@query(
    "macro_averages",
    f"""WITH {REPORT}
SELECT count(*) AS n_labels, round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall,
       round(avg(f1), 6) AS macro_f1, round(sum(precision * support) / sum(support), 6) AS weighted_precision,
       round(sum(recall * support) / sum(support), 6) AS weighted_recall, round(sum(f1 * support) / sum(support), 6) AS weighted_f1
FROM per_class""",
)
def macro_averages(spark, sf_dir):
    found = metrics.macro_averages(common.predictions(spark, sf_dir), "truth", "intent")
    return found.withColumns({name: F.round(name, 6) for name in found.columns if name != "n_labels"})


def retrieval_inputs(spark, sf_dir):
    """The numbers of all vectors and documents as queries; a result with the same label is relevant.

    A document whose number no vector has finds nothing.
    """
    labels = common.vectors(spark, sf_dir).select("vec_id", "label")
    asked = labels.select("vec_id").union(table(spark, sf_dir, "documents").select("doc_id")).distinct()
    found = (
        common.neighbours(spark, sf_dir)
        .join(labels, "vec_id")
        .join(labels.select(F.col("vec_id").alias("match_id"), F.col("label").alias("match_label")), "match_id")
        .withColumn("relevant", F.col("label") == F.col("match_label"))
    )
    return asked, found


RETRIEVED = f"""{common.NEIGHBOURS},
asked AS (SELECT vec_id FROM embeddings UNION SELECT doc_id FROM documents),
per_query AS (
  SELECT a.vec_id, max(n.similarity) FILTER (WHERE n.rank = 1) AS top1, avg(n.similarity) AS topk,
         coalesce(bool_or(n.rank = 1 AND m.label = e.label), false) AS hit
  FROM asked a LEFT JOIN embeddings e ON e.vec_id = a.vec_id LEFT JOIN neighbours n ON n.vec_id = a.vec_id
  LEFT JOIN embeddings m ON m.vec_id = n.match_id GROUP BY 1)"""


@query(
    "retrieval_metrics",
    f"""WITH {RETRIEVED}
SELECT round(avg(top1), 6) AS mean_top1_similarity, round(avg(topk), 6) AS mean_topk_similarity, count(*) AS n_queries,
       count(*) FILTER (WHERE top1 IS NULL) AS n_empty FROM per_query""",
)
def retrieval_metrics(spark, sf_dir):
    found = metrics.retrieval_metrics(*retrieval_inputs(spark, sf_dir), "vec_id")
    return found.withColumns({name: F.round(name, 6) for name in ("mean_top1_similarity", "mean_topk_similarity")})


@query("hit_rate_at_1", f"WITH {RETRIEVED} SELECT round(avg(CAST(hit AS INT)), 6) AS hit_rate_at_1 FROM per_query")
def hit_rate(spark, sf_dir):
    found = metrics.retrieval_metrics(*retrieval_inputs(spark, sf_dir), "vec_id", relevant="relevant")
    return found.select(F.round("hit_rate_at_1", 6).alias("hit_rate_at_1"))


BINS = f"""{PREDICTIONS},
edges AS (SELECT i::INT AS bin, i * 0.1::DOUBLE AS low, CASE WHEN i = 9 THEN 1.0::DOUBLE ELSE (i + 1) * 0.1::DOUBLE END AS high
          FROM range(0, 10) t(i)),
bins AS (
  SELECT e.bin, count(*) AS n, avg(p.confidence) AS conf, avg(CAST(p.correct AS INT)) AS acc
  FROM predictions p JOIN edges e ON p.confidence >= e.low AND p.confidence < e.high GROUP BY 1)"""


@query(
    "calibration_bins",
    f"WITH {BINS} SELECT bin, n, round(conf, 6) AS mean_confidence, round(acc, 6) AS accuracy FROM bins",
)
def calibration_bins(spark, sf_dir):
    found = calibration.calibration_bins(common.predictions(spark, sf_dir), "confidence", "correct")
    return found.withColumns({name: F.round(name, 6) for name in ("mean_confidence", "accuracy")})


@query(
    "expected_calibration_error",
    f"""WITH {BINS}
SELECT (SELECT count(*) FROM predictions) AS n,
       CAST(round_even(sum(n * abs(acc - conf)) / (SELECT count(*) FROM predictions), 4) AS DOUBLE) AS ece FROM bins""",
)
def calibration_error(spark, sf_dir):
    return calibration.expected_calibration_error(common.predictions(spark, sf_dir), "confidence", "correct")


SWEEP = f"""{PREDICTIONS},
steps AS (SELECT i::INT AS step, 0.5::DOUBLE + i * 0.025000000000000022::DOUBLE AS threshold FROM range(0, 20) t(i)),
doubled AS (SELECT least(confidence * 2.2, 1.0) AS confidence, correct FROM predictions),
sweep AS (
  SELECT s.step, s.threshold, count(p.confidence) AS n_kept, count(*) FILTER (WHERE p.correct) AS n_right
  FROM steps s LEFT JOIN doubled p ON p.confidence >= s.threshold GROUP BY 1, 2)"""


def stretched(spark, sf_dir):
    """Confidences stretched so that they reach all thresholds."""
    return common.predictions(spark, sf_dir).withColumn("confidence", F.least(F.col("confidence") * 2.2, F.lit(1.0)))


@query(
    "threshold_sweep",
    f"""WITH {SWEEP}
SELECT step, round(threshold, 6) AS threshold, n_kept, n_right, round(n_right / nullif(n_kept, 0), 6) AS precision,
       round(n_kept / (SELECT count(*) FROM predictions), 6) AS coverage FROM sweep""",
)
def threshold_sweep(spark, sf_dir):
    found = calibration.threshold_sweep(stretched(spark, sf_dir), "confidence", "correct")
    return found.withColumns({name: F.round(name, 6) for name in ("threshold", "precision", "coverage")})


@query(
    "best_threshold",
    f"""WITH {SWEEP}
SELECT round(coalesce(max(threshold) FILTER (WHERE n_right / nullif(n_kept, 0) >= 0.12), 0.9), 6) AS threshold FROM sweep""",
)
def best_threshold(spark, sf_dir):
    """The neighbours of random vectors predict little, so the target precision is low here."""
    found = calibration.best_threshold(stretched(spark, sf_dir), "confidence", "correct", target=0.12)
    return found.select(F.round("threshold", 6).alias("threshold"))


def model_judgements(spark, sf_dir):
    """A model answer in the judge's format for every message: plain, fenced, incomplete or broken."""
    number = F.col("position")

    def digit(step: int):
        return (F.floor(number / step) % 5 + 1).cast("string")

    full = F.concat(
        F.lit('{"correctness": '), digit(1), F.lit(', "tone": '), digit(2), F.lit(', "groundedness": '), digit(3),
        F.lit(', "conciseness": '), digit(5), F.lit(', "rationale": "case '), number.cast("string"), F.lit('"}'),
    )
    short = F.concat(F.lit('{"correctness": '), digit(1), F.lit(', "groundedness": '), digit(3), F.lit("}"))
    raw = (
        F.when(number % 13 == 0, F.concat(F.lit("I would say "), digit(1)))
        .when(number % 11 == 0, short)
        .when(number % 7 == 0, F.concat(F.lit("```json\n"), full, F.lit("\n```")))
        .otherwise(full)
    )
    human = F.when(number % 4 != 0, (number % 5 + 1).cast("int"))
    return common.messages(spark, sf_dir).select("tweet_id", raw.alias("raw"), human.alias("human_judge_score"))


JUDGED = f"""{MESSAGES},
answers AS (
  SELECT tweet_id, position AS p, CASE WHEN position % 4 <> 0 THEN CAST(position % 5 + 1 AS INT) END AS human_judge_score,
         CAST(p % 5 + 1 AS VARCHAR) AS a, CAST(p // 2 % 5 + 1 AS VARCHAR) AS b, CAST(p // 3 % 5 + 1 AS VARCHAR) AS c,
         CAST(p // 5 % 5 + 1 AS VARCHAR) AS d
  FROM (SELECT *, position AS p FROM messages)),
raws AS (
  SELECT tweet_id, human_judge_score, CASE
    WHEN p % 13 = 0 THEN 'I would say ' || a
    WHEN p % 11 = 0 THEN '{{"correctness": ' || a || ', "groundedness": ' || c || '}}'
    WHEN p % 7 = 0 THEN '```json' || chr(10) || '{{"correctness": ' || a || ', "tone": ' || b || ', "groundedness": ' || c
      || ', "conciseness": ' || d || ', "rationale": "case ' || p || '"}}' || chr(10) || '```'
    ELSE '{{"correctness": ' || a || ', "tone": ' || b || ', "groundedness": ' || c
      || ', "conciseness": ' || d || ', "rationale": "case ' || p || '"}}' END AS raw FROM answers),
inner_text AS (
  SELECT tweet_id, human_judge_score, CASE WHEN starts_with(raw, '```')
    THEN regexp_replace(split_part(raw, '```', 2), '^json', '') ELSE raw END AS body FROM raws),
parsed AS (
  SELECT tweet_id, human_judge_score, json_valid(body) AS good, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS j FROM inner_text),
judged AS (
  SELECT tweet_id, human_judge_score, good,
         coalesce(CAST(j->>'correctness' AS INT), 3) AS correctness, coalesce(CAST(j->>'tone' AS INT), 3) AS tone,
         coalesce(CAST(j->>'groundedness' AS INT), 3) AS groundedness, coalesce(CAST(j->>'conciseness' AS INT), 3) AS conciseness,
         CASE WHEN good THEN coalesce(j->>'rationale', '') ELSE {sql_text(fixed.JUDGE_FAILURE)} END AS rationale FROM parsed),
rated AS (
  SELECT *, CAST(round_even((correctness + tone + groundedness + conciseness) / 4.0::DOUBLE, 2) AS DOUBLE) AS average FROM judged)"""


def judged_rows(spark, sf_dir):
    rows = model_judgements(spark, sf_dir).withColumn("_judge", judge_scores(F.col("raw")))
    return rows.select("tweet_id", "human_judge_score", "_judge.*")


@query(
    "judge_scores",
    f"""WITH {JUDGED}
SELECT tweet_id, correctness, tone, groundedness, conciseness, average, rationale,
       CASE WHEN NOT good THEN 'parse_failure' END AS error FROM rated""",
)
def judge_score_rows(spark, sf_dir):
    return judged_rows(spark, sf_dir).drop("human_judge_score")


@query(
    "judge_human_pairs",
    f"WITH {JUDGED} SELECT tweet_id, human_judge_score, average FROM rated WHERE human_judge_score IS NOT NULL",
)
def judge_human_pairs(spark, sf_dir):
    """Judge and human score of the same message, joined by key."""
    rows = model_judgements(spark, sf_dir)
    human = rows.where(F.col("human_judge_score").isNotNull()).select("tweet_id", "human_judge_score")
    judged = rows.select("tweet_id", judge_scores(F.col("raw"))["average"].alias("average"))
    return human.join(judged, "tweet_id")


@query(
    "judge_summary",
    f"""WITH {JUDGED}
SELECT count(*) AS n, round(avg(correctness), 6) AS correctness, round(avg(tone), 6) AS tone,
       round(avg(groundedness), 6) AS groundedness, round(avg(conciseness), 6) AS conciseness, round(avg(average), 6) AS average FROM rated""",
)
def judge_summary(spark, sf_dir):
    found = metrics.judge_summary(judged_rows(spark, sf_dir))
    return found.withColumns({name: F.round(name, 6) for name in [*fixed.JUDGE_DIMENSIONS, "average"]})


@query(
    "cohens_kappa",
    f"""WITH {JUDGED},
pairs AS (SELECT human_judge_score AS h, CAST(round_even(average, 0) AS INT) AS j FROM rated WHERE human_judge_score IS NOT NULL),
total AS (SELECT count(*) AS n, avg(CAST(h = j AS INT)) AS po FROM pairs),
expected AS (
  SELECT sum(a.n * b.n) AS s FROM (SELECT h, count(*) AS n FROM pairs GROUP BY 1) a
  JOIN (SELECT j, count(*) AS n FROM pairs GROUP BY 1) b ON a.h = b.j)
SELECT n, round(po, 6) AS observed, round(s / (n * n), 6) AS expected, round((po - s / (n * n)) / (1 - s / (n * n)), 6) AS kappa
FROM total, expected""",
)
def cohens_kappa(spark, sf_dir):
    found = metrics.cohens_kappa(judged_rows(spark, sf_dir), "human_judge_score", "average")
    return found.withColumns({name: F.round(name, 6) for name in ("observed", "expected", "kappa")})


def gated_messages(spark, sf_dir):
    """Gate decisions on all documents, with signals derived from predictions and neighbours where there are any."""
    best = common.neighbours(spark, sf_dir).where("rank = 1").select("vec_id", "similarity")
    texts = common.documents(spark, sf_dir, "doc_id", "text", "lang").withColumnRenamed("doc_id", "vec_id")
    number = F.col("vec_id")
    rows = (
        texts.join(common.predictions(spark, sf_dir), "vec_id", "left")
        .join(best, "vec_id", "left")
        .fillna(0.0, ["confidence", "similarity"])
        .select(
            "vec_id",
            F.when(number % 17 == 0, "two words").otherwise(redact(F.col("text"))).alias("message"),
            "intent",
            F.least(F.col("confidence") * 3, F.lit(1.0)).alias("confidence"),
            F.when(number % 19 != 0, F.least(F.col("similarity") * 1.7, F.lit(1.0))).alias("similarity"),
            F.when(number % 3 != 0, (number % 21) / F.lit(20.0)).alias("urgency"),
            F.when(number % 4 != 0, "negative").alias("mood"),
            F.when(number % 5 != 0, F.col("lang")).alias("lang"),
            F.when(number % 6 != 0, F.when(number % 2 == 0, "escalate").otherwise("auto_handle")).alias("human_escalate"),
        )
    )
    return escalation_gate(rows, top_similarity="similarity", urgency="urgency", sentiment="mood", language="lang")


GATED = f"""{PREDICTIONS},
signals AS (
  SELECT d.doc_id AS vec_id, CASE WHEN d.doc_id % 17 = 0 THEN 'two words' ELSE {sql_redact('d.text')} END AS message, p.intent,
         least(coalesce(p.confidence, 0) * 3, 1.0) AS confidence,
         CASE WHEN d.doc_id % 19 <> 0 THEN least(coalesce(n.similarity, 0) * 1.7::DOUBLE, 1.0) ELSE 0 END AS similarity,
         CASE WHEN d.doc_id % 3 <> 0 THEN (d.doc_id % 21) / 20.0::DOUBLE ELSE 0 END AS urgency,
         CASE WHEN d.doc_id % 5 <> 0 THEN d.lang END AS lang,
         CASE WHEN d.doc_id % 4 <> 0 THEN 'negative' ELSE 'neutral' END AS sentiment,
         CASE WHEN d.doc_id % 6 <> 0 THEN CASE WHEN d.doc_id % 2 = 0 THEN 'escalate' ELSE 'auto_handle' END END AS human_escalate
  FROM documents d LEFT JOIN predictions p ON p.vec_id = d.doc_id LEFT JOIN neighbours n ON n.vec_id = d.doc_id AND n.rank = 1),
ruled AS (
  SELECT *, list_filter([
      CASE WHEN lang <> 'en' THEN 'non_english' END,
      CASE WHEN intent IN ('billing_payment', 'account_access', 'seller_complaint') THEN 'denylist' END,
      CASE WHEN confidence < 0.7 THEN 'low_confidence' END,
      CASE WHEN similarity < 0.6 THEN 'low_similarity' END,
      CASE WHEN urgency >= 0.8 THEN 'high_urgency' END,
      CASE WHEN len(regexp_extract_all(message, '\\S+')) < 3 THEN 'too_short' END], lambda x: x IS NOT NULL) AS rules
  FROM signals),
gated AS (SELECT *, CASE WHEN len(rules) > 0 THEN 'escalate' ELSE 'auto_handle' END AS decision FROM ruled)"""


@query(
    "escalation_gate",
    f"""WITH {GATED}
SELECT vec_id, decision, array_to_string(rules, ',') AS rules, CAST(round_even(confidence, 3) AS DOUBLE) AS confidence,
       CAST(round_even(similarity, 3) AS DOUBLE) AS top_similarity, CAST(round_even(urgency, 3) AS DOUBLE) AS urgency_score,
       sentiment, CAST(len(regexp_extract_all(message, '\\S+')) AS BIGINT) AS word_count FROM gated""",
)
def gate_rows(spark, sf_dir):
    return gated_messages(spark, sf_dir).select(
        "vec_id",
        "decision",
        F.array_join("triggered_rules", ",").alias("rules"),
        "signals.confidence",
        "signals.top_similarity",
        "signals.urgency_score",
        "signals.sentiment",
        F.col("signals.word_count").cast("long").alias("word_count"),
    )


@query("rule_counts", f"WITH {GATED} SELECT rule, count(*) AS n FROM (SELECT unnest(rules) AS rule FROM gated) GROUP BY 1")
def gate_rule_counts(spark, sf_dir):
    return rule_counts(gated_messages(spark, sf_dir))


@query(
    "escalation_quality",
    f"""WITH {GATED}
SELECT count(*) AS n, round(avg(CAST(decision = 'escalate' AS INT)), 6) AS escalation_rate,
       round(count(*) FILTER (WHERE decision = 'escalate' AND human_escalate = 'escalate')
             / nullif(count(*) FILTER (WHERE decision = 'escalate' AND human_escalate IS NOT NULL), 0), 6) AS precision,
       round(count(*) FILTER (WHERE decision = 'escalate' AND human_escalate = 'escalate')
             / nullif(count(*) FILTER (WHERE human_escalate = 'escalate'), 0), 6) AS recall FROM gated""",
)
def gate_quality(spark, sf_dir):
    found = escalation_quality(gated_messages(spark, sf_dir))
    return found.withColumns({name: F.round(name, 6) for name in ("escalation_rate", "precision", "recall")})


def reply_pairs(spark, sf_dir):
    """Each document as draft, with its neighbours' documents as precedents; some drafts are markers."""
    docs = common.documents(spark, sf_dir, "doc_id", "text")
    drafts = docs.select(
        F.col("doc_id").alias("vec_id"),
        F.when(F.col("doc_id") % 10 == 0, fixed.ESCALATED_MARKER).otherwise(F.col("text")).alias("draft_reply"),
    )
    replies = docs.select(F.col("doc_id").alias("match_id"), F.col("text").alias("brand_reply"))
    pairs = common.spread(common.neighbours(spark, sf_dir)).join(replies, "match_id").select("vec_id", "match_id", "brand_reply")
    return drafts, pairs


@query("groundedness")
def groundedness_rows(spark, sf_dir):
    """Mean ROUGE-L of every document against the documents of its neighbours."""
    drafts, pairs = reply_pairs(spark, sf_dir)
    return groundedness(drafts, pairs, "vec_id").withColumn("groundedness", F.round("groundedness", 6))


@query("mean_groundedness")
def mean_groundedness(spark, sf_dir):
    drafts, pairs = reply_pairs(spark, sf_dir)
    return groundedness(drafts, pairs, "vec_id").agg(
        F.count("*").alias("n"), F.round(F.avg("groundedness"), 6).alias("mean_rouge_l")
    )


def matches(column: str, name: str) -> str:
    pattern, ignore_case = next((rule[1], rule[2]) for rule in REDACTION_RULES if rule[0] == name)
    return f"sum(len(regexp_extract_all({column}, '{'(?i)' if ignore_case else ''}{pattern}')))::BIGINT"


@query(
    "redaction_audit",
    f"WITH cleaned AS (SELECT text, {sql_redact('text')} AS redacted FROM documents), "
    + "counts AS ("
    + " UNION ALL ".join(
        f"SELECT '{rule[0]}' AS pattern, {matches('text', rule[0])} AS matches_before, {matches('redacted', rule[0])} AS matches_after FROM cleaned"
        for rule in REDACTION_RULES
    )
    + ") SELECT *, matches_before - matches_after AS replaced FROM counts",
)
def audit(spark, sf_dir):
    docs = common.documents(spark, sf_dir, "text").withColumn("redacted", redact(F.col("text")))
    return redaction_audit(docs, "text", "redacted")


@query(
    "preparation_summary",
    f"""WITH RECURSIVE {CLEAN}
SELECT count(*) AS n_threads, count(*) FILTER (WHERE regexp_matches(brand_reply, '\\S')) AS n_resolved,
       count(customer_text) AS n_messages FROM clean""",
)
def preparation_summary(spark, sf_dir):
    return prepare_threads(common.messages(spark, sf_dir)).summary()


@query(
    "sample_summary",
    f"""WITH {PREDICTIONS}, golden AS (
  SELECT top2_gap < 0.15 AS is_edge FROM predictions ORDER BY md5('42:' || vec_id) LIMIT 200)
SELECT count(*) AS n, count(*) FILTER (WHERE is_edge) AS n_edge, round(avg(CAST(is_edge AS INT)), 6) AS edge_share FROM golden""",
)
def golden_summary(spark, sf_dir):
    rows = common.predictions(spark, sf_dir).withColumns({"word_count": F.lit(20), "top_similarity": F.lit(0.9)})
    golden = hash_sample(edge_flags(rows), "vec_id", 200, fixed.RANDOM_SEED)
    return sample_summary(golden).withColumn("edge_share", F.round("edge_share", 6))
