"""Whole jobs, composed of the operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.functions import gate, guardrails, prompts
from replyscope.functions.language import keep_language
from replyscope.functions.model_output import batch_labels, label_in_answer
from replyscope.functions.overlap import groundedness
from replyscope.functions.redaction import redact, redact_columns, redact_turns
from replyscope.functions.text import word_count
from replyscope.operators import calibration, classify, clusters, metrics
from replyscope.operators.brands import brand_stats, completeness_band
from replyscope.operators.density import cluster_density
from replyscope.operators.labelling import batch_texts, in_batches, label_distribution, labelling_stats
from replyscope.operators.ranking import hash_sample
from replyscope.operators.sampling import edge_flags, golden_sample, group_samples
from replyscope.operators.similarity import knn, without_held_out
from replyscope.operators.threads import recent_customer_text, reconstruct_threads, resolved
from replyscope.session import cut_lineage
from replyscope.sources.sinks import write_table
from replyscope.sources.taxonomy import known_intents, with_intent_details


def brand_report(messages: DataFrame, top_n: int = fixed.BRAND_TOP_N) -> DataFrame:
    """Brand statistics with the completeness band."""
    stats = brand_stats(messages, top_n)
    return stats.withColumn("band", completeness_band(F.col("thread_completeness_pct")))


@dataclass(frozen=True)
class PreparedThreads:
    threads: DataFrame
    customer_messages: DataFrame
    resolved_pairs: DataFrame

    def summary(self) -> DataFrame:
        """Thread, resolved and message counts in one pass."""
        return self.threads.agg(
            F.count("*").alias("n_threads"),
            F.count(F.when(has_text("brand_reply"), 1)).alias("n_resolved"),
            F.count("customer_text").alias("n_messages"),
        )


def has_text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit("")).rlike(r"(?U)[^\s\x1c-\x1f]")


def redact_threads(threads: DataFrame) -> DataFrame:
    """Redact the texts of threads, also inside the turns."""
    return redact_columns(threads, ["customer_text", "brand_reply"]).withColumn("turns", redact_turns(F.col("turns")))


def prepare_threads(
    messages: DataFrame,
    brand: str | None = None,
    sample_size: int | None = None,
    min_length: int = fixed.MIN_THREAD_LENGTH,
    seed: int = fixed.RANDOM_SEED,
) -> PreparedThreads:
    """Reconstruct threads and redact them."""
    return prepared(redact_threads(reconstruct_threads(messages, brand, min_length, sample_size, seed)))


def prepared(clean: DataFrame) -> PreparedThreads:
    return PreparedThreads(
        clean,
        clean.select("thread_id", "customer_text").dropna(),
        resolved(clean).select("thread_id", "customer_text", "brand_reply", "n_turns"),
    )


def save_prepared_threads(messages: DataFrame, path: str, **options) -> PreparedThreads:
    """Write threads, customer messages and resolved pairs below ``path``.

    Threads are computed once; the other two tables start from the stored one.
    """
    write_table(prepare_threads(messages, **options).threads, f"{path}/threads")
    stored = prepared(messages.sparkSession.read.parquet(f"{path}/threads"))
    write_table(stored.customer_messages, f"{path}/customer_messages")
    write_table(stored.resolved_pairs, f"{path}/resolved_pairs")
    return stored


def discover_clusters(
    vectors: DataFrame,
    key: str = "thread_id",
    vector: str = "embedding",
    n_sample: int | None = None,
    method: str = "kmeans",
    k: int = fixed.N_CLUSTERS,
    per_cluster: int = 10,
    seed: int = fixed.RANDOM_SEED,
    **density,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(labels, statistics, sample rows per cluster) of all vectors, or of a seeded sample of ``n_sample``."""
    sample = cut_lineage(hash_sample(vectors, key, n_sample, seed))
    found = (
        clusters.cluster_kmeans(sample, key, vector, k, seed)
        if method == "kmeans"
        else cluster_density(sample, key, vector, **density)
    )
    labels = cut_lineage(found)
    samples = group_samples(labels, key, "cluster", per_cluster, seed).join(sample.drop(vector), key)
    return labels, clusters.cluster_stats(labels), samples


def weak_labels(
    messages: DataFrame,
    answer: Callable[[DataFrame], DataFrame],
    order: str,
    text: str = "text",
    batch_size: int = fixed.LABEL_BATCH,
    n_samples: int | None = None,
    key: str = "tweet_id",
    detect: Callable[[Column], Column] | None = None,
    seed: int = fixed.RANDOM_SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(labelled rows, statistics, distribution) of messages labelled in batches by a model.

    ``n_samples`` draws a seeded sample first; ``detect`` then gives the language of a text, and only
    English messages and those of unknown language are asked about. ``answer`` maps (batch, texts,
    prompt) to (batch, raw), the raw model answers. Texts are redacted before they enter a prompt; the
    labelled rows keep their own.
    """
    chosen = hash_sample(messages, key, n_samples, seed)
    if detect is not None:
        filled = F.coalesce(F.col(text), F.lit(""))
        chosen = cut_lineage(keep_language(chosen.withColumn("_language", detect(filled)), "_language").drop("_language"))
    batched = cut_lineage(in_batches(chosen, order, batch_size))
    asked = batch_texts(batched.withColumn(text, redact(F.col(text))), text).withColumn("prompt", prompts.labelling_prompt(F.col("texts")))
    labelled = cut_lineage(batch_labels(answer(asked), batched))
    valid = known_intents(labelled)
    return valid, labelling_stats(labelled), label_distribution(valid)


def retrieval_table(
    pairs: DataFrame, held_out: DataFrame | None, encode: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Resolved pairs outside the held-out set, with the vector of the customer text."""
    kept = pairs if held_out is None else without_held_out(pairs, held_out)
    return encode(resolved(kept))


def retrieve_for_threads(
    threads: DataFrame, corpus: DataFrame, encode: Callable[[DataFrame], DataFrame], k: int = fixed.TOP_K, **options
) -> DataFrame:
    """Resolved threads similar to the last three customer turns of each thread, not to itself.

    ``encode`` adds the vector of the column ``query_text``.
    """
    asked = threads.select("thread_id", recent_customer_text(F.col("turns")).alias("query_text"))
    known = corpus.withColumnRenamed("thread_id", "match_id")
    return knn(encode(asked), known, k, query_key="thread_id", corpus_key="match_id", exclude_same_id=True, **options)


def nested_examples(retrieved: DataFrame, key: str) -> DataFrame:
    """(key, examples): the retrieved rows of each query as an array in rank order, k at most."""
    row = F.struct("rank", "similarity", "customer_text", "brand_reply", "match_id")
    return retrieved.groupBy(key).agg(F.array_sort(F.collect_list(row)).alias("examples"))


def compact_examples(examples: Column) -> Column:
    """Ranks 1 to 3 with rounded similarity and the first 100 characters of the reply."""
    return F.transform(
        F.slice(examples, 1, 3),
        lambda row: F.struct(
            row["rank"].alias("rank"),
            F.bround(row["similarity"], 3).alias("similarity"),
            F.substring(row["brand_reply"], 1, 100).alias("brand_reply"),
        ),
    )


def signals_and_gate(
    messages: DataFrame,
    predictions: DataFrame,
    retrieved: DataFrame,
    key: str,
    text: str,
    urgency: DataFrame | None = None,
    language: str | None = None,
    **thresholds,
) -> DataFrame:
    """Redacted message, intent details, examples, urgency and the gate decision per message.

    A message without a prediction stays, with confidence 0, so the gate escalates it.
    """
    rows = (
        messages.withColumn("message", redact(F.col(text)))
        .join(predictions.select(key, "intent", "confidence"), key, "left")
        .fillna(0.0, ["confidence"])
        .join(nested_examples(retrieved, key), key, "left")
    )
    if urgency is not None:
        rows = rows.join(urgency.select(key, "sentiment", "urgency_score"), key, "left")
    else:
        rows = rows.withColumns({"sentiment": F.lit(None).cast("string"), "urgency_score": F.lit(None).cast("double")})
    rows = with_intent_details(rows).withColumns(
        {
            "top_similarity": F.coalesce(F.get("examples", F.lit(0))["similarity"], F.lit(0.0)),
            "n_retrieved": F.coalesce(F.size("examples"), F.lit(0)),
            "urgency_score": F.coalesce("urgency_score", F.lit(0.0)),
            "sentiment": F.coalesce("sentiment", F.lit("neutral")),
        }
    )
    return gate.escalation_gate(
        rows, n_retrieved="n_retrieved", urgency="urgency_score", sentiment="sentiment", language=language, **thresholds
    )


def triage(
    messages: DataFrame,
    predictions: DataFrame,
    retrieved: DataFrame,
    draft: Callable[[DataFrame], DataFrame],
    key: str = "thread_id",
    text: str = "customer_text",
    urgency: DataFrame | None = None,
    turns: str | None = None,
    brand: str = fixed.DEFAULT_BRAND,
    patterns: list[str] | None = fixed.CONFIGURED_CLAIM_PATTERNS,
    **gate_options,
) -> DataFrame:
    """Decision, draft reply and guardrail flags for a table of messages.

    ``draft`` maps (key, prompt, ...) to (key, draft_reply). It sees only the messages the gate
    passes; the others get a marker. Messages and turns are redacted before they enter a prompt.
    """
    gated = cut_lineage(signals_and_gate(messages, predictions, retrieved, key, text, urgency, **gate_options))
    passed = gated.where(F.col("decision") == "auto_handle")
    prompt = prompts.reply_chat(
        F.col("message"),
        F.col("intent"),
        F.col("description"),
        F.col("examples"),
        redact_turns(F.col(turns)) if turns else None,
        F.lit(brand),
        F.col("sentiment"),
    )
    drafts = draft(passed.withColumn("prompt", prompt)).select(key, "draft_reply")
    answered = passed.join(drafts, key, "left").withColumn(
        "draft_reply", F.coalesce("draft_reply", F.lit(fixed.GENERATION_FALLBACK))
    )
    rest = gated.where(F.col("decision") != "auto_handle").withColumn("draft_reply", F.lit(fixed.ESCALATED_MARKER))
    known = F.col("examples")["brand_reply"]
    claims = guardrails.unsupported_claims(F.col("draft_reply"), known, patterns)
    no_flags = F.array().cast("array<string>")
    rows = answered.withColumn("guardrail_flags", claims["message"]).unionByName(
        rest.withColumn("guardrail_flags", no_flags)
    )
    return rows.select(
        key,
        F.col(text).alias("input_text"),
        "message",
        "intent",
        F.bround("confidence", 4).alias("confidence"),
        "decision",
        "reason",
        "triggered_rules",
        "draft_reply",
        "guardrail_flags",
        compact_examples(F.col("examples")).alias("retrieved_examples"),
        "examples",
        "sentiment",
        F.bround("urgency_score", 3).alias("urgency_score"),
    )


def golden_candidates(
    messages: DataFrame,
    scores: DataFrame,
    best: DataFrame,
    key: str = "thread_id",
    text: str = "customer_text",
    n_candidates: int | None = None,
    seed: int = fixed.RANDOM_SEED,
) -> DataFrame:
    """Messages, or a seeded sample of ``n_candidates``, with prediction, best similarity, word count and edge flags.

    ``scores`` is the long score table and ``best`` holds (key, similarity) of the first
    retrieved row. A message without a score stays, without an intent, as ambiguous with confidence 0.
    """
    sample = cut_lineage(hash_sample(messages, key, n_candidates, seed))
    wanted = scores.join(sample.select(key), key, "left_semi")
    predicted = classify.best_label(wanted, key).withColumnRenamed("intent", "predicted_intent")
    rows = (
        sample.join(predicted, key, "left")
        .join(best.select(key, F.col("similarity").alias("top_similarity")), key, "left")
        .fillna(0.0, ["confidence", "top2_gap", "top_similarity"])
        .withColumn("word_count", word_count(F.col(text)))
    )
    return edge_flags(rows)


def build_golden_set(candidates: DataFrame, key: str = "thread_id", text: str = "customer_text", **options) -> DataFrame:
    """The sample a person will label, with empty label and notes."""
    return golden_sample(candidates, key, **options).select(
        key,
        text,
        "predicted_intent",
        "confidence",
        "top_similarity",
        "word_count",
        "is_edge",
        F.lit("").alias("human_intent"),
        F.lit("").alias("notes"),
    )


def sample_summary(golden: DataFrame) -> DataFrame:
    edge = F.coalesce(F.col("is_edge"), F.lit(False)).cast("int")
    return golden.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(edge), F.lit(0)).alias("n_edge"),
        F.try_divide(F.sum(edge).cast("double"), F.count("*")).alias("edge_share"),
    )


def long_form(df: DataFrame, section: str) -> DataFrame:
    """(section, metric, value) from a one-row table of numbers."""
    pairs = [F.struct(F.lit(name).alias("metric"), F.col(name).cast("double").alias("value")) for name in df.columns]
    return df.select(F.lit(section).alias("section"), F.inline(F.array(*pairs)))


def by_name(df: DataFrame, name: str, section: str) -> DataFrame:
    """(section, metric, value) from a table of numbers per name: one section per column, the name as metric."""
    values = [
        F.struct(F.lit(f"{section}_{column}").alias("section"), F.col(column).cast("double").alias("value"))
        for column in df.columns
        if column != name
    ]
    rows = df.select(F.col(name).cast("string").alias("metric"), F.inline(F.array(*values)))
    return rows.select("section", "metric", "value")


def evaluation_report(
    golden: DataFrame,
    predictions: DataFrame,
    retrieved: DataFrame,
    judged: DataFrame | None = None,
    key: str = "thread_id",
    truth: str = "human_intent",
    baselines: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """All metrics as (section, metric, value) rows.

    ``golden`` holds (key, truth), ``predictions`` (key, intent, confidence, draft_reply),
    ``retrieved`` (key, rank, similarity, brand_reply), ``judged`` (key, scores, average and
    optionally human_judge_score) and ``baselines`` further prediction tables. A label without a
    prediction counts as wrong with confidence 0, in the baselines too.
    """
    rows = cut_lineage(
        golden.where(F.col(truth).isNotNull())
        .join(predictions, key, "left")
        .withColumns(
            {
                "confidence": F.coalesce("confidence", F.lit(0.0)),
                "draft_reply": F.coalesce("draft_reply", F.lit("")),
                "_correct": F.coalesce(F.col("intent") == F.col(truth), F.lit(False)),
            }
        )
    )
    found = retrieved.join(rows.select(key), key, "left_semi")
    overlap = groundedness(rows, found, key).agg(F.avg("groundedness").alias("mean_rouge_l"))
    parts = [
        long_form(metrics.accuracy(rows, truth, "intent"), "classification"),
        long_form(metrics.macro_averages(rows, truth, "intent"), "classification"),
        by_name(metrics.class_report(rows, truth, "intent"), "label", "per_class"),
        by_name(calibration.calibration_bins(rows, "confidence", "_correct").withColumnRenamed("mean_confidence", "confidence"), "bin", "bin"),
        long_form(calibration.expected_calibration_error(rows, "confidence", "_correct").select("ece"), "calibration"),
        long_form(calibration.best_threshold(rows, "confidence", "_correct").select("threshold"), "calibration"),
        long_form(metrics.retrieval_metrics(rows, found, key), "retrieval"),
        long_form(overlap, "groundedness"),
    ]
    if judged is not None:
        scored = judged.join(rows.select(key), key, "left_semi")
        parts.append(long_form(metrics.judge_summary(scored), "judge"))
        if "human_judge_score" in judged.columns:
            parts.append(long_form(metrics.cohens_kappa(scored, "human_judge_score", "average"), "agreement"))
    for name, other in (baselines or {}).items():
        # Two metrics read the answers, which may come from a model over whole texts
        compared = cut_lineage(rows.select(key, truth).join(other.select(key, "intent"), key, "left"))
        parts.append(long_form(metrics.accuracy(compared, truth, "intent"), name))
        parts.append(long_form(metrics.macro_averages(compared, truth, "intent").select("macro_f1"), name))
    return reduce(DataFrame.unionByName, parts)


def nested_report(report: DataFrame) -> DataFrame:
    """The report as one row of maps, ready for a JSON sink. It has one entry per metric."""
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric", "value"))))
    sections = report.groupBy("section").agg(entries.alias("metrics"))
    return sections.agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("section", F.to_json("metrics"))))).alias("report")
    )


def auto_label_golden(
    golden: DataFrame, answer: Callable[[DataFrame], DataFrame], key: str = "thread_id", text: str = "customer_text"
) -> DataFrame:
    """Golden rows labelled by a model; ``answer`` maps (key, prompt) to (key, raw)."""
    asked = golden.select(key, F.col(text), prompts.single_label_prompt(F.col(text)).alias("prompt"))
    answers = answer(asked).select(key, "raw")
    return (
        golden.drop("human_intent", "notes")
        .join(answers, key, "left")
        .withColumns({"human_intent": label_in_answer(F.col("raw")), "notes": F.lit(fixed.AUTO_LABEL_NOTE)})
        .drop("raw")
    )


def escalation_report(
    predictions: DataFrame, golden: DataFrame, key: str = "thread_id"
) -> tuple[DataFrame, DataFrame]:
    """(quality against human decisions, rule counts)."""
    rows = predictions.join(golden.select(key, "human_escalate"), key, "left")
    return gate.escalation_quality(rows), gate.rule_counts(predictions)
