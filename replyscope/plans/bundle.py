"""Triage from text alone: the fitted parts in one stored folder, applied in batch and on a stream."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.functions.language import language_detector, language_profiles
from replyscope.functions.redaction import redact
from replyscope.operators import classify, encoder
from replyscope.operators.classify import TextClassifier
from replyscope.plans import jobs
from replyscope.session import cut_lineage
from replyscope.sources.vectors import VectorIndex, read_index, write_index

INFO = "own_encoder boolean, classifier boolean, languages boolean"
VOTE_DIGITS = 6

# Adds the column ``embedding`` to a table, from the text column of the given name
Encode = Callable[[DataFrame, str], DataFrame]


@dataclass(frozen=True)
class TriageBundle:
    """Index of resolved threads, encoder, and optionally a classifier and language profiles."""

    index: VectorIndex
    encode: Encode
    classifier: TextClassifier | None
    profiles: DataFrame | None

    def signals(
        self, messages: DataFrame, key: str, text: str, k: int = fixed.TOP_K
    ) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(messages with ``_language``, predictions, retrieved), all from the redacted text.

        Without a classifier the labels of the retrieved threads vote with their similarity, rounded
        to six digits so that ties are plain; threads without a label have no vote. Without profiles
        the language is null, as for a text without a known trigram, and its rule passes.
        """
        clean = messages.select(key, redact(F.col(text)).alias("_message"))
        encoded = cut_lineage(self.encode(clean, "_message").select(key, "_message", "embedding"))
        retrieved = cut_lineage(self.index.search(encoded, key, k))
        if self.classifier is not None:
            predictions = self.classifier.predict(encoded, key, "_message")
        else:
            votes = classify.neighbour_scores(retrieved.where("intent is not null"), key, "intent")
            predictions = classify.best_label(votes.withColumn("score", F.round("score", VOTE_DIGITS)), key)
        language = F.lit(None).cast("string")
        if self.profiles is not None:
            language = language_detector(self.profiles)(redact(F.col(text)))
        return messages.withColumn("_language", language), predictions, retrieved

    def triage(
        self,
        messages: DataFrame,
        draft: Callable[[DataFrame], DataFrame],
        key: str = "thread_id",
        text: str = "customer_text",
        k: int = fixed.TOP_K,
        **options,
    ) -> DataFrame:
        """Decisions, drafts and flags for a table of (key, text), which needs nothing else.

        The options are those of ``jobs.triage``. Keys must be unique. A null text counts as empty;
        an empty table gives an empty result.
        """
        rows, predictions, retrieved = self.signals(messages, key, text, k)
        return jobs.triage(rows, predictions, retrieved, draft, key=key, text=text, language="_language", **options)


def fit_bundle(
    threads: DataFrame,
    path: str,
    *,
    labels: DataFrame | None = None,
    held_out: DataFrame | None = None,
    languages: DataFrame | None = None,
    encode: Encode | None = None,
    classifier: bool = True,
    dimensions: int = encoder.DIMENSIONS,
    k: int = fixed.TOP_K,
    **fit,
) -> TriageBundle:
    """Fit and store all parts below ``path``, from redacted threads to an index of vectors.

    ``labels`` holds (thread_id, intent), one row per labelled thread; threads of ``held_out`` are
    neither searched nor learned from. ``languages`` holds (text, lang). ``encode`` is the caller's
    own encoder and must be given to ``load_bundle`` again; by default hashed TF-IDF is fitted.
    With ``classifier`` a text classifier is fitted on the labelled threads (``fit`` holds its
    options), otherwise similar threads vote.
    """
    spark = threads.sparkSession
    own = encode is not None
    if not own:
        model = encoder.fit_encoder(threads, "customer_text", dimensions)
        model.write().overwrite().save(f"{path}/encoder")
        encode = hashed_encoder(model)
    if labels is None:
        labels = threads.select("thread_id", F.lit(None).cast("string").alias("intent")).limit(0)
    pairs = jobs.retrieval_table(threads, held_out, lambda kept: encode(kept, "customer_text"))
    write_index(pairs.join(labels, "thread_id", "left"), f"{path}/index", k, extra=("intent",))
    if classifier:
        known = threads if held_out is None else threads.join(held_out.select("thread_id"), "thread_id", "left_anti")
        taught = known.join(labels.where("intent is not null"), "thread_id")
        classify.fit_text_classifier(taught, "thread_id", "customer_text", "intent", **fit).save(f"{path}/classifier")
    if languages is not None:
        language_profiles(languages, "text", "lang").write.mode("overwrite").parquet(f"{path}/languages")
    info = spark.createDataFrame([(own, classifier, languages is not None)], INFO)
    info.write.mode("overwrite").json(f"{path}/info")
    return load_bundle(spark, path, encode if own else None)


def load_bundle(spark: SparkSession, path: str, encode: Encode | None = None) -> TriageBundle:
    """A stored bundle. The corpus and the vocabulary stay where they are."""
    info = spark.read.schema(INFO).json(f"{path}/info").first()
    if info["own_encoder"] and encode is None:
        raise ValueError("this bundle was fitted with the caller's encoder, which must be given again")
    return TriageBundle(
        read_index(spark, f"{path}/index"),
        encode if info["own_encoder"] else hashed_encoder(PipelineModel.load(f"{path}/encoder")),
        TextClassifier.load(spark, f"{path}/classifier") if info["classifier"] else None,
        spark.read.parquet(f"{path}/languages") if info["languages"] else None,
    )


def hashed_encoder(model: PipelineModel) -> Encode:
    return lambda df, text: encoder.encode(df, text, model)
