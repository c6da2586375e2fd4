"""Parse the text a model returned, with JSON functions and plain column logic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.functions.text import let, strip

LABEL_ARRAY = "array<struct<index:int,intent:string>>"
URGENCY_FIELDS = "sentiment string, urgency string, urgency_score double"
JUDGE_FIELDS = ", ".join(f"{name} string" for name in fixed.JUDGE_DIMENSIONS) + ", rationale string"


def unfence(raw: Column) -> Column:
    """Text inside a leading Markdown code fence, without its "json" tag; other text unchanged."""

    def inner(text: Column) -> Column:
        inside = F.split_part(text, F.lit("```"), F.lit(2))
        untagged = F.when(inside.startswith("json"), F.substring(inside, 5, 2**31 - 1)).otherwise(inside)
        return F.when(text.startswith("```"), untagged).otherwise(text)

    return let(strip(raw), inner)


def is_json(text: Column) -> Column:
    return F.coalesce(F.try_parse_json(text).isNotNull(), F.lit(False))


def parse_json(raw: Column, schema: str) -> Column:
    """Typed value of a model answer; null when the answer is not valid JSON."""
    return let(unfence(raw), lambda text: F.when(is_json(text), F.from_json(text, schema)))


def batch_labels(answers: DataFrame, members: DataFrame, batch: str = "batch", raw: str = "raw") -> DataFrame:
    """One label for each message from the label array answered for its batch.

    ``members`` holds (batch, index, ...) with a 1-based index. Entries outside the batch are
    ignored, the last entry for an index wins, and messages without an entry get null.
    """
    entries = answers.select(batch, F.posexplode(parse_json(F.col(raw), LABEL_ARRAY)).alias("_position", "_entry"))
    labels = (
        entries.select(batch, F.col("_entry.index").alias("index"), "_position", F.col("_entry.intent").alias("intent"))
        .groupBy(batch, "index")
        .agg(F.max_by("intent", "_position").alias("intent"))
    )
    return members.join(labels, [batch, "index"], "left")


def judge_scores(raw: Column) -> Column:
    """Struct of the four scores, their average, the rationale and an error mark.

    A missing dimension scores 3. An answer that is not a JSON object, or that holds a score
    which is not a number, gives the default scores. Scores are not clamped.
    """
    dimensions = fixed.JUDGE_DIMENSIONS
    default = F.lit(fixed.JUDGE_DEFAULT)

    def read(parsed: Column) -> Column:
        numbers = {name: parsed[name].try_cast("double") for name in dimensions}
        numeric = [parsed[name].isNull() | numbers[name].isNotNull() for name in dimensions]
        usable = reduce(lambda left, right: left & right, numeric, parsed.isNotNull())
        return F.struct(
            F.coalesce(usable, F.lit(False)).alias("usable"),
            *[numbers[name].cast("int").alias(name) for name in dimensions],
            parsed["rationale"].alias("rationale"),
        )

    def score(row: Column) -> Column:
        scores = [F.when(row["usable"], F.coalesce(row[name], default)).otherwise(default) for name in dimensions]
        total = reduce(lambda left, right: left + right, scores)
        return F.struct(
            *[column.alias(name) for name, column in zip(dimensions, scores)],
            F.bround(total / F.lit(float(len(scores))), 2).alias("average"),
            F.when(row["usable"], F.coalesce(row["rationale"], F.lit("")))
            .otherwise(fixed.JUDGE_FAILURE)
            .alias("rationale"),
            F.when(~row["usable"], "parse_failure").alias("error"),
        )

    def object_only(text: Column) -> Column:
        return F.when(is_json(text) & F.startswith(strip(text), F.lit("{")), F.from_json(text, JUDGE_FIELDS))

    return let(let(let(unfence(raw), object_only), read), score)


def urgency_signals(raw: Column) -> Column:
    """Struct of sentiment, urgency and urgency_score; neutral, low and 0 when unusable."""

    def read(parsed: Column) -> Column:
        return F.struct(
            F.coalesce(parsed["sentiment"], F.lit("neutral")).alias("sentiment"),
            F.when(parsed.isNull(), "low").otherwise(parsed["urgency"]).alias("urgency"),
            F.coalesce(parsed["urgency_score"], F.lit(0.0)).alias("urgency_score"),
        )

    return let(parse_json(raw, URGENCY_FIELDS), read)


def label_in_answer(answer: Column, fallback: str | None = fixed.FALLBACK_INTENT) -> Column:
    """First taxonomy name, in taxonomy order, that occurs in a free-text answer."""
    lowered = F.lower(answer)
    hits = [F.when(F.contains(lowered, F.lit(name.lower())), F.lit(name)) for name in fixed.INTENT_NAMES]
    return F.coalesce(*hits, F.lit(fallback))


def normalise_label(typed: Column, predicted: Column) -> Column:
    """Label meant by typed text: the prediction, an exact name, or the only name containing it."""
    wanted = F.lower(strip(F.coalesce(typed, F.lit(""))))
    names = F.array(*[F.lit(name) for name in fixed.INTENT_NAMES])
    exact = F.get(F.filter(names, lambda name: F.lower(name) == wanted), F.lit(0))
    partial = F.filter(names, lambda name: F.contains(F.lower(name), wanted))
    return (
        F.when((wanted == "") | (wanted == F.lower(predicted)), predicted)
        .when(exact.isNotNull(), exact)
        .when(F.size(partial) == 1, F.get(partial, F.lit(0)))
    )


def label_status(typed: Column, predicted: Column) -> Column:
    """accepted, exact, partial, ambiguous or unknown."""
    wanted = F.lower(strip(F.coalesce(typed, F.lit(""))))
    names = F.array(*[F.lit(name) for name in fixed.INTENT_NAMES])
    matches = F.size(F.filter(names, lambda name: F.contains(F.lower(name), wanted)))
    return (
        F.when((wanted == "") | (wanted == F.lower(predicted)), "accepted")
        .when(F.array_contains(names, wanted), "exact")
        .when(matches == 1, "partial")
        .when(matches > 1, "ambiguous")
        .otherwise("unknown")
    )
