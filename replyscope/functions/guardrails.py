"""Guardrails: claims in a draft reply that no retrieved precedent supports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.functions.text import regex


def unsupported_claims(reply: Column, precedents: Column, patterns: Iterable[str] | None = None) -> Column:
    """Array of flags, one for each match of each pattern that is missing from the precedents.

    ``precedents`` is an array of replies. A text hit by two patterns is flagged twice.
    """
    if patterns:
        labelled = [(pattern, fixed.CUSTOM_CLAIM_LABEL) for pattern in patterns]
    else:
        labelled = fixed.CLAIM_PATTERNS
    known = F.lower(F.array_join(F.coalesce(precedents, F.array().cast("array<string>")), " ", ""))
    draft = F.coalesce(reply, F.lit(""))

    def flags(pattern: str, label: str) -> Column:
        matches = F.regexp_extract_all(draft, F.lit(regex(pattern, ignore_case=True)), F.lit(0))
        return F.transform(
            F.filter(matches, lambda match: ~F.contains(known, F.lower(match))),
            lambda match: F.struct(
                F.lit(label).alias("pattern_type"),
                match.alias("matched_text"),
                F.lit(False).alias("grounded"),
                F.concat(
                    F.lit("Unverifiable claim detected: '"),
                    match,
                    F.lit(f"' (type: {label}) not found in retrieved precedents."),
                ).alias("message"),
            ),
        )

    return F.concat(*[flags(pattern, label) for pattern, label in labelled])


def guardrail_flags(
    df: DataFrame, key: str, reply: str = "draft_reply", precedents: str = "precedents", patterns=None
) -> DataFrame:
    """One row for each unsupported claim."""
    found = unsupported_claims(F.col(reply), F.col(precedents), patterns)
    return df.select(key, F.inline(found))


def reply_safety(
    df: DataFrame, reply: str = "draft_reply", precedents: str = "precedents", patterns=None
) -> DataFrame:
    """Add n_flags and is_safe."""
    found = unsupported_claims(F.col(reply), F.col(precedents), patterns)
    return df.withColumn("n_flags", F.size(found)).withColumn("is_safe", F.col("n_flags") == 0)
