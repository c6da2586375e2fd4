"""Redaction of personal data with built-in regular expression functions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import takewhile
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope.fixed_values import REDACTION_RULES
from replyscope.functions.text import is_blank, regex, strip

# Text without which a rule cannot match. No token contains it, so the test on the original
# text holds for every later step as well.
NEEDED = {"email": "@", "url": "://", "handle": "@"}
RULES = {name: (regex(pattern, ignore_case), token) for name, pattern, ignore_case, token in REDACTION_RULES}


def redact(text: Column, rules: Iterable[str] | None = None) -> Column:
    """Replace personal data by tokens and strip; null becomes "" and blank text stays as it is.

    ``rules`` selects and orders rules by name; unknown names are skipped and an empty
    selection means all rules.
    """
    filled = F.coalesce(text, F.lit(""))
    chosen = [name for name in (list(rules or []) or RULES) if name in RULES]
    guarded = list(takewhile(NEEDED.__contains__, chosen))
    first = filled
    if guarded:
        possible = reduce(or_, [F.contains(filled, F.lit(NEEDED[name])) for name in guarded])
        first = F.when(possible, reduce(apply_rule, guarded, filled)).otherwise(filled)
    replaced = reduce(apply_rule, chosen[len(guarded) :], first)
    return F.when(is_blank(filled), filled).otherwise(strip(replaced))


def apply_rule(text: Column, name: str) -> Column:
    return F.regexp_replace(text, *RULES[name])


def redact_columns(df: DataFrame, columns: Iterable[str], rules: Iterable[str] | None = None) -> DataFrame:
    """Redact several text columns in one projection; columns that do not exist are skipped."""
    present = [name for name in columns if name in df.columns]
    rules = None if rules is None else list(rules)
    return df.withColumns({name: redact(F.col(name), rules) for name in present})


def redact_turns(turns: Column, rules: Iterable[str] | None = None) -> Column:
    """Redact the text of every turn in a turn array."""
    rules = None if rules is None else list(rules)
    return F.transform(turns, lambda turn: turn.withField("text", redact(turn["text"], rules)))


def redaction_audit(df: DataFrame, original: str, redacted: str) -> DataFrame:
    """Per rule: matches before, matches after and the difference, in one pass over the table."""
    totals = []
    for name, (pattern, _) in RULES.items():
        for side, column in (("before", original), ("after", redacted)):
            matches = F.regexp_count(F.coalesce(F.col(column), F.lit("")), F.lit(pattern))
            if name in NEEDED:
                matches = F.when(F.contains(F.col(column), F.lit(NEEDED[name])), matches)
            totals.append(F.coalesce(F.sum(matches), F.lit(0)).cast("long").alias(f"{side}_{name}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("pattern"),
                F.col(f"before_{name}").alias("matches_before"),
                F.col(f"after_{name}").alias("matches_after"),
                (F.col(f"before_{name}") - F.col(f"after_{name}")).alias("replaced"),
            )
            for name in RULES
        ]
    )
    return df.agg(*totals).select(F.inline(rows))
