"""Text column expressions shared by several operators."""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: white space as the string methods of Python see it
SPACE = r"[\s\x1c-\x1f]"
WORD = r"[^\s\x1c-\x1f]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value computed once per row, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def regex(pattern: str, ignore_case: bool = False) -> str:
    """The pattern with Unicode word, digit and space classes switched on."""
    return ("(?iU)" if ignore_case else "(?U)") + pattern


def strip(text: Column) -> Column:
    return F.regexp_replace(text, regex(rf"\A{SPACE}+|{SPACE}+\z"), "")


def is_blank(text: Column) -> Column:
    return ~text.rlike(regex(WORD))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(regex(WORD))), F.lit(0))


def hash_key(identifier: Column, seed: int) -> Column:
    """Order that is random to the eye, equal on every run, and the same in any SQL engine."""
    return F.md5(F.concat(F.lit(f"{seed}:"), identifier.cast("string")))


def fill(template: str, **values: Column) -> Column:
    """Fill the {names} of a text template with columns."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(values[name].cast("string"))
    return F.concat(*parts)
