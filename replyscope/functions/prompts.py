"""Chat prompts as columns: array of struct(role, content)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.functions.gate import two_digits
from replyscope.functions.text import fill


def taxonomy_text() -> str:
    lines = [f"{number}. {row[0]}: {row[1]}" for number, row in enumerate(fixed.TAXONOMY, 1)]
    return "\n".join([fixed.TAXONOMY_HEADER, *lines])


def chat(system: Column, user: Column) -> Column:
    return F.array(
        F.struct(F.lit("system").alias("role"), system.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def labelling_prompt(texts: Column) -> Column:
    """User prompt for one batch; ``texts`` is the ordered array of messages."""
    numbered = F.transform(texts, lambda text, i: F.concat((i + 1).cast("string"), F.lit(". "), text))
    return fill(fixed.LABEL_PROMPT, taxonomy=F.lit(taxonomy_text()), messages=F.array_join(numbered, "\n"))


def labelling_chat(texts: Column) -> Column:
    return chat(F.lit(fixed.LABEL_SYSTEM), labelling_prompt(texts))


def single_label_prompt(message: Column) -> Column:
    names = "\n".join(f"- {name}" for name in fixed.INTENT_NAMES)
    return fill(fixed.SINGLE_LABEL_PROMPT, intents=F.lit(names), message=message)


def history_text(turns: Column, brand: Column) -> Column:
    """The last six turns as "role: text" lines; "" unless there is more than one turn.

    A turn without an inbound flag counts as the brand's.
    """
    last = F.slice(turns, F.greatest(F.size(turns) - 5, F.lit(1)), F.lit(6))
    lines = F.transform(
        last,
        lambda turn: F.concat(
            F.when(F.coalesce(turn["inbound"], F.lit(False)), F.lit("Customer")).otherwise(brand),
            F.lit(": "),
            turn["text"],
        ),
    )
    return F.when(F.coalesce(F.size(turns), F.lit(0)) > 1, F.array_join(lines, "\n")).otherwise(F.lit(""))


def example_lines(examples: Column, template: str, empty: str) -> Column:
    blocks = F.transform(
        examples,
        lambda example: fill(
            template,
            rank=example["rank"],
            similarity=two_digits(example["similarity"]),
            customer_text=example["customer_text"],
            brand_reply=example["brand_reply"],
        ),
    )
    return F.when(F.coalesce(F.size(examples), F.lit(0)) > 0, F.array_join(blocks, "\n\n")).otherwise(F.lit(empty))


def reply_chat(
    message: Column,
    intent: Column,
    description: Column,
    examples: Column,
    turns: Column | None = None,
    brand: Column | None = None,
    sentiment: Column | None = None,
) -> Column:
    """Reply generation prompt; ``examples`` is an array of retrieved rows in rank order."""
    brand = F.lit(fixed.DEFAULT_BRAND) if brand is None else brand
    sentiment = F.lit("neutral") if sentiment is None else sentiment
    note = (
        F.when(sentiment == "urgent", fixed.URGENT_NOTE)
        .when(sentiment == "negative", fixed.NEGATIVE_NOTE)
        .otherwise("")
    )
    lines = F.lit("") if turns is None else history_text(turns, brand)
    history = F.when(lines != "", F.concat(F.lit(fixed.HISTORY_HEADER), lines, F.lit("\n"))).otherwise("")
    return chat(
        fill(fixed.REPLY_SYSTEM, brand=brand, sentiment_note=note),
        fill(
            fixed.REPLY_USER,
            intent=intent,
            description=description,
            context=example_lines(examples, fixed.REPLY_EXAMPLE, fixed.NO_PRECEDENTS),
            history=history,
            message=message,
        ),
    )


def judge_chat(message: Column, draft: Column, examples: Column, intent: Column) -> Column:
    return chat(
        F.lit(fixed.JUDGE_SYSTEM),
        fill(
            fixed.JUDGE_USER,
            intent=intent,
            message=message,
            context=example_lines(examples, fixed.JUDGE_EXAMPLE, fixed.JUDGE_NO_PRECEDENTS),
            draft=draft,
        ),
    )


def urgency_chat(message: Column) -> Column:
    return chat(F.lit(fixed.URGENCY_SYSTEM), fill(fixed.URGENCY_USER, message=message))
