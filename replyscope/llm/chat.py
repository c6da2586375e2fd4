"""Chat text from typed content parts, and back.

Every turn is written as ``<s>role[INST]content</s>``. Texts and roles are escaped so that neither
``<`` nor ``[`` is left in them, hence no control string can come from data, and reading splits at the
markers only. Image, audio and document parts become placeholders in order; their references and
the tokens they expand to are recorded beside the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyscope.llm import fixed_values as fixed

OPEN, MIDDLE, CLOSE = "<s>", "[INST]", "</s>"
PLACEHOLDERS = {"image": "<image>", "audio": "<audio>", "document": "<document>"}
# Tokens for one unit of a part: an image tile, a second of audio, a page of a document
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 768}
PART = "struct<type:string,text:string,ref:string,units:bigint>"


def escape(text: Column) -> Column:
    """Reversible: no ``<`` and no ``[`` is left; null counts as empty."""
    return reduce(lambda value, pair: F.replace(value, F.lit(pair[0]), F.lit(pair[1])), fixed.CHAT_ESCAPES, F.coalesce(text, F.lit("")))


def unescape(text: Column) -> Column:
    """Inverse of ``escape``: doubled backslashes are cut out first, then each stretch is restored."""
    plain = lambda part: reduce(
        lambda value, pair: F.replace(value, F.lit(pair[1]), F.lit(pair[0])), fixed.CHAT_ESCAPES[1:], part
    )
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), plain), "\\")


def text_part(text: Column) -> Column:
    """A message that is one plain text, as content parts."""
    part = F.struct(
        F.lit("text").alias("type"),
        text.alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("bigint").alias("units"),
    )
    return F.array(part)


def kind_of(part: Column) -> Column:
    """Type of a part; one that is null or unknown is text if it has text, else a document."""
    known = part["type"].isin("text", *PLACEHOLDERS)
    return F.when(known, part["type"]).when(part["text"].isNotNull(), F.lit("text")).otherwise(F.lit("document"))


def visit(parts: Column) -> Column:
    """The visitor: flattens parts, in order, to (content, attachments, expanded_tokens) of one message."""
    parts = F.filter(F.coalesce(parts, F.array().cast(f"array<{PART}>")), lambda part: part.isNotNull())

    def written(part: Column) -> Column:
        out = escape(part["text"])
        for kind, mark in PLACEHOLDERS.items():
            out = F.when(kind_of(part) == kind, F.lit(mark)).otherwise(out)
        return out

    def tokens(part: Column) -> Column:
        rates = [F.when(kind_of(part) == kind, F.lit(rate)) for kind, rate in TOKENS_PER_UNIT.items()]
        return F.coalesce(*rates, F.lit(0)).cast("long") * F.greatest(F.coalesce(part["units"], F.lit(1)), F.lit(0))

    others = F.filter(parts, lambda part: kind_of(part) != "text")
    return F.struct(
        F.array_join(F.transform(parts, written), "").alias("content"),
        F.transform(
            others, lambda part: F.struct(kind_of(part).alias("type"), part["ref"].alias("ref"), tokens(part).alias("tokens"))
        ).alias("attachments"),
        F.aggregate(others, F.lit(0).cast("long"), lambda total, part: total + tokens(part)).alias("tokens"),
    )


def format_conversations(messages: DataFrame, learn: str = "assistant") -> DataFrame:
    """conv_id, formatted, loss_mask, attachments and expanded_tokens: one row per conversation.

    ``messages`` has conv_id, turn, role and parts (array<struct<type, text, ref, units>>); other
    columns are not looked at. ``loss_mask`` lists start and length, in code points of ``formatted``, of the
    content of each turn of role ``learn``. Turns are ordered by turn, then role, then content, so ties and
    repeated rows have one result; null turns come first, a null role and null parts are empty, rows
    without conv_id form one conversation, and an empty table gives an empty one. A conversation is
    one text, so its rows meet in one row; that is the only shuffle.
    """
    seen = messages.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), visit(F.col("parts")).alias("_m"))
    turns = seen.select("conv_id", "turn", "role", "_m.*").withColumn("head", F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(MIDDLE)))
    size = F.length("head") + F.length("content") + len(CLOSE)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "content", "attachments")
    before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = turns.select(
        "*", F.row_number().over(order).alias("at"), (F.sum(size).over(before) - size).cast("long").alias("offset")
    )
    gathered = numbered.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("at", "offset", "role", "head", "content", "attachments"))).alias("_turns"),
        F.sum("tokens").alias("expanded_tokens"),
    )
    learned = F.filter("_turns", lambda t: t["role"] == learn)
    return gathered.select(
        "conv_id",
        F.array_join(F.transform("_turns", lambda t: F.concat(t["head"], t["content"], F.lit(CLOSE))), "").alias("formatted"),
        F.transform(
            learned,
            lambda t: F.struct(
                (t["offset"] + F.length(t["head"])).alias("start"), F.length(t["content"]).cast("long").alias("length")
            ),
        ).alias("loss_mask"),
        F.flatten(F.transform("_turns", lambda t: t["attachments"])).alias("attachments"),
        "expanded_tokens",
    )


def read_turns(formatted: Column) -> Column:
    """(role, text) of every turn, read from formatted text; placeholders stand as they were written."""
    whole = F.filter(F.split(formatted, CLOSE, -1), lambda turn: turn != "")
    halves = F.transform(whole, lambda turn: F.split(F.substring(turn, len(OPEN) + 1, 2147483647), r"\[INST\]", 2))
    return F.transform(halves, lambda half: F.struct(unescape(half[0]).alias("role"), unescape(half[1]).alias("text")))


def masked_text(formatted: Column, loss_mask: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    taken = F.transform(
        loss_mask, lambda span: unescape(F.substring(formatted, (span["start"] + 1).cast("int"), span["length"].cast("int")))
    )
    return F.array_join(taken, "")
