"""ROUGE-L overlap of reply pairs: longest common subsequence of stemmed word tokens."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from replyscope.functions.stemming import stem
from replyscope.session import bound_batches

TOKEN = re.compile(r"[a-z0-9]+")
# Fixed value: shorter words are compared as they are
LONGEST_UNSTEMMED = 3
KNOWN_WORDS = 1 << 16


class Stems(dict):
    """Stems by word, of at most ``KNOWN_WORDS`` words."""

    def __missing__(self, word: str) -> str:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        found = self[word] = stem(word) if len(word) > LONGEST_UNSTEMMED else word
        return found


STEMS = Stems()


def tokens(text: str | None) -> list[str]:
    """Lower-case words of a text, the longer ones as stems."""
    return list(map(STEMS.__getitem__, TOKEN.findall((text or "").lower())))


def common_subsequence(left: list[str], right: list[str]) -> int:
    """Length of the longest common subsequence, one machine-word operation per 64 cells of the words both have."""
    both = set(left).intersection(right)
    left, right = [token for token in left if token in both], [token for token in right if token in both]
    if len(left) > len(right):
        left, right = right, left
    places = dict.fromkeys(both, 0)
    for position, token in enumerate(left):
        places[token] |= 1 << position
    full = (1 << len(left)) - 1
    row = full
    for token in right:
        matches = row & places[token]
        if matches:
            row = ((row + matches) | (row - matches)) & full
    return len(left) - row.bit_count()


@F.pandas_udf(DoubleType())
def rouge_l(references: pd.Series, drafts: pd.Series) -> pd.Series:
    """F-measure of the common subsequence of reference and draft."""

    # A draft is compared with several references, so a text of the batch is cut once
    cut = {text: tokens(text) for text in {*references, *drafts}}

    def score(reference: str, draft: str) -> float:
        wanted, given = cut[reference], cut[draft]
        if not wanted or not given:
            return 0.0
        shared = common_subsequence(wanted, given)
        if shared == 0:
            return 0.0
        precision, recall = shared / len(given), shared / len(wanted)
        return 2 * precision * recall / (precision + recall)

    return pd.Series([score(reference, draft) for reference, draft in zip(references, drafts)], dtype="float64")


def groundedness(
    drafts: DataFrame, pairs: DataFrame, key: str, draft: str = "draft_reply", reply: str = "brand_reply"
) -> DataFrame:
    """(key, groundedness): mean ROUGE-L over the non-empty precedent replies; 0 without any.

    ``drafts`` holds one row per message, ``pairs`` one row per (message, precedent).
    """
    bound_batches(drafts.sparkSession)
    usable = pairs.where(F.coalesce(F.col(reply), F.lit("")) != "").select(key, reply)
    scored = drafts.select(key, draft).join(usable, key).withColumn("_score", rouge_l(F.col(reply), F.col(draft)))
    means = scored.groupBy(key).agg(F.avg("_score").alias("groundedness"))
    return drafts.select(key).join(means, key, "left").fillna(0.0, ["groundedness"])
