"""Cleaning a corpus for training: every stage reads all that the stage before it kept."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.llm import byte_bpe, decontamination, jaccard_join, language_id, secret_scan
from replyscope.llm.rows import stored

RANKS = "byte_bpe_multi_50k.tiktoken"
# Near copies share four fifths of their runs of five words
COPY_WORDS, COPY_SIMILARITY = 5, (80, 100)


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no known language: without text or letters, or like no language at all.

    Learns from the documents given, those with a language and outside the held-out fold; ``und`` is no
    language. If there are none, every document with a letter stays.
    """
    learned = language_id.prototypes(language_id.learning_texts(docs).where(F.col("lang") != language_id.UNKNOWN))
    names = [f"_in_{name}" if name != "text" else name for name in docs.columns]
    # Any one vector tells texts with a letter from those without
    found = language_id.identify(docs.toDF(*names), learned or [("any", np.ones(language_id.DIMENSIONS))])
    known = F.col("lang_pred") != language_id.UNKNOWN
    if learned:
        known &= F.col("score") > 0
    return found.where(known).select(*names).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates.

    Null and empty texts and texts without words are no duplicates of other ids: one row of each such text and id stays.
    Of texts under one id the first in order stays for its group, repeated rows become one, rows without an id all stay. Long texts are compared
    whole, columns keep their names whatever they are, and an empty table stays empty.
    """
    return jaccard_join.keep_first(docs, COPY_WORDS, COPY_SIMILARITY)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which a twentieth or more is benchmark text.

    Null and empty texts are clean, repeated rows are judged alike, whole texts count however long they are. Other columns
    are not looked at; an empty table or benchmark drops nothing.
    """
    return decontamination.remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts; ``n_chars``, where there is one, follows the text.

    Every row stays, repeated ones too. A null or empty text stays as it is, long texts are scanned whole; other columns
    are not looked at, whatever their names, and an empty table stays empty.
    """
    masked = secret_scan.mask_secrets(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        masked = masked.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return masked


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens and token_ids of every row; other columns are left out.

    Encoding loses nothing, so the check that the ids decode to the bytes of the text drops no row: one that failed it would
    show a damaged rank file. A null or empty text has no tokens, long texts are encoded whole, repeated rows repeat, and an empty
    table stays empty.
    """
    path = public_tokenizers.path(RANKS)
    keep = ["doc_id", "lang", "source"]
    encoded = byte_bpe.encode_and_decode(docs.select(*keep, "text"), path, public_tokenizers.PATTERN, at_spaces=True)
    whole = encoded.where(F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary"))
    return whole.select(*keep, F.size("token_ids").cast("long").alias("n_tokens"), "token_ids")


STAGES = [
    ("language_id", languages),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontaminated),
    ("secret_scans", without_secrets),
    ("byte_bpe", tokens),
]

# Language profiles and merges are beyond SQL; tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
