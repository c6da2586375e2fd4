"""Texts reach Python in batches of bounded bytes."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from replyscope.functions.language import language_detector, language_profiles
from replyscope.functions.overlap import groundedness
from replyscope.operators import encoder, scoring, tfidf
from replyscope.session import BATCH_BYTES, BATCH_SETTING


@pytest.fixture
def unbounded(spark):
    before = spark.conf.getAll.get(BATCH_SETTING)
    spark.conf.unset(BATCH_SETTING)
    yield spark
    spark.conf.unset(BATCH_SETTING) if before is None else spark.conf.set(BATCH_SETTING, before)


def texts(spark):
    return spark.range(3000, numPartitions=1).select(
        F.col("id").alias("doc_id"), F.lit("en").alias("lang"), F.repeat(F.lit("plain words "), 700).alias("text")
    )


def vocabulary(spark):
    return tfidf.Vocabulary(spark.createDataFrame([("plain", 0, 2, 1.0)], "term string, term_id int, df long, idf double"), 2)


STEPS = {
    "counts": lambda docs: tfidf.term_counts(docs, "doc_id", "text"),
    "weights": lambda docs: tfidf.sparse_texts(docs, "doc_id", "text", vocabulary(docs.sparkSession)),
    "profiles": lambda docs: language_profiles(docs, "text", "lang"),
    "detector": lambda docs: language_detector(docs.sparkSession.createDataFrame([("en", 1, -1.0, 5)], "lang string, gram long, log_p double, total long")),
    "overlap": lambda docs: groundedness(docs.withColumnRenamed("text", "draft_reply"), docs.withColumnRenamed("text", "brand_reply"), "doc_id"),
    "encoder": lambda docs: encoder.encode_with(docs, "text", lambda: lambda rows: [[1.0]] * len(rows)),
    "scores": lambda docs: scoring.score_batches(docs, "doc_id", "text", lambda: len, "score", "long"),
}


@pytest.mark.parametrize("step", STEPS)
def test_bytes_of_a_batch(unbounded, step):
    docs = texts(unbounded)
    STEPS[step](docs)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.nbytes]})

    largest = docs.select("text").mapInArrow(sizes, "n long").agg(F.max("n")).first()[0]
    assert largest < 2 * BATCH_BYTES


def test_a_bound_of_the_session_is_kept(unbounded):
    unbounded.conf.set(BATCH_SETTING, "1000000")
    tfidf.term_counts(texts(unbounded), "doc_id", "text")
    assert unbounded.conf.get(BATCH_SETTING) == "1000000"
