"""The passes of TF-IDF and of the classifier give memory back after a task."""

import numpy as np
import pytest

from replyscope.operators import classify, tfidf


@pytest.fixture
def given(monkeypatch):
    found = []
    for module in (tfidf, classify):
        monkeypatch.setattr(module, "tidy", lambda run: found.append(run.__name__) or run, raising=False)
    return found


def test_passes_give_memory_back(spark, given):
    docs = spark.createDataFrame([(1, "plain words")], "doc_id long, text string")
    table = spark.createDataFrame([("plain", 0, 2, 1.0)], "term string, term_id int, df long, idf double")
    tfidf.term_counts(docs, "doc_id", "text")
    rows = tfidf.sparse_texts(docs, "doc_id", "text", tfidf.Vocabulary(table, 2))
    classify.class_shares(rows, "doc_id", np.ones((2, 1)), np.zeros(2))
    classify.as_vectors(rows, 1, "doc_id")
    assert given == ["count", "weigh", "score", "build"]
