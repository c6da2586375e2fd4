"""Token ids and their bytes come from one pass, and workers give memory back after a task."""

import public_tokenizers
import pyarrow as pa
import pytest

import corpus_pipeline
from replyscope import session
from replyscope.llm import byte_bpe, rows

from .conftest import ODD_TEXTS


def test_one_pass_gives_what_two_give(frame):
    docs, path = frame(*ODD_TEXTS, (7, "naïve \U0001f600 words, and  spaces \n")).select("doc_id", "text"), public_tokenizers.path(corpus_pipeline.RANKS)
    apart = byte_bpe.decode(byte_bpe.encode(docs, path, public_tokenizers.PATTERN, at_spaces=True), path)
    together = byte_bpe.encode_and_decode(docs, path, public_tokenizers.PATTERN, at_spaces=True)
    assert together.columns == apart.columns
    assert together.exceptAll(apart).count() == apart.exceptAll(together).count() == 0


def test_token_stage_has_one_python_pass(spark, frame, capsys):
    corpus_pipeline.tokens(spark, frame((1, "a b")), "").explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1


@pytest.mark.parametrize("read_all", [True, False])
def test_memory_goes_back_at_the_end_of_a_task(monkeypatch, read_all):
    given = []
    monkeypatch.setattr(session, "give_back", lambda: given.append(1))
    run = session.tidy(lambda batches: iter(batches))(iter([pa.array([1]), pa.array([2])]))
    assert next(run).to_pylist() == [1] and not given
    list(run) if read_all else run.close()
    assert given == [1]


def test_giving_back_keeps_what_is_used():
    kept = pa.array(range(1000))
    session.give_back()
    assert kept.to_pylist() == list(range(1000))
    assert rows.tidy is session.tidy
