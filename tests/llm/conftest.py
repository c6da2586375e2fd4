import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with results."""

    def build(*rows, **more):
        schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, n_words string"
        full = [(i, t, "en", "s", None if t is None else len(t), "old", "old") for i, t in rows]
        return spark.createDataFrame(full, schema)

    return build


ODD_TEXTS = [(1, None), (2, ""), (3, " \n\t"), (4, "..."), (None, "some words here"), (5, "x " * 40_000), (6, "same text"), (6, "same text")]
