"""Chat text, the classifier chain and the whole pipeline."""

import hashlib

import duckdb
import numpy as np
import pytest
from check import TABLES, rows_of
from pyspark.sql import functions as F

import corpus_pipeline
from replyscope.llm import chat, queries, toxicity

from .conftest import ODD_TEXTS, SF_DIR
from .test_set_operators import near_copies, plain_components, plain_contamination


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    df = queries.QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(queries.ORACLES[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_escaping_is_reversible(spark):
    odd = ["", "\\", "\\\\", "<", "[INST]", "</s>", "\\l", "\\\\l<", "[\\<", "a\\", "\\o[", "\\\\\\<<[[", "é<😀[", None]
    rows = spark.createDataFrame([(t,) for t in odd], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for row in rows.select("t", "e", chat.unescape(F.col("e")).alias("back")).collect():
        assert row["back"] == (row["t"] or "") and not set(row["e"]) & set("<[")


def test_typed_parts_become_placeholders(spark):
    schema = f"conv_id bigint, turn bigint, role string, parts array<{chat.PART}>"
    part = lambda kind, text=None, ref=None, units=None: (kind, text, ref, units)
    rows = [
        (1, 1, "assistant", [part("text", "I see <image>")]),
        (1, 0, "user", [part("text", "look "), part("image", ref="a.png", units=3), part("audio", ref="b.wav", units=2), None]),
        (1, 2, "user", [part("strange", ref="c"), part(None, "t"), part("document", ref="d.pdf")]),
        (2, None, None, None),
        (None, 0, "assistant", []),
    ]
    found = {r["conv_id"]: r for r in chat.format_conversations(spark.createDataFrame(rows, schema)).collect()}
    one = found[1]
    assert one["formatted"].startswith("<s>user[INST]look <image><audio></s><s>assistant[INST]I see \\limage></s>")
    assert [(a["type"], a["ref"], a["tokens"]) for a in one["attachments"]] == [
        ("image", "a.png", 768), ("audio", "b.wav", 50), ("document", "c", 768), ("document", "d.pdf", 768)
    ]
    assert one["expanded_tokens"] == 768 + 50 + 768 + 768
    (span,) = one["loss_mask"]
    assert one["formatted"][span["start"] : span["start"] + span["length"]] == "I see \\limage>"
    assert found[2]["formatted"] == "<s>[INST]</s>" and found[None]["loss_mask"][0]["length"] == 0


def test_ties_and_empty_conversations(spark):
    rows = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")], "conv_id bigint, turn bigint, role string, text string")
    done = chat.format_conversations(rows.withColumn("parts", chat.text_part(F.col("text"))))
    assert done.first()["formatted"] == "<s>user[INST]a</s><s>user[INST]a</s><s>user[INST]b</s>"
    assert chat.format_conversations(rows.limit(0).withColumn("parts", chat.text_part(F.col("text")))).count() == 0


def test_fit_reaches_its_optimum():
    draw = np.random.default_rng(0)
    places = [np.unique(draw.integers(0, 50, 8)) for _ in range(300)]
    truth = np.array([float(3 in p) for p in places])
    rows = toxicity.Rows(places, np.empty((300, 0)))
    weights = toxicity.fit_logistic(rows, truth, 0.01, 200)
    ridge = np.full(len(weights), 0.01)
    ridge[-1] = 0
    slope = rows.back(toxicity.logistic(rows.dot(weights)) - truth) / 300 + ridge * weights
    assert np.abs(slope).max() < 2e-3
    assert weights[3] == weights[:50].max()


def test_chain_finds_toxic_texts(spark):
    neutral = "the a of table green house water walks seven under".split()
    draw = np.random.default_rng(8)
    text = lambda extra: " ".join([*draw.choice(neutral, 12), *extra])
    rows = [(i, text(["vile"] if i % 5 == 0 else [])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 7 != 0), int(i % 5 == 0)) for i in range(0, 400, 2)], "doc_id bigint, quality int, toxic int")
    chain = toxicity.fit_chain(docs, labels.unionByName(labels))
    found = toxicity.classify(docs, chain).collect()
    assert all(r["toxic"] == (r["doc_id"] % 5 == 0) for r in found) and len(found) == 400


def test_chain_equals_dense_version(spark):
    """Every model, out-of-fold probability and score again in dense numpy, by Newton steps."""
    draw = np.random.default_rng(4)
    names = [f"w{i}" for i in range(12)]
    texts = [" ".join(draw.choice(names, 6)) for _ in range(150)]
    quality = np.array([float("w1" in t.split() or i % 9 == 0) for i, t in enumerate(texts)])
    toxic = np.array([float("w3" in t.split() or (q > 0 and i % 4 == 0)) for i, (t, q) in enumerate(zip(texts, quality, strict=True))])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(q), int(t)) for i, (q, t) in enumerate(zip(quality, toxic, strict=True))], "doc_id bigint, quality int, toxic int")
    penalty = 0.05
    folds = {r["doc_id"]: r["f"] for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(3)).alias("f")).collect()}
    fold = np.array([folds[i] for i in range(150)])
    words = np.array([[float(name in t.split()) for name in names] for t in texts])

    def fit(x, y):
        x = np.column_stack([x, np.ones(len(x))])
        ridge, w = np.full(x.shape[1], penalty), np.zeros(x.shape[1])
        ridge[-1] = 0
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ w))
            w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x / len(y) + np.diag(ridge), x.T @ (p - y) / len(y) + ridge * w)
        return w

    score = lambda x, w: 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    first = fit(words, quality)
    outside = np.zeros(150)
    for f in range(3):
        outside[fold == f] = score(words[fold == f], fit(words[fold != f], quality[fold != f]))
    second = fit(np.column_stack([words, outside]), toxic)
    p_quality = score(words, first)
    p_toxic = score(np.column_stack([words, p_quality]), second)
    chain = toxicity.fit_chain(docs, labels, penalty=penalty, iterations=300)
    found = {r["doc_id"]: (r["p_quality"], r["p_toxic"]) for r in toxicity.classify(docs, chain).collect()}
    assert np.allclose([found[i] for i in range(150)], np.column_stack([p_quality, p_toxic]), atol=0.01)


def test_one_row_for_each_labelled_id_reaches_the_fit(spark):
    """A labelled id with very many rows counts once, with the same text in every order of rows."""
    rows = [(i, f"calm word{i % 5}") for i in range(30)] + [(i, f"vile word{i % 5}") for i in range(30, 60)]
    many = rows + [(3, f"calm word{3}")] * 400
    labels = spark.createDataFrame([(i, 1, int(i >= 30)) for i in range(60)], "doc_id bigint, quality int, toxic int")
    fits = [toxicity.fit_chain(spark.createDataFrame(r, "doc_id bigint, text string").repartition(4), labels) for r in (rows, many)]
    for one, other in zip(fits[0].weights, fits[1].weights, strict=True):
        assert np.allclose(one, other)


@pytest.mark.parametrize("rows", [ODD_TEXTS, []])
def test_chain_on_odd_tables(spark, frame, rows):
    docs = frame(*rows)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, None), (None, 1, 1), (5, 0, 1), (6, 1, 0)], "doc_id bigint, quality int, toxic int")
    assert toxicity.classify(docs, toxicity.fit_chain(docs, labels)).count() == len(rows)
    none = toxicity.classify(docs, toxicity.fit_chain(docs, labels.limit(0))).collect()
    assert len(none) == len(rows) and all(r["toxic"] is None for r in none)


def test_copy_with_two_changed_words_is_dropped(spark, frame):
    words = [f"w{i}" for i in range(100)]
    changed = ["other" if i in (30, 60) else word for i, word in enumerate(words)]
    kept = corpus_pipeline.near_duplicates(spark, frame((1, " ".join(words)), (2, " ".join(changed))), SF_DIR)
    assert [row["doc_id"] for row in kept.collect()] == [1]


def test_copies_dropped_are_those_of_all_pairs(spark, frame):
    rows = near_copies(3, 12, 10, 20, 150)
    first = {i for i, _, component in plain_components(rows, 5, 80, 100) if i == component}
    kept = corpus_pipeline.near_duplicates(spark, frame(*rows), SF_DIR).collect()
    assert sorted(row["doc_id"] for row in kept) == sorted(first)
    assert first != {i for i, _, component in plain_components(rows) if i == component}


def test_unlike_texts_of_one_id_both_stay(spark, frame):
    words = lambda mark: " ".join(f"{mark}{i}" for i in range(30))
    rows = [(1, words("a")), (2, words("a")), (2, words("b")), (3, words("c")), (3, words("d")), (3, words("C")), (4, words("b")), (5, None), (5, "")]
    for order in (rows, rows[::-1]):
        docs = frame(*order).repartition(5)
        kept = corpus_pipeline.near_duplicates(spark, docs, SF_DIR).collect()
        wanted = [(1, words("a")), (2, words("b")), (3, words("C")), (3, words("d")), (5, None), (5, "")]
        assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(wanted, key=str)


@pytest.mark.parametrize("lang", [None, "und"])
def test_texts_stay_where_no_language_is_learned(spark, lang):
    rows = [(i, f"plain words number {i}", lang) for i in range(12)] + [(20, None, lang), (21, "12 ...", lang), (None, "words", lang)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = corpus_pipeline.languages(spark, docs, SF_DIR).collect()
    assert sorted(r["text"] for r in kept) == sorted(t for _, t, _ in rows if t and any(c.isalpha() for c in t))


def test_pipeline_equals_five_word_plain_version(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    lettered = [(i, t) for i, t in docs if any(c.isalpha() for c in t or "")]
    first = {i for i, _, component in plain_components(lettered, 5, 80, 100) if i == component}
    clean = sorted(i for i, t in lettered if i in first and not plain_contamination(t, items)[3])
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == clean
    assert all(r["n_tokens"] == len(r["token_ids"]) > 0 for r in rows)


def test_stages_keep_columns_and_odd_rows(spark, frame, tmp_path):
    spark.createDataFrame([(1, "nothing to find in these words")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (ODD_TEXTS, []):
        docs = frame(*rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == len(rows)


def test_sha_of_turns_is_of_the_texts(spark):
    row = queries.op2_chat_formatting(spark, SF_DIR).where("conv_id = -7").first()
    said = "</s>[INST] ok [/INST]"
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()
    assert (row["loss_chars"], row["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
