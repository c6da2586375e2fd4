import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.functions import prompts
from replyscope.functions.language import keep_language, language_detector, language_profiles
from replyscope.functions.model_output import batch_labels, judge_scores, label_in_answer, normalise_label, parse_json, unfence
from replyscope.operators import classify, labelling, ranking, sampling, scoring
from replyscope.operators.encoder import encode, encode_with, fit_encoder
from replyscope.plans import jobs


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "raw string").select(expression(F.col("raw")).alias("x")).first().x


@pytest.mark.parametrize(
    "raw, expected",
    [('{"a": 1}', '{"a": 1}'), ('```json\n{"a": 1}\n```', '\n{"a": 1}\n'), ("```x```y```", "x"), ("  plain ", "plain"), ("```", "")],
)
def test_unfence(spark, raw, expected):
    assert one(spark, raw, unfence) == expected


def test_broken_json_is_null(spark):
    schema = "array<struct<index:int,intent:string>>"
    assert one(spark, "nonsense [", lambda raw: parse_json(raw, schema)) is None
    assert one(spark, "[]", lambda raw: parse_json(raw, schema)) == []


def test_batch_labels(spark):
    answer = [
        {"index": 1, "intent": "a"}, {"index": 0, "intent": "zero"}, {"index": 9, "intent": "far"},
        {"index": 1, "intent": "b"}, {"index": 3, "intent": None}, {"intent": "no index"},
    ]
    answers = spark.createDataFrame([(0, "```json\n" + json.dumps(answer) + "\n```"), (1, "sorry")], "batch long, raw string")
    members = spark.createDataFrame([(0, i, f"m{i}") for i in (1, 2, 3)] + [(1, 1, "n1")], "batch long, index int, id string")
    found = {r.id: r.intent for r in batch_labels(answers, members).collect()}
    assert found == {"m1": "b", "m2": None, "m3": None, "n1": None}


def test_judge_scores(spark):
    row = one(spark, '{"correctness": 5, "tone": "4", "groundedness": 9, "rationale": "fine"}', judge_scores)
    assert (row.correctness, row.tone, row.groundedness, row.conciseness) == (5, 4, 9, 3)
    assert (row.average, row.rationale, row.error) == (5.25, "fine", None)
    for raw in ("none", "[1]", '{"tone": "high"}', None):
        row = one(spark, raw, judge_scores)
        assert (row.tone, row.average, row.error) == (3, 3.0, "parse_failure")


def test_labels_in_text(spark):
    assert one(spark, "It is RETURN_REFUND or delivery_problem", label_in_answer) == "delivery_problem"
    assert one(spark, "ERROR: timeout", label_in_answer) == fixed.FALLBACK_INTENT
    predicted = F.lit("app_technical")
    cases = {"": "app_technical", " APP_technical ": "app_technical", "Return_Refund": "return_refund", "refund": "return_refund",
             "pr": None, "zzz": None, None: "app_technical"}
    for typed, expected in cases.items():
        assert one(spark, typed, lambda raw: normalise_label(raw, predicted)) == expected


def test_batches_follow_the_order_however_ids_are_spread(spark):
    df = spark.range(0, 200, 3).withColumn("text", F.col("id").cast("string")).orderBy(F.rand(1))
    far = df.withColumn("order", F.col("id") * (1 << 40))
    batched = labelling.in_batches(far, "order", 20)
    found = {r.batch: r.texts for r in labelling.batch_texts(batched).collect()}
    numbers = [str(i) for i in range(0, 200, 3)]
    assert found == {b: numbers[b * 20 : b * 20 + 20] for b in range(4)}


def test_labelling_prompts_hold_no_personal_data(spark):
    df = spark.createDataFrame([(1, "mail me at jo@example.com"), (2, "late parcel")], "id long, text string")
    seen = []

    def answer(asked):
        seen.extend(asked.select("prompt").collect())
        return asked.select("batch", F.lit('[{"index": 1, "intent": "billing_payment"}]').alias("raw"))

    valid, stats, _ = jobs.weak_labels(df, answer, "id")
    assert seen and all("jo@example.com" not in row.prompt for row in seen)
    assert [(r.id, r.text) for r in valid.collect()] == [(1, "mail me at jo@example.com")]
    assert stats.first().total_attempted == 2


def test_prompts(spark):
    assert prompts.taxonomy_text().splitlines()[4].startswith("4. billing_payment: Incorrect charges")
    texts = spark.createDataFrame([(["x", "y"],)], "t array<string>")
    chat = texts.select(prompts.labelling_chat(F.col("t")).alias("c")).first().c
    assert chat[0].role == "system" and "Messages:\n1. x\n2. y\n\nRespond" in chat[1].content
    turns = "array<struct<text:string,inbound:boolean>>"
    history = spark.createDataFrame([([(f"t{i}", i % 2 == 0 or None) for i in range(8)],), ([("t", True)],)], f"t {turns}")
    lines = [r.h for r in history.select(prompts.history_text(F.col("t"), F.lit("B")).alias("h")).collect()]
    assert lines == ["Customer: t2\nB: t3\nCustomer: t4\nB: t5\nCustomer: t6\nB: t7", ""]
    judged = texts.select(
        prompts.judge_chat(F.lit("m"), F.lit("d"), F.lit(None).cast("array<struct<rank:int,similarity:double,customer_text:string,brand_reply:string>>"), F.lit("i")).alias("c")
    ).first().c
    assert "context):\nNone\n" in judged[1].content and '{\n  "correctness": <1-5>,' in judged[1].content


def test_resume(spark):
    work = spark.createDataFrame([("1", ""), ("2", "old"), ("3", "")], "thread_id string, human_intent string")
    earlier = spark.createDataFrame([("1", "a", 1), ("1", "b", 2), ("2", "", 1)], "thread_id string, human_intent string, position int")
    merged = labelling.resume_labels(work, earlier)
    assert {r.thread_id: r.human_intent for r in merged.collect()} == {"1": "b", "2": "old", "3": ""}
    assert labelling.labelling_progress(merged).first().asDict() == {"n_total": 3, "n_done": 2, "n_remaining": 1}


def test_failed_batches_get_the_default(spark):
    def failing_model():
        def score(values):
            if any(v["text"] == "bad" for v in values):
                raise RuntimeError
            return [len(v["text"]) + v["n"] for v in values]

        return score

    rows = [(i, "bad" if i == 5 else "x" * i, 1) for i in range(12)]
    df = spark.createDataFrame(rows, "id long, text string, n int").coalesce(1)
    found = scoring.score_batches(df, "id", ["text", "n"], failing_model, "score", "long", batch_size=4, default=-1).collect()
    assert {r.id: r.score for r in found} == {i: -1 if 4 <= i < 8 else i + 1 for i in range(12)}


def test_samples(spark):
    df = spark.range(1000).withColumn("label", F.when(F.col("id") < 700, "a").otherwise("b"))
    sample = {r.id for r in ranking.hash_sample(df, "id", 37, 1).collect()}
    assert len(sample) == 37 and sample == {r.id for r in ranking.hash_sample(df.repartition(9), "id", 37, 1).collect()}
    assert sample != {r.id for r in ranking.hash_sample(df, "id", 37, 2).collect()}
    assert ranking.hash_sample(df, "id", 5000, 1).count() == 1000 and ranking.hash_sample(df, "id", None, 1).count() == 1000
    train, held_out = sampling.stratified_split(df, "id", "label", 0.101)
    assert {r.label: r["count"] for r in held_out.groupBy("label").count().collect()} == {"a": 71, "b": 31}
    assert train.count() == 898 and train.join(held_out, "id").isEmpty()


def test_golden_sample(spark):
    names = fixed.INTENT_NAMES
    rows = [(str(i), names[i % 3], i % 10 == 0) for i in range(900)]
    df = spark.createDataFrame(rows, "thread_id string, predicted_intent string, is_edge boolean")
    chosen = sampling.golden_sample(df).collect()
    assert len({r.thread_id for r in chosen}) == len(chosen) == 40 + 3 * 16
    assert sum(r.is_edge for r in chosen) >= 40
    assert sampling.golden_sample(df, target=20, per_intent=15).count() == 20


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    half = docs.where("doc_id % 2 = 0")
    detect = language_detector(language_profiles(half, "text", "lang"))
    other = docs.where("doc_id % 2 = 1").withColumn("found", detect("text"))
    right = other.agg(F.avg((F.col("found") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.95
    short = spark.createDataFrame([("",), (None,), ("中文字符",)], "text string").withColumn("found", detect("text"))
    assert [r.found for r in short.collect()] == [None, None, None] and keep_language(short, "found").count() == 3


def test_best_label(spark):
    scores = spark.createDataFrame([(1, "b", 0.4), (1, "a", 0.4), (1, "c", 0.2), (2, "x", 1.0)], "id int, label string, score double")
    found = {r.id: (r.intent, r.confidence, r.top2_gap) for r in classify.best_label(scores, "id").collect()}
    assert found == {1: ("a", 0.4, 0.0), 2: ("x", 1.0, 1.0)}


def test_text_classifier(spark, tmp_path):
    words = {"billing_payment": "charged card twice money", "app_technical": "app crash error loading", "return_refund": "return label refund box"}
    rng = np.random.default_rng(4)
    rows = []
    for n in range(150):
        label = list(words)[n % 10 % 3]
        rows.append((n, " ".join(rng.choice(words[label].split() + ["the", "my", "it"], 8)), label))
    df = spark.createDataFrame(rows, "id long, text string, label string")
    model = classify.fit_text_classifier(df, "id", "text", "label", max_features=100)
    found = model.predict(df, "id", "text")
    assert found.join(df, "id").where("intent = label").count() >= 147
    # The vectorised scorer agrees with the model's own probabilities
    weights = classify.sparse_texts(df, "id", "text", model.vocabulary)
    features = classify.as_vectors(weights, 100, "id")
    own = {r.id: max(r.probability) for r in model.model.transform(features).collect()}
    assert all(own[r.id] == pytest.approx(r.confidence, abs=1e-9) for r in found.collect())
    replies = df.select("id", F.concat(F.lit("about "), F.col("label")).alias("draft_reply"))
    baseline = classify.simple_baseline(model, df, "id", "text", replies)
    assert baseline.columns == ["id", "intent", "confidence", "draft_reply", "decision", "reason"]
    assert baseline.where("decision = 'auto_handle' and draft_reply like 'about %'").count() == 150
    model.save(str(tmp_path / "model"))
    again = classify.TextClassifier.load(spark, str(tmp_path / "model")).predict(df, "id", "text")
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found.collect()))


def test_majority_ties_and_baseline(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "label string")
    assert classify.majority_class(df, "label").first().majority_intent == "a"
    found = classify.majority_baseline(df, "label", df).first()
    assert (found.intent, found.confidence, found.decision) == ("a", 1.0, "auto_handle")


def test_encoders(spark):
    df = spark.createDataFrame([(1, "where is my order"), (2, "my order is late"), (3, None)], "id int, text string")
    vectors = {r.id: np.array(r.embedding) for r in encode(df, "text", fit_encoder(df, "text", 64)).collect()}
    assert np.linalg.norm(vectors[1]) == pytest.approx(1.0, abs=1e-5) and not vectors[3].any()
    custom = encode_with(df, "text", lambda: lambda texts: np.array([[len(t), 1.0] for t in texts]))
    assert np.linalg.norm(custom.where("id = 1").first().embedding) == pytest.approx(1.0, abs=1e-6)


def test_highest_rows(spark):
    rng = np.random.default_rng(6)
    values = [int(v) for v in rng.zipf(1.4, 3000) % 5000 + 1]
    df = spark.createDataFrame([(f"t{i}", v) for i, v in enumerate(values)], "term string, total long")
    ordered = sorted((-v, f"t{i}") for i, v in enumerate(values))
    for n in (1, 50, 700, 2999, 4000):
        found = sorted((-r.total, r.term) for r in ranking.highest_rows(df, n, "total", "term").collect())
        assert found == ordered[:n]


def test_pieces_of_a_fit_follow_the_cores(spark, monkeypatch):
    """Each piece sends a gradient of classes x terms in each step, so many texts must not make many pieces."""
    seen = []

    class Fit(classify.LogisticRegression):
        def fit(self, training):
            seen.append(training.rdd.getNumPartitions())
            return super().fit(training)

    monkeypatch.setattr(classify, "LogisticRegression", Fit)
    df = spark.range(90).select(
        "id", F.when(F.col("id") % 2 == 0, "some plain words").otherwise("other long words").alias("text"), (F.col("id") % 2).cast("string").alias("label")
    )
    model = classify.fit_text_classifier(df.repartition(40), "id", "text", "label", max_features=20)
    assert seen == [classify.FIT_PIECES_PER_CORE * spark.sparkContext.defaultParallelism]
    assert model.predict(df, "id", "text").where(F.col("intent") == (F.col("id") % 2).cast("string")).count() == 90
