import json

import numpy as np
from pyspark.sql import functions as F

from replyscope.operators.encoder import encode, fit_encoder
from replyscope.plans import jobs
from replyscope.session import checkpoint_root, spread
from replyscope.sources import sinks
from replyscope.sources.messages import MESSAGE_SCHEMA, conversations_to_messages, load_messages, with_position

CONVERSATIONS = "/root/testdata/sf0.001/conversations.parquet"


def test_saved_threads(spark, tmp_path):
    messages = conversations_to_messages(spark.read.parquet(CONVERSATIONS))
    path = str(tmp_path / "prepared")
    saved = jobs.save_prepared_threads(messages, path, brand="brand1")
    row = saved.summary().first()
    assert row.n_threads == saved.threads.count() == spark.read.parquet(f"{path}/customer_messages").count()
    assert row.n_resolved == spark.read.parquet(f"{path}/resolved_pairs").count()
    assert {r.brand for r in saved.threads.select("brand").distinct().collect()} == {"brand1"}


def test_csv_round_trip(spark, tmp_path):
    rows = [
        ("3", "a", True, "t", 'line\nbreak "quoted", comma', None, None),
        ("12", "B", False, None, "", "1,2", "3"),
        ("7", "c", True, "t", "back\\slash", None, "99"),
    ]
    df = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    sinks.write_csv(df, str(tmp_path / "csv"))
    back = load_messages(spark, str(tmp_path / "csv"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    assert load_messages(spark, str(tmp_path / "csv"), limit=2).count() == 2
    assert [r.position for r in with_position(back).orderBy("position").collect()] == [3, 7, 12]


def test_discover_clusters(spark):
    rng = np.random.default_rng(5)
    centers = np.eye(4)
    rows = [(i, [float(x) for x in centers[i % 4] + 0.05 * rng.normal(size=4)]) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    options = dict(similarity=0.95, min_samples=5, min_cluster_size=20)
    for method, extra in (("kmeans", {}), ("density", options)):
        labels, stats, samples = jobs.discover_clusters(df, "id", n_sample=160, method=method, k=4, per_cluster=3, **extra)
        assert stats.first().asDict() == {"n_clusters": 4, "noise_count": 0, "total_points": 160}
        assert samples.count() == 12 and labels.select(F.col("id") % 4, "cluster").distinct().count() == 4


def test_thread_retrieval(spark):
    threads = spark.createDataFrame(
        [
            ("1", [("red apple pie", True), ("ok", False), ("red pie", True)], "red apple pie", "r1"),
            ("2", [("red apple cake", True)], "red apple cake", "r2"),
            ("3", [("blue sky day", True)], "blue sky day", "r3"),
        ],
        "thread_id string, turns array<struct<text:string,inbound:boolean>>, customer_text string, brand_reply string",
    )
    model = fit_encoder(threads, "customer_text", 4096)
    corpus = encode(threads, "customer_text", model)
    found = jobs.retrieve_for_threads(threads, corpus, lambda asked: encode(asked, "query_text", model), 1)
    assert {r.thread_id: r.match_id for r in found.collect()}["1"] == "2"


def test_report_as_json(spark, tmp_path):
    golden = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "thread_id string, human_intent string")
    predictions = spark.createDataFrame(
        [(i, "a", 0.95, "please wait") for i in "123"], "thread_id string, intent string, confidence double, draft_reply string"
    )
    retrieved = spark.createDataFrame([("1", 1, 0.5, "please wait")], "thread_id string, rank int, similarity double, brand_reply string")
    sinks.write_report(jobs.nested_report(jobs.evaluation_report(golden, predictions, retrieved)), str(tmp_path / "report"))
    report = json.loads(spark.read.text(str(tmp_path / "report")).first().value)["report"]
    assert json.loads(report["classification"])["accuracy"] == 0.5
    assert json.loads(report["groundedness"])["mean_rouge_l"] == 0.5
    assert json.loads(report["retrieval"])["n_empty"] == 1.0


def test_labels_without_prediction_are_wrong(spark):
    golden = spark.createDataFrame([(i, "a") for i in "1234"], "thread_id string, human_intent string")
    predictions = spark.createDataFrame(
        [("1", "a", 0.95, "please wait")], "thread_id string, intent string, confidence double, draft_reply string"
    )
    retrieved = spark.createDataFrame([("1", 1, 0.5, "please wait")], "thread_id string, rank int, similarity double, brand_reply string")
    report = jobs.evaluation_report(golden, predictions, retrieved, baselines={"other": predictions})
    found = {(r.section, r.metric): r.value for r in report.collect()}
    assert found["classification", "n"] == found["other", "n"] == found["retrieval", "n_queries"] == 4
    assert found["classification", "accuracy"] == found["other", "accuracy"] == found["groundedness", "mean_rouge_l"] == 0.25
    assert (found["per_class_support", "a"], found["per_class_recall", "a"]) == (4, 0.25)
    assert (found["bin_n", "0"], found["bin_accuracy", "0"], found["bin_confidence", "0"]) == (3, 0, 0)


def test_candidates_without_scores_are_ambiguous(spark):
    text = "one two three four five six seven eight nine ten eleven"
    messages = spark.createDataFrame([("1", text), ("2", text)], "thread_id string, customer_text string")
    scores = spark.createDataFrame([("1", "a", 0.9), ("1", "b", 0.1)], "thread_id string, label string, score double")
    best = spark.createDataFrame([("1", 0.9), ("2", 0.9)], "thread_id string, similarity double")
    candidates = jobs.golden_candidates(messages, scores, best)
    rows = {r.thread_id: (r.predicted_intent, r.confidence, r.is_edge_ambiguous, r.is_edge) for r in candidates.collect()}
    assert rows == {"1": ("a", 0.9, False, False), "2": (None, 0.0, True, True)}
    assert jobs.build_golden_set(candidates, target=10, per_intent=1).where("thread_id = '2'").count() == 1


def test_auto_label(spark):
    golden = spark.createDataFrame([("1", "x", ""), ("2", "y", "")], "thread_id string, customer_text string, human_intent string")
    labelled = jobs.auto_label_golden(golden, lambda asked: asked.limit(1).withColumn("raw", F.lit("APP_technical!")))
    assert sorted(r.human_intent for r in labelled.collect()) == ["app_technical", "compliment_feedback"]


def test_session_helpers(spark):
    assert checkpoint_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == 4
    assert spread(spark.range(10).repartition(9)).rdd.getNumPartitions() == 9


def test_csv_keeps_line_breaks_quotes_and_nulls(spark, tmp_path):
    from replyscope.sources.sinks import read_csv, write_csv

    rows = [("1", 'a "quoted" line\nand, another\r\nend'), ("2", ""), ("3", None), ("4", " plain ")]
    schema = "thread_id string, text string"
    write_csv(spark.createDataFrame(rows, schema), f"{tmp_path}/t")
    back = {row["thread_id"]: row["text"] for row in read_csv(spark, f"{tmp_path}/t", schema).collect()}
    assert len(back) == 4 and back["2"] == "" and back["3"] is None
    assert back["1"].split() == rows[0][1].split() and "\n" in back["1"]


def test_baseline_answers_are_made_once(spark):
    asked = spark.sparkContext.accumulator(0)

    def answer(batches):
        for batch in batches:
            asked.add(batch.num_rows)
            yield batch

    golden = spark.createDataFrame([(i, "a") for i in "1234"], "thread_id string, human_intent string")
    predictions = golden.select("thread_id", F.lit("a").alias("intent"), F.lit(0.5).alias("confidence"), F.lit("x").alias("draft_reply"))
    retrieved = spark.createDataFrame([("1", 1, 0.5, "x")], "thread_id string, rank int, similarity double, brand_reply string")
    other = predictions.select("thread_id", "intent").mapInArrow(answer, "thread_id string, intent string")
    found = {(r.section, r.metric): r.value for r in jobs.evaluation_report(golden, predictions, retrieved, baselines={"other": other}).collect()}
    assert asked.value == 4 and found["other", "accuracy"] == 1.0 and found["other", "macro_f1"] == 1.0
