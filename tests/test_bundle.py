import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyscope.catalog import from_text, whole_jobs
from replyscope.functions.language import language_detector, language_profiles
from replyscope.operators import similarity
from replyscope.plans import jobs
from replyscope.plans.bundle import fit_bundle, load_bundle
from replyscope.sources.vectors import read_index, write_index

THREAD = "thread_id string, customer_text string, brand_reply string, n_turns int"
TOPICS = {
    "return_refund": "the blender broke and i want my money back for it",
    "delivery_problem": "parcel still missing courier never rang the bell",
    "product_quality": "does this lamp fit a small socket and what colour",
}


@pytest.fixture(scope="module")
def threads(spark):
    rows = [
        (f"{i}", f"{text} number {i % 4} please", f"reply about {intent}", 2)
        for i, (intent, text) in enumerate(list(TOPICS.items()) * 12)
    ]
    return spark.createDataFrame(rows, THREAD)


@pytest.fixture(scope="module")
def languages(spark):
    rows = [(text, "en") for text in TOPICS.values()] + [("où est mon colis je voudrais être remboursé très vite", "fr")]
    return spark.createDataFrame(rows, "text string, lang string")


def drafts(passed):
    return passed.withColumn("draft_reply", F.lit("we will help"))


def labels_of(threads):
    names = F.create_map(*[F.lit(x) for i, name in enumerate(TOPICS) for x in (i, name)])
    return threads.select("thread_id", names[F.col("thread_id").cast("int") % 3].alias("intent"))


@pytest.mark.parametrize("classifier", [True, False])
def test_stored_bundle_triages_text(spark, threads, languages, tmp_path, classifier):
    path = str(tmp_path / "bundle")
    held_out = threads.where("thread_id in ('0', '1')")
    fitted = fit_bundle(
        threads, path, labels=labels_of(threads), held_out=held_out, languages=languages, classifier=classifier, dimensions=512, k=3, c=100.0
    )
    messages = spark.createDataFrame(
        [
            ("a", TOPICS["delivery_problem"] + " call me@example.com"),
            ("b", "où est mon colis très vite remboursé"),
            ("c", None),
            ("d", ""),
            ("e", TOPICS["product_quality"]),
        ],
        "id string, body string",
    )
    rows = {}
    for bundle in (fitted, load_bundle(spark, path)):
        options = dict(confidence_threshold=0.5, similarity_threshold=0.3)
        found = bundle.triage(messages, drafts, "id", "body", 3, **options).collect()
        assert rows in ({}, {r.id: r for r in found})
        rows = {r.id: r for r in found}
    assert len(rows) == 5
    assert (rows["a"].intent, rows["e"].intent) == ("delivery_problem", "product_quality")
    assert "@example" not in rows["a"].message and rows["a"].decision == "auto_handle" and rows["a"].draft_reply == "we will help"
    assert rows["b"].triggered_rules[0] == "non_english" and rows["b"].decision == "escalate"
    for name in "cd":
        assert rows[name].decision == "escalate" and "non_english" not in rows[name].triggered_rules
    assert not {e.match_id for r in rows.values() for e in r.examples} & {"0", "1"}
    empty = fitted.triage(messages.limit(0), drafts, "id", "body", 3)
    assert empty.collect() == []


def test_own_encoder_must_be_given_again(spark, threads, tmp_path):
    path = str(tmp_path / "own")
    fit_bundle(threads, path, encode=from_text.letters, classifier=False)
    with pytest.raises(ValueError):
        load_bundle(spark, path)
    # Without labels nobody votes, and the gate sees confidence 0
    rows = load_bundle(spark, path, from_text.letters).triage(threads, drafts).collect()
    assert len(rows) == 36 and {r.intent for r in rows} == {None} and {r.confidence for r in rows} == {0.0}


def test_index_reads_only_folders_a_query_must_see(spark, tmp_path):
    rng = np.random.default_rng(4)
    centers = np.eye(12)
    vectors = [(centers[i % 12] + 0.02 * rng.normal(size=12)).tolist() for i in range(960)]
    rows = [(str(i), "text", "reply" if i % 7 else "", 2, v) for i, v in enumerate(vectors)]
    pairs = spark.createDataFrame(rows + [("none", "text", "reply", 2, None)], f"{THREAD}, embedding array<float>")
    path = str(tmp_path / "index")
    # Enough pivots that each of the twelve clusters has one
    write_index(pairs, path, block_rows=10)
    index = read_index(spark, path)
    corpus = pairs.where("brand_reply <> '' and embedding is not null")
    assert index.rows().count() == corpus.count()
    queries = pairs.where("thread_id in ('12', '24', '36')").withColumnRenamed("thread_id", "id")
    wanted = index.visited(queries)
    every, some = len(index.rows().inputFiles()), {r.cell for r in index.rows(wanted).select("cell").distinct().collect()}
    read = {f for (f,) in index.rows(wanted).select(F.input_file_name()).distinct().collect()}
    assert some <= set(wanted) and len(read) < every / 4
    found = {(r.id, r.match_id, r.rank, r.similarity) for r in index.search(queries, "id").collect()}
    plain = similarity.knn(queries, corpus, query_key="id")
    assert found == {(r.id, r.thread_id, r["rank"], r.similarity) for r in plain.collect()}


def test_empty_index(spark, threads, tmp_path):
    pairs = threads.withColumn("embedding", F.array(F.lit(1.0).cast("float"), F.lit(0.0).cast("float")))
    index = write_index(pairs.limit(0), str(tmp_path / "index"))
    assert index.rows().count() == 0
    assert index.search(pairs.withColumnRenamed("thread_id", "id"), "id").count() == 0


def test_weak_labels_of_a_sample(spark, languages):
    texts = [TOPICS["return_refund"], "où est mon colis remboursé très vite", None]
    rows = spark.createDataFrame([(str(i), i, texts[i % 3]) for i in range(90)], "tweet_id string, position int, text string")
    asked = []

    def answer(batches):
        asked.extend(text for r in batches.collect() for text in r.texts)
        entry = F.transform("texts", lambda t, i: F.concat(F.lit('{"index": '), i + 1, F.lit(', "intent": "return_refund"}')))
        return batches.select("batch", F.concat(F.lit("["), F.array_join(entry, ","), F.lit("]")).alias("raw"))

    detect = language_detector(language_profiles(languages, "text", "lang"))
    found, stats, _ = jobs.weak_labels(rows, answer, "position", n_samples=40, detect=detect)
    sample = {r.tweet_id for r in from_text.hash_sample(rows, "tweet_id", 40, 42).collect()}
    expected = {i for i in sample if int(i) % 3 != 1}
    assert {r.tweet_id for r in found.collect()} == expected and len(asked) == len(expected)
    assert stats.first().total_attempted == len(expected) and set(asked) == {texts[0], ""}


@pytest.mark.parametrize("scale, decisions", [("sf0.001", {"escalate"}), ("sf0.01", {"escalate", "auto_handle"})])
def test_stream_equals_batch(spark, scale, decisions):
    """The threads of the smallest tables are all held out, so nothing is retrieved there."""
    sf_dir = f"/root/testdata/{scale}"
    batch = from_text.triage_from_text(spark, sf_dir).collect()
    stream = from_text.streamed_triage_from_text(spark, sf_dir)
    assert sorted(batch, key=str) == sorted(stream.select(*batch[0].asDict()).collect(), key=str)
    assert {r.decision for r in batch} == decisions


def test_nested_report_holds_both_baselines(spark):
    row = json.loads(whole_jobs.evaluation_report_nested(spark, "/root/testdata/sf0.001").first().report)
    simple = json.loads(row["simple"])
    n = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").count()
    assert simple["n"] == n == json.loads(row["trivial"])["n"] and 0 < simple["accuracy"] <= 1
