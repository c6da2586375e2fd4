import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from replyscope.functions import overlap
from replyscope.functions.overlap import common_subsequence, groundedness
from replyscope.functions.stemming import stem
from replyscope.operators import calibration, metrics


def pairs(spark, truth, predicted):
    return spark.createDataFrame(list(zip(truth, predicted)), "truth string, predicted string")


def test_perfect_and_wrong(spark):
    df = pairs(spark, "abcab", "abcab")
    assert metrics.accuracy(df, "truth", "predicted").first().accuracy == 1.0
    assert metrics.macro_averages(df, "truth", "predicted").first().macro_f1 == 1.0
    assert metrics.accuracy(pairs(spark, "aaa", "bbb"), "truth", "predicted").first().accuracy == 0.0
    # Labels of truth and of prediction count
    assert metrics.macro_averages(pairs(spark, "aab", "aac"), "truth", "predicted").first().macro_f1 == pytest.approx(1 / 3)


def test_confusion(spark):
    df = pairs(spark, "aabc", "abbb")
    cells = {(r.truth, r.predicted): r.n for r in metrics.confusion_matrix(df, "truth", "predicted", list("abcd")).collect()}
    assert len(cells) == 16 and cells["a", "b"] == 1 and cells["c", "b"] == 1 and sum(cells.values()) == 4
    assert metrics.confusion_matrix(df, "truth", "predicted").count() == 9
    wide = {r.truth: r.b for r in metrics.wide_confusion(df, "truth", "predicted", list("abc")).collect()}
    assert wide == {"a": 1, "b": 1, "c": 1}


def test_class_report(spark):
    report = {r.label: r for r in metrics.class_report(pairs(spark, "aabc", "abbb"), "truth", "predicted", list("abcd")).collect()}
    assert (report["a"].precision, report["a"].recall, report["a"].support) == (1.0, 0.5, 2)
    assert (report["b"].precision, report["b"].recall) == (pytest.approx(1 / 3), 1.0)
    assert (report["c"].precision, report["c"].f1, report["d"].support) == (0.0, 0.0, 0)


def test_retrieval(spark):
    queries = spark.createDataFrame([("1",), ("2",), ("3",)], "q string")
    found = spark.createDataFrame(
        [("1", 1, 0.8, True), ("1", 2, 0.6, False), ("2", 1, 0.9, False)], "q string, rank int, similarity double, relevant boolean"
    )
    row = metrics.retrieval_metrics(queries, found, "q", relevant="relevant").first()
    assert row.mean_top1_similarity == pytest.approx(0.85) and row.mean_topk_similarity == pytest.approx(0.8)
    assert (row.n_queries, row.n_empty) == (3, 1) and row.hit_rate_at_1 == pytest.approx(1 / 3)
    empty = metrics.retrieval_metrics(queries, found.limit(0), "q").first()
    assert (empty.mean_top1_similarity, empty.n_empty) == (0.0, 3)


def test_groundedness(spark):
    drafts = spark.createDataFrame([(1, "please send us a DM"), (2, "hello"), (3, "a b c d")], "id int, draft_reply string")
    known = spark.createDataFrame(
        [(1, "Please send us a DM!"), (3, "a x c"), (3, ""), (3, None), (3, "a b c d")], "id int, brand_reply string"
    )
    found = {r.id: r.groundedness for r in groundedness(drafts, known, "id").collect()}
    assert found[1] == 1.0 and found[2] == 0.0 and found[3] == pytest.approx((4 / 7 + 1.0) / 2)


# Examples that come with the published rules
STEMS = """caresses caress ponies poni cats cat feed feed agreed agre plastered plaster bled bled motoring motor sing sing conflated conflat
troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi relational relat
conditional condit rational ration valenci valenc hesitanci hesit digitizer digit conformabli conform radicalli radic differentli differ
vileli vile analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis hopefulness hope
callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr
electrical electr hopeful hope goodness good revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust
defensible defens irritant irrit replacement replac adjustment adjust dependent depend adoption adopt homologou homolog communism commun
activate activ angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control
roll roll dies die died die flies fli enjoy enjoy skies sky using use as as"""


def test_stems():
    words = STEMS.split()
    assert [(word, stem(word)) for word in words[::2]] == list(zip(words[::2], words[1::2]))
    assert stem("") == "" and stem("ion") == "ion" and stem("12345") == "12345"


def test_groundedness_compares_stems(spark):
    drafts = spark.createDataFrame([(1, "we refunded your returns"), (2, "the sees")], "id int, draft_reply string")
    known = spark.createDataFrame([(1, "We refund your return"), (2, "the see")], "id int, brand_reply string")
    found = {r.id: r.groundedness for r in groundedness(drafts, known, "id").collect()}
    # Words of three letters stay: see is the stem of sees all the same
    assert found == {1: 1.0, 2: 1.0}


def test_common_subsequence_against_table():
    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = (list(rng.choice(list("abcd"), rng.integers(1, 90))) for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert common_subsequence(a, b) == best[-1][-1]


def rows(spark, confidences, correct):
    return spark.createDataFrame([(float(c), bool(r)) for c, r in zip(confidences, correct)], "conf double, good boolean")


def test_calibration_bins(spark):
    rng = np.random.default_rng(2)
    conf = np.concatenate([rng.random(300), [0.0, 0.3, 1.0, 0.1 * 3, 0.7, 0.6]])
    good = rng.random(len(conf)) < conf
    edges, ece = np.linspace(0, 1, 11), 0.0
    found = {r.bin: r for r in calibration.calibration_bins(rows(spark, conf, good), "conf", "good").collect()}
    for i in range(10):
        mask = (conf >= edges[i]) & (conf < edges[i + 1])
        assert found[i].n == mask.sum() and found[i].accuracy == pytest.approx(good[mask].mean())
        ece += mask.sum() / len(conf) * abs(good[mask].mean() - conf[mask].mean())
    row = calibration.expected_calibration_error(rows(spark, conf, good), "conf", "good").first()
    assert row.ece == pytest.approx(round(ece, 4)) and row.n == len(conf)


def test_confidence_of_one_is_in_no_bin(spark):
    df = rows(spark, [1.0, 1.0, 0.95], [True, False, True])
    assert [(r.bin, r.n) for r in calibration.calibration_bins(df, "conf", "good").collect()] == [(9, 1)]
    assert calibration.expected_calibration_error(df, "conf", "good").first().ece == pytest.approx(0.0167)


def test_threshold(spark):
    # The grid point near 0.9 lies just above it
    assert calibration.best_threshold(rows(spark, [0.9] * 10, [True] * 10), "conf", "good").first().threshold == 0.8750000000000003
    assert calibration.best_threshold(rows(spark, [0.6] * 4, [False] * 4), "conf", "good").first().threshold == 0.9
    rng = np.random.default_rng(3)
    conf = rng.random(200)
    good = rng.random(200) < conf
    expected = 0.9
    for limit in sorted(np.arange(0.5, 1.0, 0.025), reverse=True):
        if (conf >= limit).any() and good[conf >= limit].mean() >= 0.9:
            expected = float(limit)
            break
    found = calibration.best_threshold(rows(spark, conf, good), "conf", "good").first()
    assert found.threshold == expected and found.coverage == pytest.approx((conf >= expected).mean())


def test_kappa(spark):
    df = spark.createDataFrame([(1, 1.2), (2, 2.5), (3, 3.0), (None, 4.0), (3, 4.0)], "h int, j double")
    row = metrics.cohens_kappa(df, "h", "j").first()
    # 2.5 rounds to 2; pairs (1,1) (2,2) (3,3) (3,4)
    assert row.n == 4 and row.observed == 0.75 and row.kappa == pytest.approx((0.75 - 0.25) / (1 - 0.25))
    same = spark.createDataFrame([(3, 3.0), (3, 3.0)], "h int, j double")
    assert metrics.cohens_kappa(same, "h", "j").first().kappa is None
    assert metrics.cohens_kappa(same.where(F.lit(False)), "h", "j").first().kappa is None


def test_missing_predictions_are_wrong(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", None), (None, "a")], "truth string, predicted string")
    found = metrics.accuracy(rows, "truth", "predicted").first()
    assert found["n"] == 3 and abs(found["accuracy"] - 1 / 3) < 1e-9


def test_a_text_of_a_batch_is_cut_once(monkeypatch):
    seen = []
    monkeypatch.setattr(overlap, "tokens", lambda text: seen.append(text) or (text or "").split())
    references, drafts = pd.Series(["a b", "b c", None, "a b"]), pd.Series(["a b c", "a b c", "a b c", None])
    assert overlap.rouge_l.func(references, drafts).round(3).tolist() == [0.8, 0.8, 0.0, 0.0]
    assert sorted(seen, key=str) == [None, "a b", "a b c", "b c"]


def test_known_words_are_bounded(monkeypatch):
    monkeypatch.setattr(overlap, "KNOWN_WORDS", 3)
    monkeypatch.setattr(overlap, "STEMS", overlap.Stems())
    words = "running cats the running walked talked cats"
    assert overlap.tokens(words) == ["run", "cat", "the", "run", "walk", "talk", "cat"] and len(overlap.STEMS) <= 3
