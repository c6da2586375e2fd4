from pyspark.sql import functions as F

from replyscope import fixed_values as fixed
from replyscope.functions.gate import escalation_gate, escalation_quality, rule_counts
from replyscope.functions.guardrails import guardrail_flags, reply_safety
from replyscope.plans.jobs import triage

SCHEMA = "message string, intent string, confidence double, similarity double, urgency double, mood string, lang string"
CASES = [
    (("I was charged twice", "billing_payment", 0.95, 0.85, None, None, "en"), ["denylist"]),
    (("I can't log in", "account_access", 0.90, 0.80, None, None, None), ["denylist"]),
    (("please help me", "order_status_inquiry", 0.45, 0.85, None, None, "en"), ["low_confidence"]),
    (("my order is late", "order_status_inquiry", 0.90, 0.35, None, None, "en"), ["low_similarity"]),
    (("my order is late", "order_status_inquiry", 0.90, None, None, None, "en"), ["low_similarity"]),
    (("my order is late", "order_status_inquiry", 0.90, 0.85, 0.95, "urgent", "en"), ["high_urgency"]),
    (("my order is late", "order_status_inquiry", 0.90, 0.85, 0.2, "neutral", "en"), []),
    (("where is my package", "order_status_inquiry", 0.95, 0.85, 0.1, "neutral", "en"), []),
    (("", "billing_payment", 0.40, None, 0.95, "urgent", None), ["denylist", "low_confidence", "low_similarity", "high_urgency", "too_short"]),
    # Exactly on each threshold
    (("one two three", "return_refund", 0.70, 0.60, 0.80, None, "en"), ["high_urgency"]),
    (("two words", "return_refund", 0.70, 0.60, 0.79, None, "fr"), ["non_english", "too_short"]),
]


def gated(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return escalation_gate(df, top_similarity="similarity", urgency="urgency", sentiment="mood", language="lang", **options)


def test_rules(spark):
    rows = gated(spark, [case for case, _ in CASES]).collect()
    assert [row.triggered_rules for row in rows] == [rules for _, rules in CASES]
    assert [row.decision for row in rows] == ["escalate" if rules else "auto_handle" for _, rules in CASES]


def test_reason_and_signals(spark):
    rows = gated(spark, [CASES[2][0], CASES[7][0], CASES[8][0]]).collect()
    assert rows[0].reason == (
        "ESCALATE — Classifier confidence is low (0.45 < threshold 0.70); "
        "the predicted intent 'order_status_inquiry' may be incorrect."
    )
    assert rows[1].reason == (
        "Auto-handled: confidence 0.95 >= 0.7; similarity 0.85 >= 0.6; intent 'order_status_inquiry' not in denylist; "
        "urgency score 0.10 is acceptable."
    )
    assert rows[2].reason.count(" | ") == 4 and "(0 words)" in rows[2].reason and "(sentiment: urgent)" in rows[2].reason
    assert rows[1].signals.asDict() == {
        "intent": "order_status_inquiry", "confidence": 0.95, "top_similarity": 0.85, "urgency_score": 0.1,
        "sentiment": "neutral", "word_count": 4, "n_retrieved": 1,
    }


def test_empty_denylist_is_honoured(spark):
    assert gated(spark, [CASES[0][0]], denylist=[]).first().triggered_rules == []


def test_counts_and_quality(spark):
    rows = gated(spark, [case for case, _ in CASES])
    counts = {row.rule: row.n for row in rule_counts(rows).collect()}
    assert counts["denylist"] == 3 and counts["low_similarity"] == 3
    decided = spark.createDataFrame(
        [("escalate", "escalate"), ("escalate", "auto_handle"), ("auto_handle", "escalate"), ("escalate", None)],
        "decision string, human_escalate string",
    )
    row = escalation_quality(decided).first()
    assert (row.n, row.escalation_rate, row.precision, row.recall) == (4, 0.75, 0.5, 0.5)
    empty = escalation_quality(decided.where(F.lit(False))).first()
    assert empty.precision is None and empty.recall is None


CLAIMS = [
    ("You get $25.00 back", [], [("specific_dollar_amount", "$25.00")]),
    ("You get $25.00 back", ["we refunded $25.00"], []),
    ("It is a 50% refund", [], [("specific_percentage", "50% refund")]),
    ("within 3 business days", [], [("specific_timeframe", "3 business days")]),
    ("within 3 days", [], [("specific_timeframe", "3 days"), ("specific_timeframe", "within 3 days")]),
    ("We Promise it; our policy allows it", None, [("policy_assertion", "policy allows"), ("promise_language", "We Promise")]),
    ("We Promise it", ["WE PROMISE nothing"], []),
    ("", [], []),
]


def test_guardrails(spark):
    rows = [(i, reply, known) for i, (reply, known, _) in enumerate(CLAIMS)]
    df = spark.createDataFrame(rows, "id int, draft_reply string, precedents array<string>")
    flags = guardrail_flags(df, "id").collect()
    for i, (_, _, expected) in enumerate(CLAIMS):
        assert sorted((f.pattern_type, f.matched_text) for f in flags if f.id == i) == sorted(expected)
    assert {row.id for row in reply_safety(df).where("is_safe").collect()} == {1, 6, 7}
    custom = guardrail_flags(df, "id", patterns=[r"\$\d+"]).collect()
    assert [(f.id, f.pattern_type, f.matched_text) for f in custom] == [(0, "config_pattern", "$25")]


def test_triage_drafts_only_what_passes(spark):
    messages = spark.createDataFrame(
        [("1", "where is my package @me"), ("2", "I was charged twice")], "thread_id string, customer_text string"
    )
    predictions = spark.createDataFrame(
        [("1", "order_status_inquiry", 0.91239), ("2", "billing_payment", 0.9)], "thread_id string, intent string, confidence double"
    )
    retrieved = spark.createDataFrame(
        [("1", r, 0.9 - r / 100, "q", "x" * 150 + str(r), f"m{r}") for r in range(1, 6)],
        "thread_id string, rank int, similarity double, customer_text string, brand_reply string, match_id string",
    )
    seen = []

    def draft(passed):
        seen.extend(row.thread_id for row in passed.select("thread_id").collect())
        return passed.withColumn("draft_reply", F.lit("You will hear from us in 2 days"))

    rows = {row.thread_id: row for row in triage(messages, predictions, retrieved, draft).collect()}
    assert seen == ["1"]
    assert rows["1"].decision == "auto_handle" and rows["1"].message == "where is my package [USER]"
    assert rows["1"].confidence == 0.9124 and len(rows["1"].guardrail_flags) == 1
    assert [(e.rank, e.similarity, len(e.brand_reply)) for e in rows["1"].retrieved_examples] == [(1, 0.89, 100), (2, 0.88, 100), (3, 0.87, 100)]
    assert rows["2"].draft_reply == fixed.ESCALATED_MARKER and rows["2"].guardrail_flags == []
