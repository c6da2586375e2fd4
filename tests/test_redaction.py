import re

import pytest
from pyspark.sql import functions as F

from replyscope.fixed_values import REDACTION_RULES
from replyscope.functions.redaction import redact, redact_columns, redaction_audit

CASES = [
    ("@AmazonHelp my order is late", "[USER] my order is late"),
    ("call me at 555-867-5309", "call me at [PHONE]"),
    ("email me at john@example.com", "email me at [EMAIL]"),
    ("check https://amazon.com/orders/123", "check [URL]"),
    ("", ""),
    (None, ""),
    ("   ", "   "),
    ("my package is missing and I am very upset", "my package is missing and I am very upset"),
    ("  padded \x1f", "padded"),
    # The order id rule runs before the phone rule
    ("id 114-1234567-9876543.", "id [ORDER_ID]."),
    # The separator may be empty and letters count as id characters
    ("refunding it", "[ORDER_ID] it"),
    ("my order arrived", "my [ORDER_ID]"),
    ("5558675309", "[PHONE]"),
    ("55586753091", "[NUMBER]"),
    ("4111111111111111", "[NUMBER]"),
    ("card 4111 1111 1111 1111 here", "card [CARD] here"),
    ("(800) 123-4567", "([PHONE]"),
    ("é1234567890", "é1234567890"),
]


def by_rules(text):
    """The same rules in their fixed order, text by text."""
    if text is None or not text.strip():
        return text or ""
    for _, pattern, ignore_case, token in REDACTION_RULES:
        text = re.sub(pattern, token, text, flags=re.IGNORECASE if ignore_case else 0)
    return text.strip()


def test_cases(spark):
    rows = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "id int, text string")
    found = {row.id: row.clean for row in rows.select("id", redact(F.col("text")).alias("clean")).collect()}
    assert [found[i] for i in range(len(CASES))] == [expected for _, expected in CASES]
    assert [by_rules(text) for text, _ in CASES] == [expected for _, expected in CASES]


def test_whole_documents_agree_with_text_by_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text")
    for row in docs.withColumn("clean", redact(F.col("text"))).collect():
        assert row.clean == by_rules(row.text)


@pytest.mark.parametrize("chosen, expected", [(["handle"], "[USER] a@b.co"), ([], "[USER] [EMAIL]"), (["x"], "@me a@b.co")])
def test_selection(spark, chosen, expected):
    rows = spark.createDataFrame([("@me a@b.co",)], "text string")
    if chosen == ["handle"]:
        expected = "[USER] a[USER].co"
    assert rows.select(redact(F.col("text"), chosen).alias("t")).first().t == expected


def test_columns_and_audit(spark):
    rows = spark.createDataFrame([("@AmazonHelp order 114-1234567-9876543", None)], "a string, b string")
    clean = redact_columns(rows, ["a", "b", "missing"])
    assert clean.columns == ["a", "b"] and clean.first().b == ""
    both = rows.select(F.col("a").alias("text"), redact(F.col("a")).alias("clean"))
    audit = {row.pattern: row.replaced for row in redaction_audit(both, "text", "clean").collect()}
    assert audit["handle"] == 1 and audit["order_id_amazon"] == 1


def test_audit_runs_costly_rules_only_where_they_can_match(spark):
    texts = ["HTTPS://x.y and a@b.co", "plain", None, "@one @two", "mail a@b.co, c@d.org"]
    rows = spark.createDataFrame([(text, text) for text in texts], "text string, clean string")
    audit = redaction_audit(rows, "text", "clean")
    found = {row.pattern: (row.matches_before, row.matches_after) for row in audit.collect()}
    assert found["email"] == (3, 3) and found["url"] == (1, 1) and found["handle"] == (5, 5) and found["phone"] == (0, 0)
    # Three rules on two columns
    assert audit._jdf.queryExecution().optimizedPlan().toString().lower().count("contains(") == 6
