import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of

SF_DIR = "/root/testdata/sf0.001"
QUICK = [
    "brand_statistics", "reconstructed_threads", "prepared_threads", "redaction_audit", "top_k_vectors", "near_duplicate_vectors",
    "density_clusters", "template_reply", "escalation_gate", "guardrail_flags", "judge_scores", "weak_labels", "golden_set",
    "triage_decisions", "evaluation_report", "streamed_triage", "stratified_split", "language_filter", "scan_messages",
]


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF_DIR)
    cursor = duck.execute(entry.oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in cursor.description], cursor.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
