"""Runnable queries, each with the SQL that gives the same rows where SQL can."""

from replyscope.catalog import aggregates, common, from_text, joins, models, tables, texts, whole_jobs, windows  # noqa: F401


def queries():
    return dict(common.QUERIES)


def oracles():
    return dict(common.ORACLES)
