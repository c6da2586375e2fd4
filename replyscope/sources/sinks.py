"""Sinks for tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from replyscope.sources.messages import CSV_OPTIONS


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV that keeps line breaks, quotes and the difference between "" and null."""
    df.write.mode("overwrite").options(header=True, quote='"', escape='"', emptyValue='""', nullValue="").csv(path)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of ``write_csv``. Line breaks inside quotes stay, so a file is read by one task."""
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=True).csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """Nested metric rows as JSON lines."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
