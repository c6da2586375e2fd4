"""Message triage on a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def message_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """Files of a folder or glob as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def start_triage(
    stream: DataFrame, handle: Callable[[DataFrame], DataFrame], output: str, checkpoint: str
) -> StreamingQuery:
    """Apply a batch job to every micro-batch and write its rows below ``output``.

    Vector search needs batch operators, so the job runs in ``foreachBatch``. Every batch owns
    one folder that is overwritten when the batch is repeated after a failure, which makes the
    output exactly-once.
    """

    def write(batch: DataFrame, number: int) -> None:
        handle(batch).write.mode("overwrite").parquet(f"{output}/batch={number}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
