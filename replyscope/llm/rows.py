"""Helpers the operators share: Arrow passes over rows and tables kept in the shared scratch folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from replyscope.session import bound_batches, scratch_path, tidy

# Rows handled at a time, so that results and work space stay small beside the batch Spark sends
ROWS_AT_ONCE = 1024


def map_batches(
    df: DataFrame,
    reads: Iterable[str],
    keep: Iterable[str],
    fields: str,
    work: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]],
) -> DataFrame:
    """Add columns computed from Arrow batches; no row changes place.

    ``work()`` runs once per task and returns a function from a batch that has the columns
    ``reads`` to one array per field of ``fields`` (a DDL string); it gets ``ROWS_AT_ONCE`` rows at
    most. ``keep`` are the input columns of the result; one that has the name of a new field is replaced.
    """
    bound_batches(df.sparkSession)
    new = StructType.fromDDL(fields)
    kept = [name for name in keep if name not in new.names]
    source = df.select(*kept, *[name for name in reads if name not in kept])
    schema = StructType([*(df.schema[name] for name in kept), *new.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = work()
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                columns = [batch.column(name) for name in kept]
                yield pa.RecordBatch.from_arrays([*columns, *step(batch)], names=[*kept, *new.names])

    return source.mapInArrow(tidy(run), schema)


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return batch.column(name).cast(pa.large_binary()).fill_null(b"")


def stored(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """The table, written below the shared checkpoint folder and read again.

    Cuts lineage without memory, keeps column pruning, and survives lost executors. ``compression`` names
    the codec of the files where the session's own is not wanted.
    """
    path = scratch_path(df.sparkSession, purpose)
    (df.write if compression is None else df.write.option("compression", compression)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(table: DataFrame) -> None:
    """Remove the files of a table that ``stored`` returned and that nothing reads any more."""
    context = table.sparkSession.sparkContext
    for name in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
        folder = context._jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def sha256_of(column) -> Column:
    """Lowercase hex SHA-256 of a string column's UTF-8 bytes."""
    return F.sha2(column.cast("binary"), 256)
