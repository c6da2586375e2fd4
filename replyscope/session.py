"""Spark session helpers: where lineage is cut and where intermediate tables are written."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Spark sends rows to Python in batches of about this many bytes; its own bound is far above what work on texts can multiply
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder, because machine-local storage is lost with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        configured = tempfile.mkdtemp(prefix="run-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the result survives lost executors and later plans start from it."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new, unused folder below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def bound_batches(spark: SparkSession) -> None:
    """Bound the bytes of an Arrow batch in this session, unless the session has a bound of its own."""
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def give_back() -> None:
    """Return memory that is free inside this process to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """A function over Arrow batches that gives memory back at the end of its task.

    Python workers serve one task after the other, in turn, so each would keep the largest of all tasks that it ever served.
    """

    def tidied(batches: Iterable) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidied


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for costly work on input that came in fewer pieces than there are cores.

    Large input has more pieces than cores and is left alone, so nothing is shuffled. Meant for
    scans and checkpointed tables, whose pieces are known without running a stage.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
