"""Shards cut from one Hilbert curve through several metadata dimensions.

Rows that lie near each other in all dimensions lie near each other on the curve, so a run of the
curve has narrow ranges in every dimension and a reader can skip most files by their statistics.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from replyscope.llm.rows import map_batches, stored

BITS = 10


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``points``, whose coordinates have ``bits`` bits.

    The transform of Skilling (2004): undo the rotations from the highest bit down, Gray-decode,
    and interleave the bits of the coordinates.
    """
    axes = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(len(axes)):
            high = (axes[i] & q) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[i]) & low)
            axes[0] = np.where(high, axes[0] ^ low, axes[0] ^ swap)
            if i:
                axes[i] = axes[i] ^ swap
        q >>= 1
    for i in range(1, len(axes)):
        axes[i] = axes[i] ^ axes[i - 1]
    turn, q = np.zeros(len(points), dtype=np.int64), top
    while q > 1:
        turn = np.where(axes[-1] & q, turn ^ (q - 1), turn)
        q >>= 1
    index = np.zeros(len(points), dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            index = index << 1 | ((axis ^ turn) >> bit & 1)
    return index


def log_scale(value: Column, bits: int = BITS) -> Column:
    """A size as a coordinate: its logarithm over the range of 64-bit numbers; null counts as 0."""
    scaled = F.log2(F.greatest(F.coalesce(value, F.lit(0)), F.lit(0)) + 1) * ((1 << bits) - 1) / 40
    return F.least(F.floor(scaled), F.lit((1 << bits) - 1)).cast("long")


def spread(value: Column, bits: int = BITS) -> Column:
    """A name as a coordinate: equal names stand together, different ones are spread over the axis; null is 0."""
    return F.coalesce(F.pmod(F.xxhash64(value), F.lit(1 << bits)), F.lit(0)).cast("long")


def with_hilbert(df: DataFrame, axes: list[Column], bits: int = BITS, name: str = "_hilbert") -> DataFrame:
    """Add the place on the curve. ``axes`` are at most 62 / bits columns of numbers below 2^bits."""
    if len(axes) * bits > 62:
        raise ValueError("the coordinates together may have 62 bits")
    names = [f"_axis{i}" for i in range(len(axes))]
    rows = df.select("*", *(axis.alias(n) for axis, n in zip(axes, names, strict=True)))

    def work():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            points = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1)
            return [pa.array(hilbert_index(points, bits), pa.int64())]

        return step

    return map_batches(rows, names, df.columns, f"{name} bigint", work)


def ranked(df: DataFrame, order: list[str]) -> DataFrame:
    """Add ``_rank``, the place of each row from 0 in the global order, with no sort in one task.

    Range partitions are sorted side by side, numbered, and shifted by the sizes of those before them.
    The table of sizes has one row per partition. Rows that are equal in ``order`` keep together.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            places = pa.array(np.arange(seen, seen + n))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * n, pa.int64()), places], names=[*batch.schema.names, "_part", "_place"])
            seen += n

    schema = StructType([*df.schema.fields, StructField("_part", LongType()), StructField("_place", LongType())])
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = stored(parts.mapInArrow(number, schema), "curve")
    before, sizes = 0, []
    for part, n in rows.groupBy("_part").agg(F.count("*")).orderBy("_part").collect():
        sizes.append((part, before))
        before += n
    offsets = df.sparkSession.createDataFrame(sizes, "_part bigint, _before bigint")
    out = rows.join(F.broadcast(offsets), "_part").withColumn("_rank", F.col("_before") + F.col("_place"))
    return out.withColumn("_total", F.lit(before)).drop("_part", "_place", "_before")


def cut_runs(df: DataFrame, shards: int) -> DataFrame:
    """Add ``shard`` and ``slot`` to ranked rows: runs of the order whose counts are at most one apart."""
    base, more = F.floor(F.col("_total") / shards), F.col("_total") % shards
    # The first `more` shards have one row more
    long_part = more * (base + 1)
    behind = F.col("_rank") - long_part
    in_long = F.col("_rank") < long_part
    size = F.greatest(base, F.lit(1))
    shard = F.when(in_long, F.floor(F.col("_rank") / (base + 1))).otherwise(more + F.floor(behind / size))
    slot = F.when(in_long, F.col("_rank") % (base + 1)).otherwise(behind % size)
    return df.withColumns({"shard": shard.cast("int"), "slot": slot.cast("long")}).drop("_rank", "_total")


def document_shards(docs: DataFrame, shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, lang, source, shard and slot of every row of ``docs``.

    The dimensions are language, source and size. ``size`` is 8 plus the bytes of the text, a null text
    has none and checksum 0. Shards are runs of the curve, their row counts at most one apart; ties on
    the curve are ordered by id and text, so one frequent source is spread over tasks and shards.
    Rows of one shard are numbered from 0. Texts are read once and never shuffled; columns other than
    doc_id, text, lang and source are not looked at; an empty table gives an empty one.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    facts = docs.select(
        "doc_id", "lang", "source", (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32")
    )
    axes = [spread(F.col("lang")), spread(F.col("source")), log_scale(F.col("size"))]
    curve = stored(with_hilbert(facts, axes), "places")
    return cut_runs(ranked(curve, ["_hilbert", "lang", "source", "size", "doc_id", "text_crc32"]), shards).drop("_hilbert")


def write_shards(docs: DataFrame, path: str, axes: list[Column], shards: int, order: list[str]) -> DataFrame:
    """Write all columns of ``docs`` as one folder per run of the curve and read them again, with ``shard``.

    ``order`` names columns that settle ties on the curve. Files of a run are sorted along the curve, so
    their column statistics are narrow in every dimension.
    """
    rows = cut_runs(ranked(with_hilbert(docs, axes), ["_hilbert", *order]), shards)
    sorted_rows = rows.repartitionByRange(shards, "shard").sortWithinPartitions("shard", "slot")
    sorted_rows.drop("_hilbert", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)
