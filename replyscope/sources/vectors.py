"""Vector stores: one Parquet table with vectors and their metadata, or an index of folders by cell."""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from replyscope import fixed_values as fixed
from replyscope.operators.similarity import CORPUS_BLOCK_ROWS, Cells, build_cells, knn, with_home, with_visits
from replyscope.operators.threads import resolved
from replyscope.session import cut_lineage

COLUMNS = ["thread_id", "customer_text", "brand_reply", "n_turns", "embedding"]
BOUNDS = (
    "pivots array<array<double>>, near array<double>, far array<double>, rows array<long>, closest array<array<double>>, "
    "block_rows long, row_schema string"
)


def write_vectors(pairs: DataFrame, path: str) -> None:
    """Write the resolved pairs with their vectors. Files keep the partitions of the input."""
    resolved(pairs).select(*COLUMNS).write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*COLUMNS)


def dimension(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """Row count and the lowest and highest vector length."""
    length = F.size(vector)
    return vectors.agg(F.count("*").alias("n"), F.min(length).alias("min_dim"), F.max(length).alias("max_dim"))


@dataclass(frozen=True)
class VectorIndex:
    """A stored corpus in one folder per cell, with the pivots and bounds of the cells."""

    spark: SparkSession
    path: str
    cells: Cells
    schema: StructType

    def rows(self, wanted: list[int] | None = None) -> DataFrame:
        """The corpus, or only the folders of some cells."""
        stored = self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        return stored if wanted is None else stored.where(F.col("cell").isin(wanted))

    def visited(self, queries: DataFrame, k: int = fixed.TOP_K, vector: str = "embedding") -> list[int]:
        """The cells that can hold one of the k nearest rows of any query: at most one number for each pivot and one more."""
        asked = queries.select(F.col(vector).alias("_vector")).where("_vector is not null")
        seen = with_visits(asked, "_vector", self.cells, None, k).select("_cell").distinct()
        return sorted(row["_cell"] for row in seen.collect())

    def search(self, queries: DataFrame, query_key: str, k: int = fixed.TOP_K, vector: str = "embedding") -> DataFrame:
        """(query_key, match_id, similarity, rank, customer_text, brand_reply, ...): the k nearest stored rows.

        Exact, and only folders that some query must see are read. A query without a vector gets no
        row, one over a smaller corpus all rows. Query ids must be unique.
        """
        corpus = self.rows(self.visited(queries, k, vector)).withColumnRenamed("thread_id", "match_id")
        found = knn(queries, corpus, k, query_key=query_key, corpus_key="match_id", vector=vector, cells=self.cells)
        return found.join(corpus.drop("cell", "embedding"), "match_id")


def write_index(
    pairs: DataFrame, path: str, k: int = fixed.TOP_K, block_rows: int = CORPUS_BLOCK_ROWS, extra: tuple[str, ...] = ()
) -> VectorIndex:
    """Write the resolved pairs with a vector below ``path``, by cell, for searches of up to k rows.

    A cell is a folder of files of some ``block_rows`` rows, so a cell with a third of the corpus is
    many files and no task writes it alone.
    """
    rows = cut_lineage(resolved(pairs).where("embedding is not null").select(*COLUMNS, *extra))
    cells = build_cells(rows, "thread_id", "embedding", k, block_rows)
    in_cell = F.get(F.array(*[F.lit(int(n)) for n in cells.blocks]), F.col("cell"))
    placed = with_home(rows, "embedding", cells).drop("_gap").withColumnRenamed("_cell", "cell")
    placed = placed.withColumn("_block", F.pmod(F.xxhash64("thread_id"), in_cell))
    by_cell = placed.repartition("cell", "_block").drop("_block")
    by_cell.write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
    stored = StructType([*rows.schema.fields, by_cell.schema["cell"]])
    bounds = (
        None if cells.pivots is None else cells.pivots.tolist(),
        cells.near.tolist(),
        cells.far.tolist(),
        [int(n) for n in cells.rows],
        cells.closest.tolist(),
        cells.block_rows,
        stored.json(),
    )
    spark = pairs.sparkSession
    spark.createDataFrame([bounds], BOUNDS).write.mode("overwrite").parquet(f"{path}/bounds")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> VectorIndex:
    """A stored index. Only pivots and bounds come to the driver."""
    row = spark.read.schema(BOUNDS).parquet(f"{path}/bounds").first()
    pivots = None if row["pivots"] is None else np.array(row["pivots"])
    arrays = [np.array(row[name]) for name in ("near", "far", "rows", "closest")]
    return VectorIndex(spark, path, Cells(pivots, *arrays, row["block_rows"]), StructType.fromJson(json.loads(row["row_schema"])))
