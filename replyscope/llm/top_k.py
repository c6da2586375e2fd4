"""Exact top-k inner products by a pivot-distance index.

Vectors are lifted to equal length, which turns the largest inner product into the smallest
distance. Each belongs to its nearest pivot and lies at a known distance from it; sorted by pivot
and distance the corpus is cut into rings of bounded size. A query first searches its own ring,
which gives it a score to beat, and then only the rings whose distances the triangle inequality
cannot rule out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from replyscope.llm.rows import map_batches, stored

PIVOTS = 64
RING_ROWS = 4096
# Rings grow beyond RING_ROWS where there would be more of them, so the table of rings has a bound
MAX_RINGS = 1 << 18
# Rounding of lengths and distances is far below this, relative to the vectors' length
SLACK = 1e-6
# The score of a query's own row; its negative is a number too
NEVER = np.iinfo(np.int64).min + 1


def quantised(rows: DataFrame, key: str, vector: str, factor: int = 256) -> DataFrame:
    """(id, v): floor(factor * x) for each component x, of rows with an id and finite components only. Repeated rows count once."""
    usable = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("_v")).where(
        F.col("id").isNotNull()
        & F.col("_v").isNotNull()
        & F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    )
    return usable.select("id", F.transform("_v", lambda x: F.floor(x * factor)).alias("v"))


def matrix_of(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column as a matrix; shorter vectors are filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer inner products; floating point is used where it is exact."""
    most = float(np.abs(left).max(initial=0)) * float(np.abs(right).max(initial=0)) * left.shape[1]
    if most < 2.0**53:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


class Pivots:
    """Pivots in the lifted space: the vector, and what is missing to the common length."""

    def __init__(self, vectors: np.ndarray, longest: float):
        self.longest = longest
        self.points = self.lift(vectors)

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        rows = vectors.astype(np.float64)
        missing = np.sqrt(np.maximum(self.longest**2 - (rows**2).sum(axis=1), 0.0))
        return np.column_stack([rows, missing])

    def distances(self, lifted: np.ndarray) -> np.ndarray:
        squares = (lifted**2).sum(axis=1)[:, None] + (self.points**2).sum(axis=1) - 2 * lifted @ self.points.T
        return np.sqrt(np.maximum(squares, 0.0))


def pivots_of(corpus: DataFrame, count: int) -> tuple[Pivots, int] | None:
    """Pivots from a sample of ``count`` vectors, those whose ids hash lowest, and the longest vector; None for no rows."""
    squares = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    facts = corpus.agg(F.max(F.size("v")).alias("width"), F.max(squares).alias("square")).first()
    if facts["width"] is None:
        return None
    rows = corpus.orderBy(F.xxhash64("id"), "id").limit(count).collect()
    vectors = np.zeros((len(rows), facts["width"]), dtype=np.int64)
    for at, row in enumerate(rows):
        vectors[at, : len(row["v"])] = row["v"]
    return Pivots(vectors, float(np.sqrt(facts["square"]))), facts["width"]


def with_home(rows: DataFrame, pivots: Pivots, width: int) -> DataFrame:
    """Add the nearest pivot and the distance from it."""

    def work():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            distances = pivots.distances(pivots.lift(matrix_of(batch.column("v"), width)))
            cells = distances.argmin(axis=1)
            return [pa.array(cells, pa.int32()), pa.array(distances[np.arange(len(cells)), cells])]

        return step

    return map_batches(rows, ["v"], rows.columns, "cell int, distance double", work)


def ring_index(corpus: DataFrame, pivots: Pivots, width: int, ring_rows: int) -> DataFrame:
    """(id, v, cell, distance, ring): the corpus in the order of cell and distance, cut into rings of at most ``ring_rows``.

    The order is a range partitioning, so a cell that holds a third of all rows, or many copies of one
    vector, is spread over tasks like any other. Written once; ring numbers are fixed from then on.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring, filled, last = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            rings = []
            for cell in batch.column("cell").to_pylist():
                if last is not None and (cell != last or filled == ring_rows):
                    ring, filled = ring + 1, 0
                last, filled = cell, filled + 1
                rings.append(ring)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rings, pa.int64())], names=[*batch.schema.names, "ring"])

    order = ["cell", "distance", "id"]
    parts = with_home(corpus, pivots, width).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "id bigint, v array<bigint>, cell int, distance double, ring bigint"
    return stored(parts.mapInArrow(cut, schema), "rings")


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (score, id) of each row, ties to the smaller id. ``ids`` ascends, so a stable sort settles ties."""
    order = np.argsort(-scores, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(scores, order, axis=1), ids[order]


def search_rings(visits: DataFrame, index: DataFrame, k: int, width: int) -> DataFrame:
    """(query_id, vec_id, score): the k best of each visited ring for each query.

    ``visits`` has query_id, v and ring. Rows of a ring come first in its task, then its queries, one batch
    after another: a task holds one ring, however many queries visit it.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring, ids, vectors = None, [], []
        for batch in batches:
            rings = batch.column("ring").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(rings) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for start, end in zip([0, *edges], [*edges, len(rings)], strict=True):
                part = batch.slice(start, end - start)
                keys, rows = part.column("id").to_numpy(), matrix_of(part.column("v"), width)
                if rings[start] != ring:
                    ring, ids, vectors = rings[start], [], []
                if not asks[start]:
                    ids.append(keys)
                    vectors.append(rows)
                    continue
                if not ids:
                    continue
                all_ids, all_rows = np.concatenate(ids), np.concatenate(vectors)
                order = np.argsort(all_ids, kind="stable")
                all_ids, all_rows = all_ids[order], all_rows[order]
                ids, vectors = [all_ids], [all_rows]
                for at in range(0, len(keys), 512):
                    asking = keys[at : at + 512]
                    scores = products(rows[at : at + 512], all_rows)
                    own = asking[:, None] == all_ids
                    scores = np.where(own, NEVER, scores)
                    best, found = best_of(scores, all_ids, k)
                    real = best != NEVER
                    queries = np.repeat(asking, real.sum(axis=1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(queries), pa.array(found[real]), pa.array(best[real])], names=["query_id", "vec_id", "score"]
                    )

    rows = index.select("id", "v", "ring", F.lit(False).alias("asks"))
    asked = visits.select(F.col("query_id").alias("id"), "v", "ring", F.lit(True).alias("asks"))
    together = rows.unionByName(asked).repartition("ring").sortWithinPartitions("ring", "asks")
    return together.mapInArrow(search, "query_id bigint, vec_id bigint, score bigint")


def top_k(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query with their rank."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def exact_top_k(
    corpus: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    pivots: int = PIVOTS,
    ring_rows: int = RING_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` rows of ``corpus`` with the highest integer inner product.

    Components x become floor(256 * x). Rows with a null id, a null vector or a null or non-finite component
    take no part; a query is never its own match; ties go to the smaller id, so repeated rows and equal
    vectors have one result. A shorter vector counts as filled with zeros. Empty tables give an empty
    result, and a query has fewer rows if there are not ``k`` others. Only the key and the vector are
    looked at. The driver holds a sample of ``pivots`` rows and the bounded table of rings.
    """
    rows = quantised(corpus, key, vector).distinct()
    asked = quantised(queries, key, vector).distinct()
    base = stored(rows, "vectors")
    known = pivots_of(base, pivots)
    if known is None:
        return corpus.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    points, width = known
    ring_rows = max(ring_rows, -(-base.count() // MAX_RINGS))
    index = ring_index(base, points, width, ring_rows)
    rings = index.groupBy("ring", "cell").agg(F.min("distance").alias("low"), F.max("distance").alias("high"))
    rings = stored(rings, "ring-bounds")
    wide = F.max(F.size("v"))
    width = max(width, asked.agg(wide).first()[0] or 0)
    homes = stored(with_home(asked.withColumnRenamed("id", "query_id"), Pivots(pad(points, width), points.longest), width), "queries")
    first = search_rings(homes.join(first_rings(homes, rings), "query_id"), index, k, width)
    first = stored(first, "first-rings")
    worst = top_k(first, k).groupBy("query_id").agg(F.min("score").alias("worst"), F.count("*").alias("n"))
    beaten = worst.select("query_id", F.when(F.col("n") == k, F.col("worst")).alias("worst"))
    visits = open_rings(homes.join(beaten, "query_id", "left"), rings, Pivots(pad(points, width), points.longest), width)
    more = search_rings(visits.join(first_rings(homes, rings), ["query_id", "ring"], "left_anti"), index, k, width)
    return top_k(first.unionByName(more), k)


def pad(points: Pivots, width: int) -> np.ndarray:
    """The pivots' own vectors with zeros up to ``width``."""
    vectors = points.points[:, :-1]
    return np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))


def first_rings(homes: DataFrame, rings: DataFrame) -> DataFrame:
    """(query_id, ring): the ring of the query's own cell nearest to its distance."""
    gap = F.greatest(F.col("low") - F.col("distance"), F.col("distance") - F.col("high"), F.lit(0.0))
    near = homes.select("query_id", "cell", "distance").join(rings, "cell")
    return near.groupBy("query_id").agg(F.min_by("ring", F.struct(gap, "ring")).alias("ring"))


def open_rings(homes: DataFrame, rings: DataFrame, pivots: Pivots, width: int) -> DataFrame:
    """(query_id, v, ring): rings that may hold a row as good as the query's worst result so far.

    |d(query, pivot) - d(row, pivot)| is at most d(query, row), and equal length turns that distance into a
    bound on the inner product. The table of rings has some ``MAX_RINGS`` small rows at most, besides one
    per cell and partition, and goes to every task that holds queries.
    """
    table = rings.orderBy("ring").select("ring", "cell", "low", "high").toPandas()
    ring, cell = table["ring"].to_numpy(), table["cell"].to_numpy()
    low, high = table["low"].to_numpy(), table["high"].to_numpy()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rows = matrix_of(part.column("v"), width)
                # A query may be longer than every row; it is compared at its own length
                lifted = np.column_stack([rows.astype(np.float64), np.zeros(len(rows))])
                away = pivots.distances(lifted)[:, cell]
                nearest = np.maximum(np.maximum(low - away, away - high), 0.0)
                square = (rows.astype(np.float64) ** 2).sum(axis=1)
                bound = (square[:, None] + pivots.longest**2 - nearest**2) / 2
                bound += SLACK * (square[:, None] + pivots.longest**2 + 1)
                worst = part.column("worst").to_numpy(zero_copy_only=False).astype(np.float64)
                keep = np.isnan(worst)[:, None] | (bound >= worst[:, None])
                who, where = np.nonzero(keep)
                yield pa.RecordBatch.from_arrays(
                    [part.column("query_id").take(pa.array(who)), part.column("v").take(pa.array(who)), pa.array(ring[where], pa.int64())],
                    names=["query_id", "v", "ring"],
                )

    return homes.select("query_id", "v", "worst").mapInArrow(look, "query_id bigint, v array<bigint>, ring bigint")
