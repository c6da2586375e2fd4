"""Exact vector search and near-duplicate detection on unit vectors.

Similarity is the inner product of L2-normalised vectors, rounded to six decimals; equal
similarities are ordered by id.

How the work is spread: the corpus is divided into cells around pivots and every cell into
blocks of bounded size; queries are divided into blocks too. A query row is sent, by an equi
join on (cell, block), only to the cells that can hold a result, which the triangle inequality
decides. A task loads one corpus block and lets its queries stream past, some thousand at a
time: a matrix product in memory, of which only the best k rows per query (or one row per query)
leave the task. So neither pairs nor whole cells are ever materialised, a cell with a third of the
corpus is just many blocks, and the corpus is copied only once for every ``QUERY_PART_ROWS`` queries.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from replyscope import fixed_values as fixed
from replyscope.operators.ranking import hash_sample
from replyscope.operators.skew import lookup_join
from replyscope.session import cut_lineage

DIGITS = 6
SCALE = 10**DIGITS
CORPUS_BLOCK_ROWS = 32_768
# Queries that meet a block at a time, and queries that a task lets past its block
QUERY_BLOCK_ROWS = 2048
QUERY_PART_ROWS = 1 << 18
MAX_PIVOTS = 256
MAX_TASKS = 1 << 14
CHUNK_ROWS = 256
# Products that a task holds at a time
CHUNK_CELLS = 1 << 21
# Queries and corpus rows whose products a search makes at a time, and the open pairs a query may have among them
SEARCH_ROWS = 512
TILE_ROWS = 1024
MAX_OPEN = 64
SLACK = 1e-5


def normalise(vector: Column) -> Column:
    """L2-normalised copy of an array column; a zero vector stays zero."""
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    norm = F.sqrt(squares)
    return F.transform(vector, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(F.lit(0.0)))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a list column as a matrix of unit vectors in double precision; zero where the length is zero or not finite."""
    rows = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(rows) == 0:
        return np.zeros((0, 0))
    values = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), -1)
    norms = np.linalg.norm(values, axis=1, keepdims=True)
    return np.divide(values, norms, out=np.zeros_like(values), where=(norms > 0) & np.isfinite(norms))


@dataclass(frozen=True)
class Cells:
    """Pivots and per-cell summary: at most MAX_PIVOTS rows, so it fits in every task."""

    pivots: np.ndarray | None
    near: np.ndarray
    far: np.ndarray
    rows: np.ndarray
    closest: np.ndarray
    block_rows: int

    @property
    def blocks(self) -> np.ndarray:
        return np.maximum(1, -(-self.rows // self.block_rows))

    def home(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell and pivot distance of each vector; zero vectors go to an extra last cell."""
        if self.pivots is None:
            return np.zeros(len(vectors), dtype=np.int32), np.zeros(len(vectors))
        gaps = distances(vectors, self.pivots)
        cell = gaps.argmin(axis=1).astype(np.int32)
        gap = gaps[np.arange(len(vectors)), cell]
        empty = ~vectors.any(axis=1)
        cell[empty], gap[empty] = len(self.pivots), 0.0
        return cell, gap

    def visits(self, vectors: np.ndarray, radius: float | None, k: int) -> list[np.ndarray]:
        """Cells each query must see: all that may hold a row within the radius.

        Without a radius it is the k-th smallest upper bound of a corpus distance.
        """
        occupied = np.flatnonzero(self.rows)
        if self.pivots is None:
            return [occupied] * len(vectors)
        gaps = distances(vectors, self.pivots)
        count = len(self.pivots)
        if radius is None:
            bounds = (gaps[:, :, None] + self.closest[None, :, :]).reshape(len(vectors), -1)
            bounds.partition(k - 1, axis=1)
            reach = bounds[:, k - 1]
        else:
            reach = np.full(len(vectors), radius)
        lower = np.maximum(0.0, np.maximum(gaps - self.far[None, :count], self.near[None, :count] - gaps))
        keep = np.ones((len(vectors), count + 1), dtype=bool)
        keep[:, :count] = lower**2 <= reach[:, None] ** 2 + SLACK
        keep[~vectors.any(axis=1)] = True
        keep &= self.rows[None, :] > 0
        return [np.flatnonzero(row) for row in keep]


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (vectors @ pivots.T)))


def build_cells(
    corpus: DataFrame, key: str, vector: str, k: int, block_rows: int, seed: int = fixed.RANDOM_SEED
) -> Cells:
    """Choose pivots and summarise the cells. Only pivots and summaries reach the driver."""
    size = corpus.count()
    count = min(MAX_PIVOTS, size // block_rows)
    if count < 2:
        return Cells(None, np.zeros(1), np.zeros(1), np.array([size]), np.zeros((1, k)), block_rows)
    sample = hash_sample(corpus.select(key, vector), key, count, seed).select(vector).toArrow()
    pivots = matrix(sample.column(vector))
    pivots = np.unique(pivots[pivots.any(axis=1)], axis=0)
    if len(pivots) < 2:
        return Cells(None, np.zeros(1), np.zeros(1), np.array([size]), np.zeros((1, k)), block_rows)
    blank = Cells(pivots, np.zeros(0), np.zeros(0), np.zeros(0), np.zeros((0, k)), block_rows)
    parts = cut_lineage(cell_summaries(corpus.select(vector), vector, blank, k))
    nearest = Window.partitionBy("cell").orderBy("gap")
    closest = (
        parts.where(F.col("cell") < len(pivots))
        .select("cell", F.explode("closest").alias("gap"))
        .withColumn("place", F.row_number().over(nearest))
        .where(F.col("place") <= k)
    )
    summary = parts.groupBy("cell").agg(F.sum("rows").alias("rows"), F.min("near").alias("near"), F.max("far").alias("far"))
    near, far = np.zeros(len(pivots) + 1), np.zeros(len(pivots) + 1)
    rows, smallest = np.zeros(len(pivots) + 1, dtype=np.int64), np.full((len(pivots), k), np.inf)
    for row in summary.collect():
        near[row["cell"]], far[row["cell"]], rows[row["cell"]] = row["near"], row["far"], row["rows"]
    for row in closest.collect():
        smallest[row["cell"], row["place"] - 1] = row["gap"]
    return Cells(pivots, near, far, rows, smallest, block_rows)


def cell_summaries(df: DataFrame, vector: str, cells: Cells, k: int) -> DataFrame:
    """Per task and cell: rows, lowest and highest pivot distance, and the k lowest distances."""
    schema = pa.schema(
        [
            ("cell", pa.int32()),
            ("rows", pa.int64()),
            ("near", pa.float64()),
            ("far", pa.float64()),
            ("closest", pa.list_(pa.float64())),
        ]
    )

    def summarise(batches):
        totals: dict[int, list] = {}
        for batch in batches:
            cell, gap = cells.home(matrix(batch.column(vector)))
            for number in np.unique(cell):
                gaps = np.sort(gap[cell == number])
                rows, near, far, low = totals.get(number, (0, np.inf, 0.0, np.zeros(0)))
                low = np.sort(np.concatenate([low, gaps[:k]]))[:k]
                totals[number] = (rows + len(gaps), min(near, gaps[0]), max(far, gaps[-1]), low)
        if totals:
            columns = [list(totals), *map(list, zip(*totals.values()))]
            columns[4] = [low.tolist() for low in columns[4]]
            arrays = [pa.array(values, field.type) for values, field in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    return df.mapInArrow(summarise, "cell int, rows long, near double, far double, closest array<double>")


def with_home(df: DataFrame, vector: str, cells: Cells) -> DataFrame:
    """Add the cell and the pivot distance of each row."""
    if cells.pivots is None:
        return df.withColumns({"_cell": F.lit(0), "_gap": F.lit(0.0)})

    def place(batches):
        for batch in batches:
            cell, gap = cells.home(matrix(batch.column(vector)))
            columns = [*batch.columns, pa.array(cell, pa.int32()), pa.array(gap, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_cell", "_gap"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(place, f"{fields}, _cell int, _gap double")


def with_visits(df: DataFrame, vector: str, cells: Cells, radius: float | None, k: int) -> DataFrame:
    """One row for each (query, cell to visit)."""
    if cells.pivots is None:
        return df.withColumn("_cell", F.lit(0))

    def place(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK_ROWS):
                piece = batch.slice(start, CHUNK_ROWS)
                wanted = cells.visits(matrix(piece.column(vector)), radius, k)
                visits = pa.array([row.tolist() for row in wanted], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*piece.columns, visits], names=[*piece.schema.names, "_cells"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(place, f"{fields}, _cells array<int>").withColumn("_cell", F.explode("_cells")).drop("_cells")


def block_tasks(
    queries: DataFrame,
    corpus: DataFrame,
    query_key: str,
    corpus_key: str,
    vector: str,
    cells: Cells,
    query_parts: int,
    radius: float | None,
    k: int,
    prepare,
    work,
    schema: str,
    query_rows: int = QUERY_BLOCK_ROWS,
) -> DataFrame:
    """Run ``work(query table, prepare(corpus table))`` for every corpus block and all queries that must see it.

    The rows of a block come first in its task, then its queries, at most ``query_rows`` at a time, so
    a task holds one block however many queries visit it.
    """
    blocks = F.array(*[F.lit(int(n)) for n in cells.blocks])
    in_cell = F.get(blocks, F.col("_cell"))
    left = (
        with_visits(queries, vector, cells, radius, k)
        .withColumn("_block", F.explode(F.sequence(F.lit(0), in_cell - 1)))
        .withColumn("_part", F.pmod(F.xxhash64(query_key), F.lit(query_parts)).cast("int"))
    )
    right = corpus_rows(corpus, corpus_key, vector, cells, query_parts)
    earlier = F.array(*[F.lit(int(n)) for n in np.cumsum(cells.blocks) - cells.blocks])
    number = (F.get(earlier, F.col("_cell")) + F.col("_block")) * query_parts + F.col("_part")
    n_tasks = int(cells.blocks.sum()) * query_parts

    return stream_past(left, right, ["_cell", "_block", "_part"], number, n_tasks, prepare, work, schema, query_rows)


def stream_past(
    queries: DataFrame, corpus: DataFrame, group: list[str], number: Column, n_tasks: int, prepare, work, schema: str, query_rows: int
) -> DataFrame:
    """Run ``work(queries, prepare(corpus rows))`` in each group, queries in slices of at most ``query_rows``.

    ``group`` are whole-number columns of both sides; the other columns of both begin with an underscore. The corpus
    rows of a group must fit in a task, its queries need not. ``number`` is the number of a group below ``n_tasks``: each
    group is a task of its own, as the work of a group is far more than its bytes say.
    """

    def side(rows: DataFrame, mark: str) -> DataFrame:
        # New column identities, since both sides may come from one table
        return rows.select(*group, F.lit(mark == "q").alias("_asks"), *[F.col(c).alias(f"{mark}{c}") for c in rows.columns if c not in group])

    both = side(corpus, "c").unionByName(side(queries, "q"), allowMissingColumns=True)
    together = both.repartitionById(min(n_tasks, MAX_TASKS), F.pmod(number, F.lit(MAX_TASKS)).cast("int")).sortWithinPartitions(*group, "_asks")

    def run(batches):
        last, loaded, ready = None, [], None
        for batch in batches:
            marks = np.stack([batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in (*group, "_asks")], axis=1)
            edges = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *edges], [*edges, len(marks)], strict=True):
                if end == start:
                    continue
                block, asks = tuple(marks[start, :-1]), bool(marks[start, -1])
                if block != last:
                    last, loaded, ready = block, [], None
                rows = own_columns(batch.slice(start, end - start), "q" if asks else "c")
                if not asks:
                    loaded.append(rows)
                    continue
                if not loaded:
                    continue
                if ready is None:
                    ready = prepare(pa.Table.from_batches(loaded))
                for at in range(0, rows.num_rows, query_rows):
                    found = work(pa.Table.from_batches([rows.slice(at, query_rows)]), ready)
                    yield from found.combine_chunks().to_batches()

    return together.mapInArrow(run, schema)


def corpus_rows(corpus: DataFrame, key: str, vector: str, cells: Cells, query_parts: int) -> DataFrame:
    """The corpus with cell, block and query part; one row for each query part."""
    in_cell = F.get(F.array(*[F.lit(int(n)) for n in cells.blocks]), F.col("_cell"))
    placed = with_home(corpus, vector, cells).drop("_gap").withColumn("_block", F.pmod(F.xxhash64(key), in_cell).cast("int"))
    if query_parts == 1:
        return placed.withColumn("_part", F.lit(0))
    return placed.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))))


def own_columns(batch: pa.RecordBatch, mark: str) -> pa.RecordBatch:
    """The columns of one side of a block task under their own names."""
    names = [name for name in batch.schema.names if name.startswith(f"{mark}_")]
    return pa.RecordBatch.from_arrays([batch.column(name) for name in names], names=[name[1:] for name in names])


def query_part_count(queries: DataFrame, cells: Cells, part_rows: int = QUERY_PART_ROWS) -> int:
    """Enough parts for tasks of bounded time; more only where the corpus blocks alone leave cores idle."""
    size = queries.count()
    return part_count(size, int(cells.blocks.sum()), queries.sparkSession.sparkContext.defaultParallelism, part_rows)


def part_count(queries: int, blocks: int, cores: int, part_rows: int = QUERY_PART_ROWS) -> int:
    return max(1, -(-queries // part_rows), min(-(-cores // blocks), queries // 64))


def ranks(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Ids of several columns as places in their common order, so that pairs are compared as numbers."""
    values = [np.asarray(column.to_pylist(), dtype=object) for column in columns]
    _, places = np.unique(np.concatenate(values), return_inverse=True)
    return np.split(places, np.cumsum([len(v) for v in values])[:-1])


def scaled_similarity(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return np.rint((left @ right.T) * SCALE).astype(np.int64)


def narrow(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in single precision, for products that only decide what is computed exactly."""
    return vectors.astype(np.float32)


def margin(dimensions: int) -> float:
    """More than a product of narrow unit vectors can differ from the exact one."""
    return (dimensions + 8) * 2.0**-23


def chunk_rows(width: int) -> int:
    """Queries whose products with ``width`` corpus rows are held at a time."""
    return max(1, min(CHUNK_ROWS, CHUNK_CELLS // max(1, width)))


def exact_products(left: np.ndarray, right: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Scaled similarity of single pairs, in double precision."""
    step = max(1, 2 * CHUNK_CELLS // max(1, left.shape[1]))
    parts = [
        np.einsum("ij,ij->i", left[rows[at : at + step]], right[columns[at : at + step]]) for at in range(0, len(rows), step)
    ]
    return np.rint((np.concatenate(parts) if parts else np.zeros(0)) * SCALE).astype(np.int64)


def places(rows: np.ndarray) -> np.ndarray:
    """Place, from 0, of each entry among those of its row; rows are ascending."""
    return np.arange(len(rows)) - np.searchsorted(rows, rows)


def same_ids(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Where two id columns have equal values; ids of unlike types never are."""
    try:
        return pc.fill_null(pc.equal(left, right), False).to_numpy(zero_copy_only=False)
    except pa.ArrowNotImplementedError:
        return np.zeros(len(left), dtype=bool)


def nearest_rows(left: np.ndarray, right: np.ndarray, slim: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, column, scaled similarity) of the k most similar corpus rows of each query, best and lowest column first.

    Exact. Products in single precision (``slim`` is the narrow corpus, transposed), made in tiles that stay near the core,
    leave out what cannot be among the best: the k-th largest product so far is a lower bound of the k-th best one. Only
    the pairs left are computed in double precision. A query with too many of them in a tile, as among copies, has all
    its products with that tile computed; the other queries do not.
    """
    width = len(right)
    take = min(k, width)
    asked = narrow(left)
    spare = 2 * margin(left.shape[1]) + 2.0 / SCALE
    tops = np.full((len(left), take), -np.inf, dtype=np.float32)
    parts = []
    # Made once, as new memory for every tile costs as much as a good part of its products
    products, kept = np.empty((len(left), min(width, TILE_ROWS)), np.float32), np.empty((len(left), min(width, TILE_ROWS)), bool)
    for at in range(0, width, TILE_ROWS):
        if width - at < TILE_ROWS:
            products, kept = products[:, : width - at], kept[:, : width - at]
        np.matmul(asked, slim[:, at : at + TILE_ROWS], out=products)
        if at == 0:
            tops = largest(np.concatenate([tops, products], axis=1), take)
        np.greater_equal(products, (tops.min(axis=1) - spare)[:, None], out=kept)
        open_pairs = np.count_nonzero(kept, axis=1)
        crowded = np.flatnonzero(open_pairs > max(MAX_OPEN, take))
        if len(crowded):
            kept[crowded] = best_cells(scaled_similarity(left[crowded], right[at : at + TILE_ROWS]), take)
        hit = np.flatnonzero(open_pairs)
        rows, columns = np.divmod(np.flatnonzero(kept[hit]), kept.shape[1])
        rows = hit[rows]
        values = products[rows, columns]
        if at:
            order = np.lexsort((-values, rows))
            place = places(rows)
            first = place < take
            fresh = np.full_like(tops, -np.inf)
            fresh[rows[first], place[first]] = values[order][first]
            tops = largest(np.concatenate([tops, fresh], axis=1), take)
        parts.append((rows, columns + at, values))
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    rows, columns, values = (np.concatenate(part) for part in zip(*parts))
    still = values >= (tops.min(axis=1) - spare)[rows]
    rows, columns = rows[still], columns[still]
    scaled = exact_products(left, right, rows, columns)
    order = np.lexsort((columns, -scaled, rows))
    rows, columns, scaled = rows[order], columns[order], scaled[order]
    first = places(rows) < take
    return rows[first], columns[first], scaled[first]


def largest(values: np.ndarray, n: int) -> np.ndarray:
    """The n largest values of each row, in no order."""
    return np.partition(values, values.shape[1] - n, axis=1)[:, values.shape[1] - n :]


def best_cells(products: np.ndarray, n: int) -> np.ndarray:
    """Where the n largest whole numbers of each row are, lower columns first among equal ones, as a matrix."""
    width = products.shape[1]
    # A unique integer for each cell of the row: product first, then the lower column
    order = products * width + (width - 1 - np.arange(width))
    return order >= largest(order, min(n, width)).min(axis=1, keepdims=True)


def close_pairs(left: np.ndarray, right: np.ndarray, slim: np.ndarray, limit: int) -> np.ndarray:
    """Where the scaled similarity reaches the limit, as a matrix; exact, with double precision only near the limit."""
    products = narrow(left) @ slim
    spare = margin(left.shape[1]) + 1.0 / SCALE
    close = products >= limit / SCALE + spare
    rows, columns = np.divmod(np.flatnonzero((products >= limit / SCALE - spare) & ~close), max(1, len(right)))
    close[rows, columns] = exact_products(left, right, rows, columns) >= limit
    return close


def knn(
    queries: DataFrame,
    corpus: DataFrame,
    k: int = fixed.TOP_K,
    *,
    query_key: str = "query_id",
    corpus_key: str = "thread_id",
    vector: str = "embedding",
    exclude_same_id: bool = False,
    cells: Cells | None = None,
    corpus_block_rows: int = CORPUS_BLOCK_ROWS,
    query_block_rows: int = QUERY_BLOCK_ROWS,
) -> DataFrame:
    """(query_key, corpus_key, similarity, rank): the k most similar corpus rows of each query.

    Exact. A query gets fewer than k rows only when the corpus is smaller than k.
    ``exclude_same_id`` leaves out the corpus row whose id equals the query's. The corpus is read
    several times, so it should be a stored table; ``cells`` from ``corpus_cells`` spares the
    passes that divide it, for many searches of one corpus.
    """
    left_key, right_key = "_query", "_match"
    left = queries.select(F.col(query_key).alias(left_key), F.col(vector).alias("_vector")).where("_vector is not null")
    right = corpus.select(F.col(corpus_key).alias(right_key), F.col(vector).alias("_vector")).where("_vector is not null")
    reach = k + 1 if exclude_same_id else k
    cells = build_cells(right, right_key, "_vector", reach, corpus_block_rows) if cells is None else cells
    if cells.closest.shape[1] < reach:
        raise ValueError("the cells were built for a smaller k")
    query_type = left.schema[left_key].dataType
    match_type = right.schema[right_key].dataType
    out = pa.schema(
        [(left_key, to_arrow_type(query_type)), (right_key, to_arrow_type(match_type)), ("similarity", pa.float64())]
    )

    def load(corpus_table: pa.Table):
        corpus_table = corpus_table.sort_by(right_key)
        others = matrix(corpus_table.column("_vector"))
        return corpus_table.column(right_key).combine_chunks(), others, narrow(others).T.copy()

    def best(query_table: pa.Table, block) -> pa.Table:
        matches, others, slim = block
        ids, vectors = query_table.column(left_key).combine_chunks(), matrix(query_table.column("_vector"))
        tables = []
        for start in range(0, len(vectors), SEARCH_ROWS):
            rows, columns, scaled = nearest_rows(vectors[start : start + SEARCH_ROWS], others, slim, reach)
            asked, found = ids.take(pa.array(rows + start)), matches.take(pa.array(columns))
            if exclude_same_id:
                other = ~same_ids(asked, found)
                rows, scaled, asked, found = rows[other], scaled[other], asked.filter(pa.array(other)), found.filter(pa.array(other))
            first = places(rows) < k
            asked, found = asked.filter(pa.array(first)), found.filter(pa.array(first))
            tables.append(pa.Table.from_arrays([asked, found, pa.array(scaled[first] / SCALE, pa.float64())], schema=out))
        return pa.concat_tables(tables)

    found = block_tasks(
        left,
        right,
        left_key,
        right_key,
        "_vector",
        cells,
        query_part_count(left, cells),
        None,
        reach,
        load,
        best,
        f"{left_key} {query_type.simpleString()}, {right_key} {match_type.simpleString()}, similarity double",
        query_block_rows,
    )
    return (
        found.withColumn("rank", similarity_rank(left_key, right_key))
        .where(F.col("rank") <= k)
        .select(F.col(left_key).alias(query_key), F.col(right_key).alias(corpus_key), "similarity", "rank")
    )


def corpus_cells(
    corpus: DataFrame, k: int = fixed.TOP_K, key: str = "thread_id", vector: str = "embedding", block_rows: int = CORPUS_BLOCK_ROWS
) -> Cells:
    """Cells of a corpus for searches of up to k rows (one less when the own id is left out)."""
    return build_cells(corpus.select(key, vector).where(F.col(vector).isNotNull()), key, vector, k, block_rows)


def similarity_rank(query_key: str, corpus_key: str) -> Column:
    return F.row_number().over(Window.partitionBy(query_key).orderBy(F.desc("similarity"), corpus_key))


def radius_of(similarity: float) -> float:
    return float(np.sqrt(max(0.0, 2.0 - 2.0 * similarity)))


def collapse_copies(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(_key, _vector, _copies): one row for each different vector, under its lowest id."""
    return df.groupBy(F.col(vector).alias("_vector")).agg(F.min(key).alias("_key"), F.count("*").alias("_copies"))


def near_duplicates(
    df: DataFrame,
    key: str,
    vector: str = "embedding",
    threshold: float = fixed.NEAR_DUPLICATE_SIMILARITY,
    *,
    block_rows: int = CORPUS_BLOCK_ROWS,
    query_block_rows: int = QUERY_BLOCK_ROWS,
) -> DataFrame:
    """(key, duplicate_of): rows more similar than the threshold to a row with a lower id.

    ``duplicate_of`` is the lowest such id. Exact copies are grouped before vectors are
    compared, and a task returns at most one row per vector, so large groups of copies cost
    neither pairs nor comparisons.
    """
    rows = df.select(F.col(key).alias("_id"), F.col(vector).alias("_vector")).where("_vector is not null")
    distinct = cut_lineage(collapse_copies(rows, "_id", "_vector"))
    cells = build_cells(distinct, "_key", "_vector", 1, block_rows)
    limit = int(round(threshold * SCALE))
    key_type = rows.schema["_id"].dataType
    arrow_key = to_arrow_type(key_type)
    out = pa.schema([("_key", arrow_key), ("_lower", arrow_key)])

    def load(corpus_table: pa.Table):
        corpus_table = corpus_table.sort_by("_key")
        right = matrix(corpus_table.column("_vector"))
        return corpus_table.column("_key"), right, narrow(right).T.copy()

    def lowest(query_table: pa.Table, block) -> pa.Table:
        others, right, slim = block
        rows = chunk_rows(len(right))
        ids, left = query_table.column("_key"), matrix(query_table.column("_vector"))
        names, lower = ranks(ids, others)
        at, to = [], []
        for start in range(0, len(left), rows):
            close = close_pairs(left[start : start + rows], right, slim, limit + 1)
            close &= lower[None, :] < names[start : start + rows, None]
            hit = np.flatnonzero(close.any(axis=1))
            at.append(hit + start)
            to.append(close[hit].argmax(axis=1))
        at, to = pa.array(np.concatenate(at)), pa.array(np.concatenate(to))
        return pa.Table.from_arrays([ids.take(at), others.take(to)], schema=out)

    slim = distinct.select("_key", "_vector")
    name = key_type.simpleString()
    found = block_tasks(
        slim,
        slim,
        "_key",
        "_key",
        "_vector",
        cells,
        query_part_count(slim, cells),
        radius_of(threshold),
        1,
        load,
        lowest,
        f"_key {name}, _lower {name}",
        query_block_rows,
    )
    lower = found.groupBy("_key").agg(F.min("_lower").alias("_lower"))
    nonzero = F.exists("_vector", lambda x: x != 0).alias("_nonzero")
    # Results go to the distinct vectors first, so copies of one vector are met only in the join that keeps them in place
    known = distinct.select("_vector", "_key").join(lower, "_key", "left")
    members = lookup_join(rows, known, "_vector").select("_id", "_key", "_lower", nonzero)
    copy_of = F.when((F.col("_id") > F.col("_key")) & F.col("_nonzero") & F.lit(threshold < 1.0), F.col("_key"))
    return (
        members.select(F.col("_id").alias(key), F.least(copy_of, "_lower").alias("duplicate_of"))
        .where(F.col("duplicate_of").isNotNull())
    )


def without_near_duplicates(df: DataFrame, key: str, vector: str = "embedding", **options) -> DataFrame:
    """Keep, of rows more similar than the threshold, those without such a row of lower id."""
    return df.join(near_duplicates(df, key, vector, **options).select(key), key, "left_anti")


def without_held_out(corpus: DataFrame, held_out: DataFrame, key: str = "thread_id") -> DataFrame:
    """Remove held-out rows from a retrieval corpus."""
    return corpus.join(held_out.select(key), key, "left_anti")
