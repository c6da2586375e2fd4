"""Density clustering with a fixed cut.

A vector is a core point when at least ``min_samples`` vectors (itself included) reach the
similarity cut. Clusters are the connected components of core points under the same cut;
components below the minimum size and all other points are noise (-1).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from replyscope import fixed_values as fixed
from replyscope.operators.ranking import PREFIX, bucket_rank
from replyscope.operators.similarity import (
    CORPUS_BLOCK_ROWS,
    QUERY_BLOCK_ROWS,
    SCALE,
    block_tasks,
    build_cells,
    chunk_rows,
    close_pairs,
    collapse_copies,
    matrix,
    narrow,
    query_part_count,
    radius_of,
)
from replyscope.operators.skew import lookup_join
from replyscope.session import cut_lineage


# Cells of an adjacency matrix held at a time, and the cells for each link from which on links are listed
DENSE_CELLS = 1 << 24
SPARSE = 64


def neighbour_weights(points: DataFrame, similarity: float, block_rows: int, query_rows: int) -> DataFrame:
    """(_key, _degree): copies-weighted number of points at or above the cut, per point.

    A task returns one partial count per point, never the neighbours themselves.
    """
    limit = int(round(similarity * SCALE))
    cells = build_cells(points, "_key", "_vector", 1, block_rows)
    key_type = points.schema["_key"].dataType
    out = pa.schema([("_key", to_arrow_type(key_type)), ("_part_degree", pa.int64())])

    def load(right: pa.Table):
        theirs, weights = matrix(right.column("_vector")), right.column("_copies").to_numpy()
        return theirs, narrow(theirs).T.copy(), np.flatnonzero(weights > 1), weights[weights > 1] - 1

    def count(left: pa.Table, block) -> pa.Table:
        ours, (theirs, slim, several, more) = matrix(left.column("_vector")), block
        rows = chunk_rows(len(theirs))
        near = (close_pairs(ours[start : start + rows], theirs, slim, limit) for start in range(0, len(ours), rows))
        totals = [np.count_nonzero(close, axis=1) + close[:, several] @ more for close in near]
        return pa.Table.from_arrays([left.column("_key"), pa.array(np.concatenate(totals), pa.int64())], schema=out)

    parts = block_tasks(
        points,
        points,
        "_key",
        "_key",
        "_vector",
        cells,
        query_part_count(points, cells),
        radius_of(similarity),
        1,
        load,
        count,
        f"_key {key_type.simpleString()}, _part_degree bigint",
        query_rows,
    )
    return parts.groupBy("_key").agg(F.sum("_part_degree").alias("_degree"))


def block_components(adjacent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component number of each row and column of a bipartite adjacency matrix; -1 if isolated."""
    rows, columns = adjacent.shape
    none = np.int32(rows)
    if np.count_nonzero(adjacent) * SPARSE <= adjacent.size:
        return few_links(*np.divmod(np.flatnonzero(adjacent), max(1, columns)), rows, columns)
    left = np.where(adjacent.any(axis=1), np.arange(rows, dtype=np.int32), none)
    while True:
        right = np.where(adjacent, left[:, None], none).min(axis=0)
        lowered = np.where(adjacent, right[None, :], none).min(axis=1)
        if (lowered == left).all():
            return np.where(left < none, left, -1), np.where(right < none, right, -1)
        left = lowered


def few_links(at: np.ndarray, to: np.ndarray, rows: int, columns: int) -> tuple[np.ndarray, np.ndarray]:
    """The same from the places of the links, for few of them."""
    none = np.int32(rows)
    left, right = np.full(rows, none), np.full(columns, none)
    left[at] = at
    while True:
        np.minimum.at(right, to, left[at])
        lowered = left.copy()
        np.minimum.at(lowered, at, right[to])
        if (lowered == left).all():
            return np.where(left < none, left, -1), np.where(right < none, right, -1)
        left = lowered


def core_links(core: DataFrame, similarity: float, block_rows: int, query_rows: int) -> DataFrame:
    """(_key, _other): links that keep exactly the connections between core points.

    Each task finds the components inside its block and returns one link per point.
    """
    limit = int(round(similarity * SCALE))
    cells = build_cells(core, "_key", "_vector", 1, block_rows)
    key_type = core.schema["_key"].dataType
    arrow_key = to_arrow_type(key_type)
    out = pa.schema([("_key", arrow_key), ("_other", arrow_key)])

    def load(right: pa.Table):
        theirs = matrix(right.column("_vector"))
        return right.column("_key"), theirs, narrow(theirs).T.copy()

    def link(left: pa.Table, block) -> pa.Table:
        right_keys, theirs, slim = block
        ours = matrix(left.column("_vector"))
        tables, at_once = [], max(1, DENSE_CELLS // max(1, len(theirs)))
        # Each slice is linked by itself, through the rows of the block
        for first in range(0, len(ours), at_once):
            piece = ours[first : first + at_once]
            rows = chunk_rows(len(theirs))
            close = [close_pairs(piece[start : start + rows], theirs, slim, limit) for start in range(0, len(piece), rows)]
            components = block_components(np.vstack(close))
            keys = left.column("_key").slice(first, len(piece))
            for side, component in zip((keys, right_keys), components, strict=True):
                at = np.flatnonzero(component >= 0)
                center = keys.take(pa.array(component[at]))
                tables.append(pa.Table.from_arrays([side.take(pa.array(at)), center], schema=out))
        return pa.concat_tables(tables)

    name = key_type.simpleString()
    links = block_tasks(
        core,
        core,
        "_key",
        "_key",
        "_vector",
        cells,
        query_part_count(core, cells),
        radius_of(similarity),
        1,
        load,
        link,
        f"_key {name}, _other {name}",
        query_rows,
    )
    return links.where(F.col("_key") != F.col("_other")).distinct()


def connected_components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(_key, _root): the lowest id that can be reached from each node.

    Each round takes the lowest label among the neighbours and then the label of that label.
    Minima are combined before the shuffle, so a node with very many links is no bottleneck.
    """
    both = cut_lineage(
        links.select("_key", "_other").unionByName(links.select(F.col("_other").alias("_key"), F.col("_key").alias("_other")))
    )
    n_links, n_nodes = both.count(), nodes.count()
    labels = nodes.select("_key", F.col("_key").alias("_root"))
    while True:
        known = labels.select(F.col("_key").alias("_other"), F.col("_root").alias("_near"))
        nearest = lookup_join(both, known, "_other", total=n_links).groupBy("_key").agg(F.min("_near").alias("_near"))
        lowered = cut_lineage(
            labels.join(nearest, "_key", "left").select(
                "_key", F.col("_root").alias("_old"), F.least("_root", "_near").alias("_mid")
            )
        )
        jump = lowered.select(F.col("_key").alias("_mid"), F.col("_mid").alias("_next"))
        step = cut_lineage(
            lookup_join(lowered, jump, "_mid", total=n_nodes).select("_key", "_old", F.least("_mid", "_next").alias("_root"))
        )
        labels = step.select("_key", "_root")
        if step.where(F.col("_old") != F.col("_root")).isEmpty():
            return labels


def cluster_density(
    df: DataFrame,
    key: str,
    vector: str = "embedding",
    *,
    similarity: float,
    min_samples: int | None = None,
    min_cluster_size: int = fixed.MIN_CLUSTER_SIZE,
    block_rows: int = CORPUS_BLOCK_ROWS,
    query_block_rows: int = QUERY_BLOCK_ROWS,
) -> DataFrame:
    """(key, cluster): cluster number from 0, or -1 for noise."""
    needed = min_cluster_size if min_samples is None else min_samples
    rows = df.select(F.col(key).alias("_id"), F.col(vector).alias("_vector")).where("_vector is not null")
    points = cut_lineage(collapse_copies(rows, "_id", "_vector"))
    degrees = neighbour_weights(points, similarity, block_rows, query_block_rows)
    core = cut_lineage(points.join(degrees.where(F.col("_degree") >= needed).select("_key"), "_key", "left_semi"))
    labels = connected_components(core, core_links(core.select("_key", "_vector"), similarity, block_rows, query_block_rows))
    sizes = (
        core.join(labels, "_key").groupBy("_root").agg(F.sum("_copies").alias("_members")).where(
            F.col("_members") >= min_cluster_size
        )
    )
    digest = F.md5(F.col("_root").cast("string"))
    numbered = bucket_rank(sizes, [], F.substring(digest, 1, PREFIX), [digest], "_number")
    clusters = labels.join(numbered, "_root").select("_key", (F.col("_number") - 1).cast("int").alias("cluster"))
    # Clusters go to the distinct vectors first, so copies of one vector stay in place
    known = points.select("_vector", "_key").join(clusters, "_key", "left").select("_vector", "cluster")
    return (
        lookup_join(rows, known, "_vector")
        .select(F.col("_id").alias(key), F.coalesce("cluster", F.lit(-1)).alias("cluster"))
    )
