"""Product codes of vectors, learned by exact rounds of k-means with stamped bounds.

A vector is cut into parts, and each part position has a small codebook of its own. Every part keeps two
bounds, each with the round in which it was measured: how near its own entry was, and how far the next one.
The codebooks of all rounds are kept, so a bound is carried to the present by the distance between the entry
then and now. That net displacement is at most the sum of the moves in between, so bounds stay tight where
entries wander to and fro. Only where the bounds meet is a distance computed: first that to the own entry,
then, if need be, those to all entries of the codebook.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from replyscope.llm.rows import ROWS_AT_ONCE, forget, stored
from replyscope.operators.skew import lookup_join

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
# Components beyond this would take squared distances out of 64 bits
LARGEST = 1 << 24
# Stands for the second-nearest entry of a codebook that has one entry
NO_OTHER = 1e300
# Rounding of roots and differences is far below this, relative to the bounds
SLACK = 1e-9
# Sums per label go to all tasks up to this many labels; beyond it they are joined
BROADCAST_LABELS = 100_000
HOT_LABEL_ROWS = 10_000


@dataclass
class Codebooks:
    """History of codebooks: one array (parts, entries, part width) per round.

    Its size is rounds x entries x vector width, whatever the number of rows.
    """

    history: list[np.ndarray]

    @property
    def latest(self) -> np.ndarray:
        return self.history[-1]

    def displacement(self) -> tuple[np.ndarray, np.ndarray]:
        """How far entries are from where they were: by (round, part, entry), and the largest among the other entries."""
        gone = np.stack([np.sqrt(((self.latest - old).astype(np.float64) ** 2).sum(axis=2)) for old in self.history])
        entries = gone.shape[2]
        if entries < 2:
            return gone, np.zeros_like(gone)
        order = np.sort(gone, axis=2)
        largest = order[:, :, -1:]
        is_largest = np.arange(entries) == gone.argmax(axis=2)[:, :, None]
        return gone, np.where(is_largest, order[:, :, -2:-1], largest)

    def digest(self) -> str:
        """Lowercase hex SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.latest.ravel().tolist())).encode()).hexdigest()


def squares(vectors: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows to integer entries."""
    most = float(np.abs(vectors).max(initial=0)) + float(np.abs(entries).max(initial=0))
    if most * most * max(1, vectors.shape[-1]) < 2.0**52:
        left, right = vectors.astype(np.float64), entries.astype(np.float64)
        gaps = (left**2).sum(axis=1)[:, None] + (right**2).sum(axis=1) - 2 * left @ right.T
        return gaps.astype(np.int64)
    return ((vectors[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)


@dataclass
class Bounds:
    """State of a block of vectors, each array (rows, parts): own entry, and both bounds with their stamps."""

    entry: np.ndarray
    near: np.ndarray
    near_round: np.ndarray
    far: np.ndarray
    far_round: np.ndarray

    @classmethod
    def blank(cls, rows: int, parts: int) -> Bounds:
        """Bounds that say nothing, so that the first round measures everything."""
        zero = lambda: np.zeros((rows, parts), dtype=np.int8)
        return cls(zero(), np.full((rows, parts), np.inf), zero(), np.zeros((rows, parts)), zero())


def assign(vectors: np.ndarray, bounds: Bounds, books: Codebooks) -> tuple[int, int]:
    """Bring ``bounds`` up to the latest codebooks; returns how many parts were measured once, and how many rescanned.

    ``vectors`` is (rows, parts, part width). Ties go to the lower entry: a part is left alone only if its
    entry is strictly nearer than any other can be.
    """
    gone, others = books.displacement()
    now, place = len(books.history) - 1, np.arange(vectors.shape[1])
    near = bounds.near + gone[bounds.near_round, place, bounds.entry]
    far = bounds.far - others[bounds.far_round, place, bounds.entry]
    doubt = near >= far - SLACK * (near + np.abs(far) + 1)
    rows, parts = np.nonzero(doubt)
    if not len(rows):
        return 0, 0
    gap = vectors[rows, parts] - books.latest[parts, bounds.entry[rows, parts]]
    exact = np.sqrt((gap * gap).sum(axis=1).astype(np.float64))
    bounds.near[rows, parts], bounds.near_round[rows, parts] = exact, now
    reach = far[rows, parts]
    still = exact >= reach - SLACK * (exact + np.abs(reach) + 1)
    rows, parts = rows[still], parts[still]
    for part in np.unique(parts):
        at = rows[parts == part]
        all_gaps = squares(vectors[at, part], books.latest[part])
        own = all_gaps.argmin(axis=1)
        bounds.entry[at, part] = own
        bounds.near[at, part] = np.sqrt(all_gaps[np.arange(len(at)), own].astype(np.float64))
        if all_gaps.shape[1] > 1:
            all_gaps[np.arange(len(at)), own] = np.iinfo(np.int64).max
            bounds.far[at, part] = np.sqrt(all_gaps.min(axis=1).astype(np.float64))
        else:
            bounds.far[at, part] = NO_OTHER
        bounds.near_round[at, part] = bounds.far_round[at, part] = now
    return int(doubt.sum()), len(rows)


def part_sums(vectors: np.ndarray, entry: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact sums (parts, entries, part width) and counts (parts, entries) of a block's parts by their entry."""
    _, parts, width = vectors.shape
    slots = parts * entries
    slot = (np.arange(parts) * entries + entry).ravel()
    order = np.argsort(slot, kind="stable")
    counts = np.bincount(slot, minlength=slots)
    sums = np.zeros((slots, width), dtype=np.int64)
    used = np.flatnonzero(counts)
    if width and len(used):
        starts = (np.cumsum(counts) - counts)[used]
        sums[used] = np.add.reduceat(vectors.reshape(-1, width)[order], starts, axis=0)
    return sums.reshape(parts, entries, width), counts.reshape(parts, entries)


def quantised(rows: DataFrame, key: str, vector: str, label: str | None, scale: int) -> DataFrame:
    """(id, label, v): floor(scale * x) of every component, of rows whose vector has finite components only."""
    name = F.lit(None).cast("string") if label is None else F.col(label)
    raw = rows.select(F.col(key).alias("id"), name.alias("label"), F.col(vector).cast("array<double>").alias("raw"))
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    held = raw.where(F.col("raw").isNotNull() & finite)
    fits = lambda x: F.when(F.abs(x * scale) <= LARGEST, F.floor(x * scale).cast("int"))
    too_large = F.raise_error(F.lit("a component is too large for exact distances")).cast("int")
    return held.select("id", "label", F.transform("raw", lambda x: F.coalesce(fits(x), too_large)).alias("v"))


STATE = ["entry", "near", "near_round", "far", "far_round"]
STATE_DDL = "entry binary, near binary, near_round binary, far binary, far_round binary"
STATE_TYPES = [np.int8, np.float32, np.int8, np.float32, np.int8]


def packed(bounds: Bounds) -> list[pa.Array]:
    """The state as one short binary per row and field. Bounds are rounded outwards, so they stay true."""
    near, far = bounds.near.astype(np.float32), bounds.far.clip(max=3e38).astype(np.float32)
    near = np.where(near < bounds.near, np.nextafter(near, np.float32(np.inf)), near)
    far = np.where(far > bounds.far, np.nextafter(far, np.float32(-np.inf)), far)
    columns = [bounds.entry, near, bounds.near_round, far, bounds.far_round]
    return [pa.array([row.tobytes() for row in np.ascontiguousarray(c)], pa.binary()) for c in columns]


def unpacked(batch: pa.RecordBatch, parts: int) -> Bounds:
    columns = [np.frombuffer(b"".join(batch.column(n).to_pylist()), dtype=t).reshape(-1, parts) for n, t in zip(STATE, STATE_TYPES, strict=True)]
    entry, near, near_round, far, far_round = columns
    return Bounds(entry.copy(), near.astype(np.float64), near_round.copy(), far.astype(np.float64), far_round.copy())


def matrix_of(column: pa.Array, parts: int, width: int) -> np.ndarray:
    """Rows of a list column as (rows, parts, part width); shorter vectors are filled with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), parts * width), dtype=np.int64)
    out[np.arange(parts * width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out.reshape(len(column), parts, width)


def one_round(table: DataFrame, books: Codebooks, first: bool) -> DataFrame:
    """The table with its bounds brought up to the latest codebooks.

    The last row of each task has no vector but ``sums``: components, then counts, then the numbers of parts
    measured once and rescanned. They are written with the rows, so a task that is run again counts once.
    """
    parts, entries, width = books.latest.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((parts, entries, width), dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
        looked, schema = np.zeros(2, dtype=np.int64), None
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                vectors = matrix_of(batch.column("v"), parts, width)
                bounds = Bounds.blank(len(vectors), parts) if first else unpacked(batch, parts)
                looked += assign(vectors, bounds, books)
                more, many = part_sums(vectors, bounds.entry, entries)
                sums += more
                counts += many
                none = pa.nulls(len(vectors), pa.list_(pa.int64()))
                kept = [batch.column(name) for name in ("id", "label", "v")]
                out = pa.RecordBatch.from_arrays([*kept, *packed(bounds), none], names=["id", "label", "v", *STATE, "sums"])
                schema = out.schema
                yield out
        if schema is not None:
            total = np.concatenate([sums.ravel(), counts.ravel(), looked]).tolist()
            values = [pa.nulls(1, field.type) for field in schema][:-1]
            yield pa.RecordBatch.from_arrays([*values, pa.array([total], pa.list_(pa.int64()))], names=schema.names)

    fields = [f"{name} {table.schema[name].dataType.simpleString()}" for name in ("id", "label", "v")]
    return table.select("id", "label", "v", *([] if first else STATE)).mapInArrow(run, f"{', '.join(fields)}, {STATE_DDL}, sums array<bigint>")


def totals_of(table: DataFrame, books: Codebooks) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums, counts and looks of all tasks; as many rows reach the driver as the codebooks have numbers."""
    parts, entries, width = books.latest.shape
    added = table.where("sums is not null").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("total"))
    values = np.zeros(parts * entries * (width + 1) + 2, dtype=np.int64)
    for pos, total in added.collect():
        values[pos] = total
    cut = parts * entries * width
    return values[:cut].reshape(parts, entries, width), values[cut:-2].reshape(parts, entries), values[-2:]


def moved(books: Codebooks, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Entries at floor(sum / count) of their parts; entries without parts stay."""
    mean = sums // np.maximum(counts, 1)[:, :, None]
    return np.where(counts[:, :, None] > 0, mean, books.latest)


def lowest_ids(table: DataFrame, count: int) -> DataFrame:
    """(id, v): of each task the ``count`` smallest ids, each with the smallest of its vectors, so few rows are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict = {}
        for batch in batches:
            ids = batch.column("id")
            names = {*best, *pc.unique(ids).to_pylist()} - {None}
            wanted = sorted(names)[:count]
            best = {name: best[name] for name in wanted if name in best}
            mine = batch.filter(pc.is_in(ids, pa.array(wanted, ids.type)))
            for name, vector in zip(mine.column("id").to_pylist(), mine.column("v"), strict=True):
                values = vector.as_py()
                if name not in best or values < best[name]:
                    best[name] = values
        if best:
            names = sorted(best)
            yield pa.RecordBatch.from_arrays([pa.array(names, ids.type), pa.array([best[n] for n in names], pa.list_(pa.int32()))], names=["id", "v"])

    return table.select("id", "v").mapInArrow(run, f"id {table.schema['id'].dataType.simpleString()}, v array<int>")


def first_codebooks(table: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """The parts of the vectors with the smallest ids; of an id with several vectors, the smallest. None without an id."""
    width = table.agg(F.max(F.size("v"))).first()[0]
    seeds = lowest_ids(table, entries).groupBy("id").agg(F.min("v").alias("v")).orderBy("id").limit(entries).collect()
    if not seeds:
        return None
    part_width = -(-width // parts)
    start = matrix_of(pa.array([list(row["v"]) for row in seeds], pa.list_(pa.int32())), parts, part_width)
    return Codebooks([start.transpose(1, 0, 2).copy()])


def final_codes(table: DataFrame, books: Codebooks, first: bool) -> DataFrame:
    """(id, label, code, error): entries as two hex digits by part, and exact squared distances summed over parts."""
    parts, _, width = books.latest.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                vectors = matrix_of(batch.column("v"), parts, width)
                bounds = Bounds.blank(len(vectors), parts) if first else unpacked(batch, parts)
                assign(vectors, bounds, books)
                gap = vectors - books.latest[np.arange(parts), bounds.entry]
                error = (gap * gap).sum(axis=(1, 2))
                codes = pa.array([row.tobytes().hex() for row in bounds.entry.astype(np.uint8)], pa.string())
                columns = [batch.column("id"), batch.column("label"), codes, pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error"])

    fields = [f"{name} {table.schema[name].dataType.simpleString()}" for name in ("id", "label")]
    return table.select("id", "label", "v", *([] if first else STATE)).mapInArrow(run, f"{', '.join(fields)}, code string, error bigint")


def with_label_error(codes: DataFrame) -> DataFrame:
    """Add ``label_error``, the error summed over equal labels; nulls count as one label.

    Sums are made in the tasks before a shuffle, so a label of any size is cheap. Their table goes to all
    tasks if it is small; else only the rows of frequent labels stay in place and the others are joined.
    """
    tagged = codes.withColumn("_label", F.struct(F.col("label").alias("of")))
    sums = stored(tagged.groupBy("_label").agg(F.sum("error").alias("label_error")), "label-errors")
    if sums.count() <= BROADCAST_LABELS:
        return tagged.join(F.broadcast(sums), "_label").drop("_label")
    return lookup_join(tagged, sums, "_label", hot_rows=HOT_LABEL_ROWS).drop("_label")


def compress(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str | None = "label",
    *,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    looked: list | None = None,
) -> tuple[DataFrame, Codebooks]:
    """(``key``, ``label``, code, error, label_error) of every row with a whole vector, and the codebooks.

    Rows with a null vector or a null or non-finite component take no part. A null id is coded but founds no
    entry; repeated rows are all coded and counted. Vectors shorter than the longest, or not a multiple of
    ``parts``, count as filled with zeros; with fewer ids than ``entries`` the codebooks are smaller.
    Components beyond 2^24 after scaling raise an error. An empty table, or one without an id, gives an
    empty table and empty codebooks. Only the named columns are looked at. Every round reads the vectors
    once, without a shuffle of them, and writes them with their bounds; the table before is then removed. ``looked``
    collects, per round, the numbers of parts measured once and of parts rescanned.
    """
    if not 1 <= entries <= 127 or not 1 <= rounds <= 126:
        raise ValueError("entries and rounds must fit into seven bits")
    spark = rows.sparkSession
    table = stored(quantised(rows, key, vector, label, scale), "vectors")
    books, name = first_codebooks(table, parts, entries), "label" if label is None else label
    if books is None:
        kinds = [f"`{key}` {table.schema['id'].dataType.simpleString()}", f"`{name}` {table.schema['label'].dataType.simpleString()}"]
        empty = spark.createDataFrame([], f"{', '.join(kinds)}, code string, error bigint, label_error bigint")
        return empty, Codebooks([np.zeros((parts, 0, 0), dtype=np.int64)])
    for turn in range(rounds):
        after = stored(one_round(table.where("v is not null"), books, turn == 0), "vectors")
        forget(table)
        table = after
        sums, counts, seen = totals_of(table, books)
        books = Codebooks([*books.history, moved(books, sums, counts)])
        if looked is not None:
            looked.append(seen.tolist())
    codes = stored(final_codes(table.where("v is not null"), books, rounds == 0), "codes")
    forget(table)
    done = with_label_error(codes)
    return done.select(F.col("id").alias(key), F.col("label").alias(name), "code", "error", "label_error"), books


def decoded(codes: DataFrame, books: Codebooks, code: str = "code", scale: int = SCALE) -> DataFrame:
    """Add ``approximation``, the vector that a code stands for; a null code has none. The codebooks are a constant of the plan."""
    table = [[[float(x) / scale for x in entry] for entry in part] for part in books.latest.tolist()]
    pieces = []
    for at, part in enumerate(table):
        entry = F.conv(F.substring(code, 2 * at + 1, 2), 16, 10).cast("int")
        pieces.append(F.get(F.lit(part), entry) if part else F.array().cast("array<double>"))
    return codes.withColumn("approximation", F.concat(*pieces))
