"""Near-duplicate texts by a size-aware, heavy-light Jaccard join of word n-gram sets.

Two sets of sizes a <= b with similarity t share at least c = t (a + b) / (1 + t) shingles. Small (light)
sets enumerate their subsets of that fixed size, so linked sets share a subset. Large (heavy) sets are
found by inverted lists: the shingles of a set are dealt by hash into more parts than linked sets can
differ in, so linked sets have a part in common that is not empty, and a list is kept for each part's
content. (A list for each single shingle would hold every text with a common passage.) The boundary
between the two is the size at which all subsets cost as much as all parts.

Entries of one list are grouped under the smallest set of the list. Each set first meets one of its centres;
then the sets of all groups that this has not put into one component are compared exactly, in chunks. The
result is components, so no task returns more than one link per set, and no list is expanded into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm.rows import ROWS_AT_ONCE, map_batches, stored, text_bytes
from replyscope.session import cut_lineage, tidy

WORDS = 3
# Similarity as a fraction, so that all bounds are whole numbers
SIMILARITY = (90, 100)
# Sets that may be light at all; beyond this size subsets never pay
MOST_LIGHT = 40
CHUNK_SETS = 1024
SLAB_SHINGLES = 4096
RANGE_SHINGLES = 1 << 19
# Ids of texts go to all tasks up to this many rows (some 50 MB)
BROADCAST_ROWS = 500_000
# Buckets of lists hold the entries of about this many shingles each
BUCKET_SHINGLES = 1 << 20
# List entries that a task makes at a time, and entries of a bucket that it gathers before it drops the inner ones of long lists
ENTRIES_AT_ONCE = 1 << 17
BUCKET_ENTRIES = 1 << 20
# The bitmap of shared lists has 2^MOST_BITS bits (16 MB) at most
MOST_BITS = 27
# Texts are hashed in stretches of about this many bytes
STRETCH = 1 << 20
SEED = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x5851F42D4C957F2D


@lru_cache(maxsize=1)
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE modulo 2^64 and their inverses, for places in a stretch."""
    forth = np.full(STRETCH, BASE, dtype=np.uint64)
    back = np.full(STRETCH, pow(BASE, -1, 1 << 64), dtype=np.uint64)
    forth[0] = back[0] = 1
    return np.cumprod(forth), np.cumprod(back)


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    """A random odd number per byte, the same for A-Z and a-z."""
    values = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    values[65:91] = values[97:123]
    return values


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a text, A-Z lower-cased."""
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~SPACE[data]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    forth, back = powers()
    values, out, first = byte_values()[data], np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        origin = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, origin + STRETCH, side="right")))
        stretch = values[origin : ends[last - 1]]
        if len(stretch) > STRETCH:
            # One word longer than a stretch: folded piece by piece
            total = np.zeros(1, np.uint64)
            for at in range(0, len(stretch), STRETCH):
                piece = stretch[at : at + STRETCH]
                total = mix(total + (piece * forth[: len(piece)]).sum(dtype=np.uint64, keepdims=True) + SEED)
            out[first] = total[0]
        else:
            sums = np.concatenate([[np.uint64(0)], np.cumsum(stretch * forth[: len(stretch)], dtype=np.uint64)])
            a, b = starts[first:last] - origin, ends[first:last] - origin
            out[first:last] = (sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64) * SEED
        first = last
    return mix(out)


def shingles(raw: bytes, words: int = WORDS) -> np.ndarray:
    """The set of hashed runs of ``words`` words, sorted; all words as one run if there are fewer; empty without words."""
    hashed = word_hashes(raw)
    if not len(hashed):
        return hashed
    size = min(words, len(hashed))
    out = np.full(len(hashed) - size + 1, np.uint64(size))
    for at in range(size):
        out = mix(out * SEED + hashed[at : at + len(out)])
    return np.unique(out)


def seeded(number: int) -> np.uint64:
    """A multiple of SEED modulo 2^64."""
    return np.uint64(number * int(SEED) & (1 << 64) - 1)


def set_name(members: np.ndarray) -> int:
    """A 64-bit name of a whole set, as a signed number."""
    total = mix(members ^ SEED).sum(dtype=np.uint64, keepdims=True)
    return int(mix(total + seeded(len(members))).view(np.int64)[0])


def least_overlap(a: int, b: int, similarity=SIMILARITY) -> int:
    """Fewest common elements of linked sets of sizes a and b."""
    part, whole = similarity
    return -(-part * (a + b) // (part + whole))


def partner_sizes(size: int, similarity=SIMILARITY) -> range:
    """Sizes that a linked set can have."""
    part, whole = similarity
    return range(-(-part * size // whole), size * whole // part + 1)


def subset_cost(size: int, light: int, similarity=SIMILARITY) -> int:
    """Subsets that a light set enumerates for all light partners."""
    choices = {least_overlap(size, other, similarity) for other in partner_sizes(size, similarity) if other <= light}
    return sum(comb(size, least) for least in choices)


def band_of(size: int, similarity=SIMILARITY) -> int:
    """Bands of sizes, each about as wide as the sizes that can be linked."""
    part, whole = similarity
    return int(np.log(size) / np.log(whole / part) + 1e-9)


def differences_of_band(band: int, similarity=SIMILARITY) -> int:
    """Most elements in which linked sets differ whose smaller one is in a band."""
    part, whole = similarity
    return (int((whole / part) ** (band + 1)) + 1) * (whole - part) // part + 1


@lru_cache(maxsize=4096)
def parts_of_band(band: int, similarity=SIMILARITY) -> int:
    """Parts for pairs whose smaller set is in a band: more than such sets can differ in, by one and by the parts that may be empty.

    Linked sets agree in more parts than a set is likely to leave empty, so they agree in one that is not.
    """
    part, whole = similarity
    least = differences_of_band(band, similarity) + 1
    empty = least * np.exp(-((whole / part) ** band) / least)
    return least + int(np.ceil(empty + 3 * np.sqrt(empty)))


def bands(size: int, light: int, similarity=SIMILARITY) -> list[int]:
    """Bands under which a set looks for partners with which it makes a heavy pair (the larger set is over ``light``)."""
    sizes = partner_sizes(size, similarity)
    if max(size, sizes[-1]) <= light:
        return []
    return list(range(band_of(sizes[0], similarity), band_of(size, similarity) + 1))


def light_boundary(histogram: dict[int, int], similarity=SIMILARITY) -> int:
    """The largest size up to which enumerating subsets costs no more than keeping part lists for the same sets."""
    best = 0
    for light in range(1, MOST_LIGHT + 1):
        sizes = [size for size in histogram if size <= light]
        subsets = sum(histogram[size] * subset_cost(size, light, similarity) for size in sizes)
        parts = sum(histogram[size] * sum(parts_of_band(band, similarity) for band in bands(size, 0, similarity)) for size in sizes)
        if subsets <= parts:
            best = light
    return best


def list_keys(members: np.ndarray, light: int, similarity=SIMILARITY) -> np.ndarray:
    """Names of the lists that a set stands in: subsets of fixed sizes if it is light, parts of heavy pairs."""
    size, keys = len(members), []
    hashed = mix(members ^ np.uint64(0xD6E8FEB86659FD93))
    if size <= light:
        for least in sorted({least_overlap(size, other, similarity) for other in partner_sizes(size, similarity) if other <= light}):
            if least <= size:
                total = hashed.sum(dtype=np.uint64, keepdims=True)
                left_out = [sum((int(hashed[i]) for i in out), 0) & (1 << 64) - 1 for out in combinations(range(size), size - least)]
                keys.append(mix(total - np.array(left_out, dtype=np.uint64) + seeded(2 * least)))
    for band in bands(size, light, similarity):
        parts = parts_of_band(band, similarity)
        dealt = (members >> np.uint64(11)) % np.uint64(parts)
        sums = np.zeros(parts, dtype=np.uint64)
        np.add.at(sums, dealt.astype(np.int64), hashed)
        made = mix(mix(sums + np.arange(parts, dtype=np.uint64) * SEED) + np.uint64(2 * band + 1))
        used = np.bincount(dealt.astype(np.int64), minlength=parts) > 0
        # All parts in which a linked set agrees can be empty only if both have that many empty ones
        keys.append(made[used] if parts - used.sum() < parts - differences_of_band(band, similarity) else made)
    return np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)


def linked_pairs(sets: list[np.ndarray], similarity=SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j, of linked sets: exact intersections as matrix products over the shared shingles.

    Shingles are taken by ranges of their values, so that beside the sets themselves only ``RANGE_SHINGLES`` of them
    or so are in work, however long the texts are.
    """
    part, whole = similarity
    sizes = np.array([len(members) for members in sets], dtype=np.int64)
    common = np.zeros((len(sets), len(sets)), dtype=np.int64)
    ranges = max(1, -(-int(sizes.sum()) // RANGE_SHINGLES))
    bounds = np.array([at * (1 << 64) // ranges for at in range(1, ranges)], dtype=np.uint64)
    cuts = [[0, *np.searchsorted(members, bounds).tolist(), len(members)] for members in sets]
    for at in range(ranges):
        parts = [members[cut[at] : cut[at + 1]] for members, cut in zip(sets, cuts, strict=True)]
        owner = np.repeat(np.arange(len(sets)), [len(members) for members in parts])
        _, place, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        shared = count[place] > 1
        renamed = np.cumsum(count > 1) - 1
        owner, place = owner[shared], renamed[place[shared]]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        for start in range(0, int(place[-1]) + 1 if len(place) else 0, SLAB_SHINGLES):
            a, b = np.searchsorted(place, [start, start + SLAB_SHINGLES])
            slab = np.zeros((len(sets), min(SLAB_SHINGLES, int(place[b - 1]) + 1 - start)), dtype=np.float32)
            slab[owner[a:b], place[a:b] - start] = 1
            common += (slab @ slab.T).astype(np.int64)
    union = sizes[:, None] + sizes - common
    return np.nonzero(np.triu(whole * common >= part * union, 1) & (sizes > 0)[:, None])


def spanning(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that keep the components of a graph, at most one per node."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        ra, rb = find(a), find(b)
        if ra != rb:
            root[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


def document_sets(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles and set_id of every row. Texts are read, not shuffled."""

    def work():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [shingles(raw.as_py(), words) for raw in text_bytes(batch)]
            names = [set_name(members) if len(members) else None for members in found]
            return [pa.array([len(members) for members in found], pa.int64()), pa.array(names, pa.int64())]

        return step

    return map_batches(docs.select("doc_id", "text"), ["text"], ["doc_id"], "n_shingles bigint, set_id bigint", work)


def task_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    """The texts of a task, of which few are copied at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            for raw in text_bytes(batch.slice(start, ROWS_AT_ONCE)):
                yield raw.as_py()


def task_sets(batches: Iterator[pa.RecordBatch], light: int, words: int, similarity) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(lists, set ids) of the texts of a task, some ``ENTRIES_AT_ONCE`` at a time. A set that the task has met before is left out.

    A batch of texts has many more entries than bytes, so it is never turned into entries as a whole.
    """
    met: set[int] = set()
    lists, names, waiting = [], [], 0
    for raw in task_texts(batches):
        members = shingles(raw, words)
        name = set_name(members) if len(members) else None
        if name is None or name in met:
            continue
        if len(met) >= 1_000_000:
            met.clear()
        met.add(name)
        lists.append(list_keys(members, light, similarity))
        names.append(np.full(len(lists[-1]), name, dtype=np.int64))
        waiting += len(lists[-1])
        if waiting >= ENTRIES_AT_ONCE:
            yield np.concatenate(lists), np.concatenate(names)
            lists, names, waiting = [], [], 0
    if lists:
        yield np.concatenate(lists), np.concatenate(names)


def lowest_and_highest(lists: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each different list with its smallest and its largest set."""
    if not len(lists):
        return lists, names, names
    order = np.lexsort((names, lists))
    lists, names = lists[order], names[order]
    first = np.flatnonzero(np.concatenate([[True], lists[1:] != lists[:-1]]))
    return lists[first], names[first], names[np.append(first[1:], len(lists)) - 1]


def shared_lists(docs: DataFrame, light: int, words: int, similarity, n_shingles: int) -> DataFrame:
    """(list, centre): lists of two or more sets, with the smallest.

    A task sends, packed by bucket, the smallest and the largest set that it has of each list, so a list that
    very many sets share is a few entries of each task. Buckets are so many that one fits in a task.
    """
    buckets = max(64, -(-n_shingles // BUCKET_SHINGLES))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in task_sets(batches, light, words, similarity):
            lists, low, high = lowest_and_highest(*found)
            more = low != high
            lists, names = np.concatenate([lists, lists[more]]), np.concatenate([low, high[more]])
            bucket = (lists.view(np.uint64) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, lists, names = bucket[order], lists[order], names[order]
            if not len(bucket):
                continue
            starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            ends = np.append(starts[1:], len(bucket))
            columns = [[c[a:b].tobytes() for a, b in zip(starts, ends, strict=True)] for c in (lists, names)]
            arrays = [pa.array(bucket[starts], pa.int64()), *(pa.array(c, pa.binary()) for c in columns)]
            yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "lists", "names"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held, waiting, most = None, [], 0, BUCKET_ENTRIES

        def ends() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            return lowest_and_highest(*(np.frombuffer(b"".join(part), dtype=np.int64) for part in zip(*held, strict=True)))

        def shared() -> pa.RecordBatch:
            lists, low, high = ends()
            more = low != high
            return pa.RecordBatch.from_arrays([pa.array(lists[more]), pa.array(low[more])], names=["list", "centre"])

        for batch in batches:
            for bucket, *packed in zip(*(batch.column(n) for n in ("bucket", "lists", "names")), strict=True):
                bucket, packed = bucket.as_py(), [part.as_py() for part in packed]
                if bucket != last and held:
                    yield shared()
                    held, waiting, most = [], 0, BUCKET_ENTRIES
                last = bucket
                held.append(packed)
                waiting += len(packed[0]) // 8
                if waiting > most:
                    lists, low, high = ends()
                    more = low != high
                    held = [[np.concatenate(pair).tobytes() for pair in ((lists, lists[more]), (low, high[more]))]]
                    waiting = len(held[0][0]) // 8
                    most = max(BUCKET_ENTRIES, 2 * waiting)
        if held:
            yield shared()

    texts = docs.where(F.col("doc_id").isNotNull()).select("text")
    packed = texts.mapInArrow(tidy(pack), "bucket bigint, lists binary, names binary")
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidy(meet), "list bigint, centre bigint")


def list_bits(lists: DataFrame) -> np.ndarray:
    """A bitmap of list names, of eight bits a list but 2^27 at most: beyond that it lets more through, and nothing is lost."""
    bits = 1 << min(MOST_BITS, max(10, (8 * lists.count()).bit_length()))
    at = F.col("list").bitwiseAND(F.lit(bits - 1))
    words = lists.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int")).alias("bit"))
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, dtype=np.int64)
    out[table.column("word").to_numpy()] = table.column("bits").to_numpy()
    return out


def gathered(docs: DataFrame, light: int, words: int, similarity, n_shingles: int) -> DataFrame:
    """(centre, set_id): each set with the smallest set of every list that it shares with another.

    The lists of a text are made twice instead of being stored. The second time, entries of lists that only one set has
    are dropped where they arise, so only shared lists meet in a join, which splits a list that many sets share.
    """
    shared = stored(shared_lists(docs, light, words, similarity, n_shingles), "lists")
    known = docs.sparkSession.sparkContext.broadcast(list_bits(shared))

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known.value
        for lists, names in task_sets(batches, light, words, similarity):
            at = lists & (len(bits) * 64 - 1)
            kept = (bits[at >> 6].view(np.uint64) >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            yield pa.RecordBatch.from_arrays([pa.array(lists[kept]), pa.array(names[kept])], names=["list", "set_id"])

    found = docs.where(F.col("doc_id").isNotNull()).select("text").mapInArrow(tidy(entries), "list bigint, set_id bigint")
    return found.join(shared, "list").where("centre != set_id").select("centre", "set_id").distinct()


def compare(rows: DataFrame, words: int = WORDS, similarity=SIMILARITY) -> DataFrame:
    """(kind, a, b): links that keep the components of every group, and sets that are not linked with the centre.

    ``rows`` has grp, set_id and packed, all rows of a group in one task, the centre first. ``kind`` is
    ``link``, or ``apart`` for (centre, set).
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, names, sets = None, [], []

        def finish() -> list[tuple[str, int, int]]:
            if len(sets) < 2:
                return []
            left, right = linked_pairs(sets, similarity)
            links = [("link", names[a], names[b]) for a, b in spanning(len(sets), left, right)]
            near = set(right[left == 0].tolist())
            return links + [("apart", names[0], names[i]) for i in range(1, len(sets)) if i not in near]

        def batch_of(out: list[tuple[str, int, int]]) -> pa.RecordBatch:
            kind, a, b = zip(*out, strict=True)
            arrays = [pa.array(kind), pa.array(a, pa.int64()), pa.array(b, pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["kind", "a", "b"])

        out: list[tuple[str, int, int]] = []
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            groups = batch.column("grp").to_pylist()
            for at, (wanted, raw) in enumerate(zip(batch.column("set_id").to_pylist(), batch.column("packed"), strict=True)):
                if groups[at] != group:
                    out += finish()
                    group, names, sets = groups[at], [], []
                members = shingles(unpack(raw.as_py()), words)
                # Another text under the same id, or the same set again
                if set_name(members) == wanted and wanted not in names[:1] and (not names or wanted != names[-1]):
                    names.append(wanted)
                    sets.append(members)
            if len(out) > 10_000:
                yield batch_of(out)
                out = []
        out += finish()
        if out:
            yield batch_of(out)

    return rows.select("grp", "set_id", "packed").mapInArrow(tidy(work), "kind string, a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """(set_id, component): smallest set reachable from each set that has a link.

    Minimum labels with pointer jumping; each round is a reliable checkpoint.
    """
    edges = cut_lineage(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut_lineage(edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "set_id"))
    while True:
        seen = edges.join(labels.withColumnRenamed("set_id", "b"), "b").groupBy("a").agg(F.min("label").alias("_near"))
        nearer = labels.join(seen.withColumnRenamed("a", "set_id"), "set_id").select(
            "set_id", "label", F.least("label", "_near").alias("_low")
        )
        root = labels.select(F.col("set_id").alias("_low"), F.col("label").alias("_root"))
        jumped = nearer.join(root, "_low", "left").select(
            "set_id", "label", F.least("_low", F.coalesce("_root", "_low")).alias("_new")
        )
        jumped = cut_lineage(jumped)
        changed = not jumped.where("_new != label").isEmpty()
        labels = jumped.select("set_id", F.col("_new").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity=SIMILARITY, chunk_sets: int = CHUNK_SETS) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id reachable by links, of every row.

    Rows with equal sets are linked; so are sets of which ``similarity`` (a fraction of whole numbers) of the
    union is common. Null and empty texts have no shingles and are linked with nothing: their component is
    their own id. Rows without doc_id link nothing and have no component. Repeated rows repeat; rows of
    one id with different texts belong together as far as both are linked. Other columns are not looked
    at; an empty table gives an empty one. Shingles and sets are compared as 64-bit hashes.
    """
    sets, nodes, found = linked_sets(docs, words, similarity, chunk_sets)
    return labelled(sets, nodes, found, docs.sparkSession)


def linked_sets(docs: DataFrame, words: int, similarity, chunk_sets: int = CHUNK_SETS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sets of all rows, the first document of each set, and the component of each set that has a link."""
    docs = docs.select("doc_id", "text")
    sets = stored(document_sets(docs, words), "sets")
    small = sets.where(F.col("n_shingles").between(1, MOST_LIGHT)).groupBy("n_shingles").agg(F.countDistinct("set_id").alias("n"))
    light = light_boundary({row["n_shingles"]: row["n"] for row in small.collect()}, similarity)
    named = sets.where(F.col("doc_id").isNotNull() & F.col("set_id").isNotNull())
    nodes = stored(named.groupBy("set_id").agg(F.min("doc_id").alias("first_doc")), "nodes")
    n_shingles = sets.agg(F.sum("n_shingles")).first()[0] or 0
    pairs = stored(gathered(docs, light, words, similarity, n_shingles), "pairs")

    # First each set meets one centre only. Groups that this puts into one component have no more to tell
    texts = stored(texts_of(docs, nodes, ends_of(pairs)), "texts")
    once = pairs.groupBy("set_id").agg(F.min("centre").alias("centre"))
    nearest = stored(compare(deliver(in_groups(dealt_out(once, chunk_sets)), texts), words, similarity), "nearest")
    early = stored(nearest.where("kind = 'link'").select("a", "b").distinct(), "early-links")
    pairs = stored(open_pairs(pairs, components(early)), "open-pairs")
    dealt = dealt_out(pairs, chunk_sets)
    found = stored(compare(deliver(in_groups(dealt), texts), words, similarity), "found")

    # Chunks of one group meet where a set is not linked with the centre
    apart = found.where("kind = 'apart'").select(F.col("a").alias("centre"), F.col("b").alias("set_id"))
    open_chunks = dealt.where("chunks > 1").join(apart, ["centre", "set_id"]).select("centre", "chunks", "chunk").distinct()
    meets = open_chunks.select(
        "centre", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    ).where("chunk != other")
    meets = meets.select("centre", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")).distinct()
    sides = meets.select("centre", F.struct("centre", "low", "high").alias("grp"), F.explode(F.array("low", "high")).alias("chunk"))
    across = sides.join(dealt, ["centre", "chunk"]).select("grp", F.lit(1).alias("place"), "set_id")
    links = early.unionByName(found.where("kind = 'link'").select("a", "b"))
    if not open_chunks.isEmpty():
        more = stored(compare(deliver(across, texts), words, similarity), "across")
        links = links.unionByName(more.where("kind = 'link'").select("a", "b"))
    return sets, nodes, components(links.distinct())


def ends_of(pairs: DataFrame) -> DataFrame:
    """(set_id): all sets of (centre, set_id) pairs."""
    both = pairs.select("set_id").unionByName(pairs.select(F.col("centre").alias("set_id")))
    return stored(both.distinct(), "wanted")


def dealt_out(pairs: DataFrame, chunk_sets: int) -> DataFrame:
    """(centre, chunks, chunk, set_id): a large group is dealt into chunks of about ``chunk_sets``."""
    sizes = stored(pairs.groupBy("centre").agg(F.ceil(F.count("*") / chunk_sets).cast("int").alias("chunks")), "group-sizes")
    chunk = F.pmod(F.xxhash64("set_id"), F.col("chunks")).cast("int").alias("chunk")
    return stored(pairs.join(sizes, "centre").select("centre", "chunks", chunk, "set_id"), "chunks")


def in_groups(dealt: DataFrame) -> DataFrame:
    """(grp, place, set_id): the sets of each chunk, and in front of them its centre."""
    group = F.struct("centre", "chunk").alias("grp")
    centres = dealt.select("centre", "chunk").distinct().select(group, F.lit(0).alias("place"), F.col("centre").alias("set_id"))
    return stored(dealt.select(group, F.lit(1).alias("place"), "set_id").unionByName(centres), "members")


def open_pairs(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Pairs of the groups whose sets are not all in one known component; a set without one is its own."""
    names = known.select("set_id", F.col("component").alias("_component"))
    sides = pairs.select("centre", "set_id").unionByName(pairs.select("centre", F.col("centre").alias("set_id")).distinct())
    component = F.coalesce("_component", "set_id")
    spans = sides.join(names, "set_id", "left").groupBy("centre").agg(F.min(component).alias("_low"), F.max(component).alias("_high"))
    return pairs.join(spans.where("_low != _high").select("centre"), "centre", "left_semi")


def joined(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows with texts joined to a table of short columns. If that is small, it goes to all tasks and no text is shuffled."""
    return rows.join(F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys, on)


def texts_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(set_id, packed): the compressed text of the first document of each wanted set."""
    firsts = nodes.join(wanted, "set_id").select("set_id", F.col("first_doc").alias("doc_id"))

    def work():
        pack = zstandard.ZstdCompressor().compress

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            return [pa.array([pack(raw.as_py()) for raw in text_bytes(batch)], pa.binary())]

        return step

    return map_batches(joined(docs, firsts, "doc_id"), ["text"], ["set_id"], "packed binary", work)


def deliver(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows of ``wanted`` (grp, place, set_id) with their text, the rows of a group together and in order."""
    return joined(texts, wanted, "set_id").repartition("grp").sortWithinPartitions("grp", "place", "set_id")


def labelled(sets: DataFrame, nodes: DataFrame, found: DataFrame, spark) -> DataFrame:
    """Component of each row, from the components of sets."""
    linked = nodes.join(found, "set_id")
    names = linked.groupBy("component").agg(F.min("first_doc").alias("_first"))
    by_set = nodes.join(linked.join(names, "component").select("set_id", "_first"), "set_id", "left")
    by_set = stored(by_set.select("set_id", F.coalesce("_first", "first_doc").alias("component_id")), "components")
    out = sets.join(by_set, "set_id", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"))


def keep_first(docs: DataFrame, words: int = WORDS, similarity=SIMILARITY) -> DataFrame:
    """One row of each group of near duplicates: of the smallest id, and of its texts the first in a fixed order.

    Unlike texts under one id are apart, as each set of an id is judged on its own. Rows without
    doc_id all stay, and so does every text without words, once for each id.
    """
    names = [f"_in_{name}" if name not in ("doc_id", "text") else name for name in docs.columns]
    rows = docs.toDF(*names)
    _, nodes, found = linked_sets(rows, words, similarity)
    groups = nodes.join(found, "set_id", "left").groupBy(F.coalesce("component", "set_id").alias("component"))
    first = groups.agg(F.min(F.struct("first_doc", "set_id")).alias("_first"))
    first = first.select(F.col("_first.first_doc").alias("doc_id"), F.col("_first.set_id").alias("_set"))

    def work():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [shingles(raw.as_py(), words) for raw in text_bytes(batch)]
            return [pa.array([set_name(members) if len(members) else None for members in found], pa.int64())]

        return step

    named = map_batches(rows.where(F.col("doc_id").isNotNull()), ["text"], names, "_set bigint", work)
    whole = F.struct("text", *(name for name in names if name != "text")).alias("_row")
    kept = named.join(first, ["doc_id", "_set"], "left_semi").groupBy("doc_id", "_set").agg(F.min(whole).alias("_row"))
    wordless = named.where(F.col("_set").isNull()).groupBy("doc_id", "text").agg(F.min(whole).alias("_row"))
    alone = kept.select("_row.*").unionByName(wordless.select("_row.*")).unionByName(rows.where(F.col("doc_id").isNull()))
    return alone.select(*names).toDF(*docs.columns)
