"""Contamination, sharding, search and near duplicates against plain versions of themselves."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from replyscope.llm import decontamination, jaccard_join, queries, sharding, top_k

from .conftest import ODD_TEXTS, SF_DIR


def plain_components(rows, words=3, part=90, whole=100):
    """Component of each row by comparing every pair of texts that shares a shingle."""
    sets = []
    for _, text in rows:
        tokens = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        grams = {tuple(tokens[i : i + words]) for i in range(len(tokens) - words + 1)} if len(tokens) >= words else {tuple(tokens)}
        sets.append(grams if tokens else set())
    label = [row[0] for row in rows]
    links = []
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and whole * common >= part * (len(sets[i]) + len(sets[j]) - common):
                links.append((i, j))
    changed = True
    while changed:
        changed = False
        for i, j in links:
            low = min(label[i], label[j])
            changed |= label[i] != label[j]
            label[i] = label[j] = low
    return sorted((row[0], len(grams), at) for row, grams, at in zip(rows, sets, label, strict=True))


def near_copies(seed, families, copies, low, high):
    """Families of texts with a few changed words, of ``low`` to ``high`` words."""
    draw, rows = random.Random(seed), []
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    for _ in range(families):
        base = [word() for _ in range(draw.randint(low, high))]
        for _ in range(copies):
            text = list(base)
            for _ in range(draw.choice([0, 0, 1, 1, 2, 4])):
                text[draw.randrange(len(text))] = word()
            if draw.random() < 0.3:
                text = text[draw.randint(0, 3) :]
            rows.append((len(rows), " ".join(text)))
    return rows


@pytest.mark.parametrize("similarity", [(80, 100), (90, 100)])
def test_linked_sets_share_a_list(similarity):
    """Also where only parts without shingles agree, and hardly any unlike sets share one."""
    draw, linked, met = np.random.default_rng(similarity[0]), 0, 0
    part, whole = similarity
    for _ in range(1500):
        one = np.unique(draw.integers(0, 2**63, int(draw.integers(1, 300))).astype(np.uint64))
        fresh = draw.integers(0, 2**63, int(draw.integers(0, len(one) // 8 + 1))).astype(np.uint64)
        other = np.unique(np.concatenate([one[: len(one) - int(draw.integers(0, len(one) // 8 + 1))], fresh]))
        common = len(np.intersect1d(one, other))
        if whole * common >= part * (len(one) + len(other) - common):
            linked += 1
            assert len(np.intersect1d(jaccard_join.list_keys(one, 5, similarity), jaccard_join.list_keys(other, 5, similarity)))
        unlike = np.unique(draw.integers(0, 2**63, len(one)).astype(np.uint64))
        met += len(one) > 20 and len(np.intersect1d(jaccard_join.list_keys(one, 5, similarity), jaccard_join.list_keys(unlike, 5, similarity))) > 0
    assert linked > 500 and met < 15


@pytest.mark.parametrize(("low", "high", "chunk"), [(1, 30, 1024), (15, 60, 1024), (60, 200, 4), (20, 120, 2)])
def test_components_equal_all_pairs(frame, low, high, chunk):
    rows = near_copies(low, 12, 14, low, high)
    found = jaccard_join.near_duplicates(frame(*rows), chunk_sets=chunk).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == plain_components(rows)


def test_components_of_the_documents(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = queries.op7_jaccard_join(spark, SF_DIR).collect()
    assert sorted(tuple(r) for r in found) == plain_components(rows)


@pytest.mark.parametrize("pieces", [1, 50])
def test_components_from_small_pieces(spark, monkeypatch, pieces):
    """Buckets that drop the inner entries of long lists again and again lose no link."""
    monkeypatch.setattr(jaccard_join, "BUCKET_ENTRIES", pieces)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    found = jaccard_join.near_duplicates(docs.repartition(7)).collect()
    assert sorted(tuple(r) for r in found) == plain_components(rows)


def test_sets_at_the_limit_share_a_list():
    """For every pair of sizes and every boundary: sets as different as links allow still meet in one list."""
    draw = np.random.default_rng(3)
    for light in (0, 8, 19, 30):
        for a in range(1, 90):
            for b in [size for size in jaccard_join.partner_sizes(a) if size >= a]:
                least = jaccard_join.least_overlap(a, b)
                if least > a:
                    continue
                pool = draw.integers(1, 1 << 62, a + b - least, dtype=np.uint64)
                left, right = np.unique(pool[:a]), np.unique(pool[a - least :])
                shared = np.intersect1d(jaccard_join.list_keys(left, light), jaccard_join.list_keys(right, light))
                assert len(shared), (light, a, b)


def test_no_two_words_with_one_hash():
    words = [bytes([a, b, c]) for a in range(97, 123) for b in range(97, 123) for c in range(33, 64)]
    assert len(set(jaccard_join.word_hashes(b" ".join(words)).tolist())) == len(words)
    assert (jaccard_join.word_hashes(b"AbC aBc") == jaccard_join.word_hashes(b"abc")[0]).all()
    far = b"x " * (jaccard_join.STRETCH) + b"tail end"
    assert (jaccard_join.word_hashes(far)[-2:] == jaccard_join.word_hashes(b"tail end")).all()


def test_one_of_each_group_stays(frame):
    rows = near_copies(9, 5, 6, 30, 60) + ODD_TEXTS
    kept = jaccard_join.keep_first(frame(*rows))
    named = [(i, t) for i, t in rows if i is not None]
    groups = {component for _, _, component in plain_components([(i * 100 + n, t) for n, (i, t) in enumerate(named)])}
    assert kept.columns == frame().columns and kept.where("doc_id is null").count() == 1
    assert kept.select("doc_id").distinct().count() <= len(groups)


def plain_contamination(text, items, window=13):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    hit, met = set(), set()
    for item, other in items:
        theirs = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in other or ""))
        n = min(window, len(theirs))
        grams = {tuple(theirs[i : i + n]) for i in range(len(theirs) - n + 1)} if n else set()
        for at in range(len(words) - n + 1 if n else 0):
            if tuple(words[at : at + n]) in grams:
                hit |= set(range(at, at + n))
                met.add(str(item))
    return len(words), len(hit), len(met), bool(hit) and 20 * len(hit) >= len(words)


@pytest.mark.parametrize("broadcasts", [True, False])
def test_contamination_equals_plain_search(spark, frame, monkeypatch, broadcasts):
    if not broadcasts:
        monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
        monkeypatch.setattr(decontamination, "BROADCAST_BYTES", 0)
    draw = random.Random(4)
    word = lambda: draw.choice(["Aa", "bb", "cc", "É", "9"])
    items = [(n, " ".join(word() for _ in range(draw.choice([1, 4, 12, 13, 20])))) for n in range(6)] + [(7, None), (8, "--")]
    rows = [(n, " ,".join(word() for _ in range(draw.randint(0, 90)))) for n in range(40)]
    rows += [(100 + n, f"{word()} {item[1]} {word()}") for n, item in enumerate(items)] + ODD_TEXTS
    items += [(20 + n, " ".join(f"own{n}" for _ in range(n))) for n in range(1, 15)]
    rows += [(200 + n, f"bb {text} own{n}") for n, text in items] + [(300, rows[45][1])] * 3
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontamination.find_contamination(frame(*rows), benchmark)
    results = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) for r in found.collect()]
    plain = [(i, *plain_contamination(t, items)) for i, t in rows]
    assert sorted(results, key=str) == sorted(plain, key=str)
    assert found.columns[:2] == ["doc_id", "text"] and found.select("score").first()[0] == "old"
    assert found.where("contaminated").count() > 5


def test_bitmaps_grow_and_have_a_bound():
    assert decontamination.bits_of({13: 1}) == {13: decontamination.LEAST_BITS}
    assert decontamination.bits_of({13: 100_000, 3: 4}) == {13: 1 << 22, 3: decontamination.LEAST_BITS}
    assert sum(decontamination.bits_of({n: 10**8 for n in range(1, 14)}).values()) <= decontamination.MOST_BITS


def test_contamination_moves_no_text_and_keeps_clashing_names(spark, frame):
    passage = " ".join(f"word{n}" for n in range(15))
    benchmark = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    odd = {name: F.lit(name) for name in ("_row", "_words", "_text", "key", "_key", "hit", "found", "_in0", "a.b", "N_HIT")}
    docs = frame((1, passage), (2, "clean"), (2, None), (1, passage)).withColumns(odd)
    found = decontamination.find_contamination(docs, benchmark)
    assert sorted((r["doc_id"], r["n_hit"], r["_row"], r["a.b"]) for r in found.collect()) == [(1, 15, "_row", "a.b")] * 2 + [(2, 0, "_row", "a.b")] * 2
    kept = decontamination.remove_documents(docs, benchmark)
    assert kept.columns == docs.columns and kept.where("N_HIT = 'N_HIT'").count() == 2
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan
    cut = decontamination.remove_spans(docs, benchmark)
    assert sorted(r["text"] or "" for r in cut.collect()) == ["", "", "", "clean"]


def test_decontamination_removes_documents_or_spans(spark, frame):
    passage = " ".join(f"word{n}" for n in range(15))
    docs = frame((1, f"Start, {passage}! The end."), (2, "clean text"), (3, None))
    benchmark = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    assert [r["doc_id"] for r in decontamination.remove_documents(docs, benchmark).orderBy("doc_id").collect()] == [2, 3]
    cut = decontamination.remove_spans(docs, benchmark).orderBy("doc_id").collect()
    assert [r["text"] for r in cut] == ["Start, The end.", "clean text", None] and cut[0]["n_words"] == "old"


def test_empty_benchmark_and_empty_documents(spark, frame):
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    found = decontamination.find_contamination(frame(*ODD_TEXTS), nothing).collect()
    assert len(found) == len(ODD_TEXTS) and not any(r["contaminated"] or r["n_hit"] for r in found)
    assert decontamination.find_contamination(frame(), nothing).count() == 0


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 3), (3, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
        index = sharding.hilbert_index(grid, bits)
        assert sorted(index.tolist()) == list(range(len(grid)))
        steps = np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_shards_hold_the_law(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = queries.op5_sharding(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    slots = defaultdict(list)
    for row in rows:
        text = (docs[row["doc_id"]]["text"] or "").encode()
        assert (row["size"], row["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
        slots[row["shard"]].append(row["slot"])
    assert sorted(slots) == list(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_shards_of_odd_tables(frame):
    for rows in (ODD_TEXTS, [(1, "a")], [], [(7, "same")] * 60):
        found = sharding.document_shards(frame(*rows), 24).collect()
        assert len(found) == len(rows) and {r["shard"] for r in found} == set(range(min(24, len(rows))))


def test_files_can_be_skipped(spark, tmp_path):
    docs = spark.range(4000).select("id", (F.col("id") % 64).alias("a"), F.floor(F.col("id") / 64).alias("b"))
    axes = [F.col("a") * 16, F.col("b") * 16]
    written = sharding.write_shards(docs, str(tmp_path / "shards"), axes, 16, ["id"])
    assert written.count() == 4000
    spread = written.groupBy("shard").agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b"), F.count("*").alias("n"))
    for row in spread.collect():
        assert row["a"] <= 32 and row["b"] <= 32 and row["n"] == 250


def plain_top_k(rows, k=5):
    good = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for q in sorted(i for i in good if i % 50 == 0):
        scores = [(-sum(a * b for a, b in zip(good[q], v, strict=False)), i) for i, v in good.items() if i != q]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


@pytest.mark.parametrize("held", [64, 1 << 19])
def test_pairs_of_sets_equal_plain_intersections(monkeypatch, held):
    monkeypatch.setattr(jaccard_join, "RANGE_SHINGLES", held)
    draw = np.random.default_rng(2)
    pool = np.unique(draw.integers(0, (1 << 64) - 1, 60, dtype=np.uint64, endpoint=True))
    sets = [np.sort(draw.choice(pool, n, replace=False)) for n in draw.integers(40, 60, 30)] + [pool[:0], pool, pool[:1]]
    left, right = jaccard_join.linked_pairs(sets, (80, 100))
    plain = {(i, j) for j, b in enumerate(sets) for i, a in enumerate(sets[:j]) if len(a) and 10 * len(np.intersect1d(a, b)) >= 8 * len(np.union1d(a, b))}
    assert set(zip(left.tolist(), right.tolist(), strict=True)) == plain and len(plain) > 20


@pytest.mark.parametrize("kind", ["clusters", "spread", "odd"])
def test_top_k_equals_all_pairs(spark, kind):
    draw = np.random.default_rng(1)
    if kind == "clusters":
        centres = draw.normal(size=(8, 16)) * 2
        rows = [(i, (centres[i % 8] + draw.normal(size=16) * 0.02).tolist()) for i in range(600)]
    elif kind == "spread":
        rows = [(i, draw.normal(size=24).tolist()) for i in range(400)] + [(i, [1.0] * 24) for i in range(400, 460)]
    else:
        rows = [(0, None), (50, [1.0, None]), (100, [float("nan"), 1.0]), (150, [float("inf")]), (200, [1.0, 2.0]), (201, [1.0]), (202, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = top_k.exact_top_k(df, df.where("vec_id % 50 = 0"), pivots=8, ring_rows=16).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in found] == plain_top_k(rows)


def test_search_leaves_out_rings_and_empty_tables(spark):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(8, 16)) * 2
    rows = [(i, (centres[i % 8] + draw.normal(size=16) * 0.01).tolist()) for i in range(800)]
    base = top_k.quantised(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), "vec_id", "embedding")
    points, width = top_k.pivots_of(base, 32)
    rings = top_k.ring_index(base, points, width, 10).groupBy("ring", "cell").agg(F.min("distance").alias("low"), F.max("distance").alias("high"))
    homes = base.where("id % 50 = 0").withColumn("query_id", F.col("id"))
    squares = F.aggregate("v", F.lit(0).cast("bigint"), lambda t, x: t + x * x)
    visits = top_k.open_rings(homes.withColumn("worst", squares - 2000), rings, points, width)
    assert visits.count() < 0.6 * rings.count() * homes.count()
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert top_k.exact_top_k(empty, empty).count() == 0
