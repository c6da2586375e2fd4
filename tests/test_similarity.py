import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from replyscope.operators import density, similarity, skew, tfidf


def make(spark, vectors, name="id"):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], f"{name} long, embedding array<float>")


def clustered(seed, n=600, dim=12, groups=8, copies=200):
    """Vectors in groups; a third of them are copies of one vector; one is zero."""
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(groups, dim))
    rows = centers[rng.integers(0, groups, n)] + 0.25 * rng.normal(size=(n, dim))
    rows[rng.choice(n, copies, replace=False)] = rows[0]
    rows[n // 2] = 0
    return rows.astype(np.float32)


def cosines(a, b):
    a, b = a.astype(np.float64), b.astype(np.float64)
    na, nb = np.linalg.norm(a, axis=1, keepdims=True), np.linalg.norm(b, axis=1, keepdims=True)
    a, b = np.divide(a, na, out=np.zeros_like(a), where=na > 0), np.divide(b, nb, out=np.zeros_like(b), where=nb > 0)
    return np.rint((a @ b.T) * 1e6).astype(int)


@pytest.mark.parametrize("block_rows, exclude", [(8192, False), (40, False), (40, True), (7, False)])
def test_knn_is_exact(spark, block_rows, exclude):
    corpus = clustered(5)
    queries = corpus[::4] if exclude else clustered(6, 150, copies=50)
    left = make(spark, queries, "query_id")
    if exclude:
        left = left.withColumn("query_id", F.col("query_id") * 4)
    found = similarity.knn(
        left, make(spark, corpus, "thread_id"), 5, exclude_same_id=exclude, corpus_block_rows=block_rows, query_block_rows=32
    ).collect()
    scaled = cosines(queries, corpus)
    for q in range(len(queries)):
        own = q * 4 if exclude else None
        order = sorted((-scaled[q, c], c) for c in range(len(corpus)) if c != own)[:5]
        rows = sorted((r["rank"], r.thread_id, round(r.similarity * 1e6)) for r in found if r.query_id == (own if exclude else q))
        assert [(c, -s) for s, c in order] == [(c, s) for _, c, s in rows]


def test_short_corpus_and_text_ids(spark):
    corpus = spark.createDataFrame([("b", [1.0, 0.0]), ("a", [1.0, 0.0])], "thread_id string, embedding array<float>")
    found = similarity.knn(make(spark, np.array([[2.0, 0.0]]), "query_id"), corpus, 5).orderBy("rank").collect()
    assert [(r.thread_id, r.similarity) for r in found] == [("a", 1.0), ("b", 1.0)]
    assert similarity.knn(make(spark, np.array([[2.0, 0.0]]), "query_id"), corpus.limit(0), 5).count() == 0


@pytest.mark.parametrize("block_rows, hot_rows", [(8192, None), (30, 50)])
def test_near_duplicates(spark, monkeypatch, block_rows, hot_rows):
    if hot_rows:
        monkeypatch.setattr(skew, "HOT_ROWS", hot_rows)
    vectors = clustered(7)
    rows = make(spark, vectors)
    found = {r.id: r.duplicate_of for r in similarity.near_duplicates(rows, "id", block_rows=block_rows).collect()}
    scaled = cosines(vectors, vectors)
    expected = {}
    for i in range(len(vectors)):
        lower = np.flatnonzero(scaled[i, :i] > 950000)
        if len(lower):
            expected[i] = int(lower[0])
    assert found == expected
    kept = {r.id for r in similarity.without_near_duplicates(rows, "id").select("id").collect()}
    assert kept == set(range(len(vectors))) - set(expected)


@pytest.mark.parametrize("block_rows", [8192, 25])
def test_density_clusters(spark, block_rows):
    vectors = clustered(8, 400, groups=10, copies=100)
    labels = {
        r.id: r.cluster
        for r in density.cluster_density(
            make(spark, vectors), "id", similarity=0.93, min_samples=4, min_cluster_size=6, block_rows=block_rows, query_block_rows=20
        ).collect()
    }
    close = cosines(vectors, vectors) >= 930000
    core = np.flatnonzero(close.sum(axis=1) >= 4)
    root = {int(i): int(i) for i in core}
    changed = True
    while changed:
        changed = False
        for i in core:
            low = min(root[int(j)] for j in core if close[i, j])
            if low < root[int(i)]:
                root[int(i)], changed = low, True
    members = {r: [i for i in root if root[i] == r] for r in set(root.values())}
    members = {r: m for r, m in members.items() if len(m) >= 6}
    noise = set(range(len(vectors))) - {i for m in members.values() for i in m}
    assert {i for i, c in labels.items() if c == -1} == noise
    assert sorted(tuple(sorted(m)) for m in members.values()) == sorted(
        tuple(sorted(i for i in labels if labels[i] == c)) for c in set(labels.values()) - {-1}
    )
    assert sorted(set(labels.values()) - {-1}) == list(range(len(members)))


def test_normalise(spark):
    rows = make(spark, np.array([[3.0, 4.0], [0.0, 0.0]])).select("id", similarity.normalise(F.col("embedding")).alias("v"))
    assert {r.id: [round(x, 6) for x in r.v] for r in rows.collect()} == {0: [0.6, 0.8], 1: [0.0, 0.0]}


def test_nearest_text_blocks(spark):
    rng = np.random.default_rng(9)
    words = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choice(words, rng.integers(0, 9))) for _ in range(120)]
    docs = spark.createDataFrame([(f"d{i:03d}", t) for i, t in enumerate(texts)], "thread_id string, text string")
    vocabulary = tfidf.fit_vocabulary(docs, "thread_id", "text", max_features=50)
    rows = tfidf.sparse_texts(docs, "thread_id", "text", vocabulary)
    dense = {r.thread_id: dict(zip(r.terms, r.weights)) for r in rows.collect()}
    asked = rows.withColumnRenamed("thread_id", "q")
    found = tfidf.nearest_text(asked, rows, "q", "thread_id", width=50, corpus_block_rows=16, query_part_rows=16).collect()
    assert len(found) == 120
    for row in found:
        scores = {d: round(sum(w * other.get(t, 0.0) for t, w in dense[row.q].items()), 6) for d, other in dense.items()}
        top = max(scores.values())
        assert row.similarity == pytest.approx(top, abs=2e-6)
        assert scores[row.thread_id] == pytest.approx(top, abs=2e-6)


def test_template_without_index(spark):
    rows = spark.createDataFrame([("1", "x")], "q string, text string")
    assert tfidf.template_replies(rows, "q", "text", None, None).first().draft_reply.startswith("Please DM us")


@pytest.mark.parametrize(("words", "long"), [(40, 12), (300, 40), (8, 3)])
def test_inverted_lists_find_what_all_products_find(words, long):
    """Frequent terms, ties, texts without terms: lists left over by the bound change no result."""
    draw = np.random.default_rng(words)
    dense = np.zeros((400, words))
    for row in dense:
        # Low numbers are frequent
        at = np.unique((draw.random(draw.integers(0, long + 1)) ** 3 * words).astype(int))
        row[at] = draw.integers(1, 4, len(at))
    dense[200:220] = dense[100:120]
    norms = np.linalg.norm(dense, axis=1, keepdims=True)
    dense = np.divide(dense, norms, out=np.zeros_like(dense), where=norms > 0)
    texts, asked = dense[:300], dense[250:]
    filled = [np.flatnonzero(row) for row in texts]
    lists = tfidf.Lists.of(pa.array(filled, pa.list_(pa.int32())), np.concatenate([row[at] for row, at in zip(texts, filled)]), words)
    totals = np.zeros(300)
    for query in asked:
        at = np.flatnonzero(query)
        scaled = np.rint(texts @ query * similarity.SCALE)
        assert lists.winner(at, query[at], totals) == (scaled.argmax(), scaled.max() / similarity.SCALE)
        assert not totals.any()


def test_rare_terms_spare_the_long_lists():
    """The long list comes last and is not added up: only its texts that can still win are looked up."""
    rows = [[0, 1 + i % 5] for i in range(1000)]
    weights = np.tile([0.1, 0.995], 1000)
    lists = tfidf.Lists.of(pa.array(rows, pa.list_(pa.int32())), weights, 6)

    class Counted(np.ndarray):
        reads = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Counted.reads += key.stop - key.start
            return super().__getitem__(key)

    counted = tfidf.Lists(lists.starts, lists.texts, lists.weights.view(Counted), lists.largest, 1000)
    place, found = counted.winner(np.array([0, 3]), np.array([0.1, 0.995]), np.zeros(1000))
    assert (place, found) == (2, pytest.approx(1.000025, abs=1e-6)) and Counted.reads == 200 + 2 * 1000 - 1000


def test_corpus_is_copied_once_for_very_many_queries(spark):
    vectors = np.random.default_rng(4).normal(size=(900, 6))
    corpus = make(spark, vectors).select(F.col("id").alias("_match"), F.col("embedding").alias("_vector"))
    cells = similarity.build_cells(corpus, "_match", "_vector", 1, 64)
    assert similarity.part_count(200_000, int(cells.blocks.sum()), 8) == 1
    assert similarity.corpus_rows(corpus, "_match", "_vector", cells, 1).count() == 900
    # Few blocks on many cores, and more queries than a task lets past
    assert similarity.part_count(10_000, 1, 8) == 8 and similarity.part_count(similarity.QUERY_PART_ROWS * 3, 100, 8) == 3
    assert similarity.corpus_rows(corpus, "_match", "_vector", cells, 3).count() == 2700


@pytest.mark.parametrize("copies", [0, 3000])
def test_single_precision_only_leaves_out(copies):
    rng = np.random.default_rng(9)
    right = rng.normal(size=(4000, 16))
    right[rng.choice(4000, copies, replace=False)] = right[5]
    right[17] = 0
    right /= np.maximum(np.linalg.norm(right, axis=1, keepdims=True), 1e-300)
    left, slim = right[::40], similarity.narrow(right).T.copy()
    scaled = similarity.scaled_similarity(left, right)
    rows, columns, values = similarity.nearest_rows(left, right, slim, 6)
    for row in range(len(left)):
        order = np.lexsort((np.arange(4000), -scaled[row]))[:6]
        assert columns[rows == row].tolist() == order.tolist() and values[rows == row].tolist() == scaled[row][order].tolist()
    limit = int(np.sort(scaled.ravel())[-900])
    assert (similarity.close_pairs(left, right, slim, limit) == (scaled >= limit)).all()


def test_few_links_give_the_components_of_all_cells(monkeypatch):
    adjacent = np.random.default_rng(2).random((60, 90)) < 0.012
    listed = density.block_components(adjacent)
    monkeypatch.setattr(density, "SPARSE", adjacent.size + 1)
    for ours, theirs in zip(listed, density.block_components(adjacent), strict=True):
        assert (ours == theirs).all()


def test_each_block_is_a_task(spark):
    """Blocks are few bytes and much work, so they must not be put together by their bytes."""
    vectors = make(spark, np.random.default_rng(6).normal(size=(400, 6))).select(F.col("id").alias("_match"), F.col("embedding").alias("_vector"))
    queries = vectors.withColumnRenamed("_match", "_query")
    cells = similarity.Cells(None, np.zeros(1), np.zeros(1), np.array([400]), np.zeros((1, 1)), 50)
    count = lambda asked, block: pa.table({"n": pa.array([block.num_rows])})
    found = similarity.block_tasks(queries, vectors, "_query", "_match", "_vector", cells, 2, None, 1, lambda rows: rows, count, "n long")
    per_task = found.groupBy(F.spark_partition_id().alias("task")).agg(F.countDistinct("n").alias("blocks")).collect()
    assert len(per_task) == 16 and all(row.blocks == 1 for row in per_task)


def counted_products(monkeypatch):
    """Cells of the products that are computed in double precision, as the list of their sizes."""
    cells, exact = [], similarity.scaled_similarity
    monkeypatch.setattr(similarity, "scaled_similarity", lambda left, right: cells.append(len(left) * len(right)) or exact(left, right))
    return cells


def test_one_query_with_many_ties_leaves_the_others_alone(monkeypatch):
    """A text without known words ties with the whole corpus; only its own products are computed again."""
    rng = np.random.default_rng(3)
    right = rng.normal(size=(4500, 16))
    right /= np.linalg.norm(right, axis=1, keepdims=True)
    left = right[:64].copy()
    left[9] = 0
    scaled = similarity.scaled_similarity(left, right)
    cells = counted_products(monkeypatch)
    rows, columns, values = similarity.nearest_rows(left, right, similarity.narrow(right).T.copy(), 6)
    for row in range(len(left)):
        order = np.lexsort((np.arange(len(right)), -scaled[row]))[:6]
        assert columns[rows == row].tolist() == order.tolist() and values[rows == row].tolist() == scaled[row][order].tolist()
    assert sum(cells) <= len(right)


@pytest.mark.parametrize(("width", "k"), [(1, 6), (50, 6), (1300, 40), (2100, 1), (2100, 1100), (70, 100)])
def test_tiles_give_the_best_of_all_products(width, k):
    """Narrow and cut-off tiles, more results than a tile has rows, better rows in later tiles, equal ones in several."""
    rng = np.random.default_rng(width + k)
    right = np.sort(rng.integers(0, 5, size=(width, 3)), axis=0).astype(float)
    right = np.divide(right, norms := np.linalg.norm(right, axis=1, keepdims=True), out=np.zeros_like(right), where=norms > 0)
    left = right[:: max(1, width // 30)]
    scaled = similarity.scaled_similarity(left, right)
    rows, columns, values = similarity.nearest_rows(left, right, similarity.narrow(right).T.copy(), k)
    for row in range(len(left)):
        order = np.lexsort((np.arange(width), -scaled[row]))[:k]
        assert columns[rows == row].tolist() == order.tolist() and values[rows == row].tolist() == scaled[row][order].tolist()


def test_vectors_that_are_not_finite_change_no_other_result(spark):
    """They count as zero vectors, as those with missing numbers do."""
    vectors = np.random.default_rng(8).normal(size=(60, 4))
    vectors[7, 2], vectors[30, 0] = np.inf, np.nan
    found = similarity.knn(make(spark, vectors, "query_id"), make(spark, vectors, "thread_id"), 3).collect()
    vectors[[7, 30]] = 0
    scaled = cosines(vectors.astype(np.float32), vectors.astype(np.float32))
    for q in range(len(vectors)):
        expected = sorted((-scaled[q, c], c) for c in range(len(vectors)))[:3]
        rows = sorted((r["rank"], r.thread_id) for r in found if r.query_id == q)
        assert [c for _, c in expected] == [c for _, c in rows]
