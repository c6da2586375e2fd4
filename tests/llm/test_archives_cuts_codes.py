"""Web archives, fill-in-the-middle cuts and vector codes against plain versions of themselves."""

import hashlib
import os
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from replyscope.llm import fill_middle, queries, vector_codes, warc

from .conftest import ODD_TEXTS, SF_DIR

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def sql_rows(name, **tables):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        duck.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    cursor = duck.execute(queries.ORACLES[name])
    return [c[0] for c in cursor.description], sorted(map(repr, cursor.fetchall()))


@pytest.mark.parametrize("name", ["op11_warc", "op12_fill_middle", "op13_vector_codes"])
def test_queries_equal_sql(spark, name):
    columns, expected = sql_rows(name)
    rows = queries.QUERIES[name](spark, SF_DIR).select(*columns).collect()
    assert sorted(repr(tuple(r)) for r in rows) == expected


# Fill in the middle


def plain_cut(key, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def random_text(draw, words):
    pieces = []
    for _ in range(words):
        pieces.append("".join(draw.choice("ab<PSM>é語\U0001f600 \x1c") for _ in range(draw.choice([1, 3, 8, 400]))))
        pieces.append("".join(draw.choice(" \t\n\x0b\x0c\r") for _ in range(draw.choice([1, 1, 2, 300]))))
    draw.random() < 0.5 and pieces.insert(0, "  \n")
    return "".join(pieces[: draw.randint(0, len(pieces))])


@pytest.mark.parametrize("limit", [1 << 20, 700, 0])
def test_cuts_of_random_texts_equal_plain_version(limit, monkeypatch):
    monkeypatch.setattr(fill_middle, "LONGEST_CHUNK", 300)
    draw = random.Random(limit)
    cache = fill_middle.ChunkCache(limit)
    for key in range(400):
        text = random_text(draw, draw.choice([0, 1, 5, 40]))
        n, form, prefix, middle, output = fill_middle.transformed(text.encode(), key, cache)
        assert (n, form, prefix, middle, output.decode()) == plain_cut(key, text)
        assert fill_middle.restored(output, form).decode() == text
        assert cache.held <= max(limit, 300)


def test_every_unit_is_found_and_chunks_are_whole_characters(monkeypatch):
    monkeypatch.setattr(fill_middle, "LONGEST_CHUNK", 50)
    draw = random.Random(3)
    for _ in range(60):
        text = random_text(draw, 6)
        raw, units = text.encode(), UNIT.findall(text)
        found = fill_middle.Units(raw, fill_middle.ChunkCache())
        assert found.count == len(units) and found.chars == len(text)
        for unit in range(len(units) + 1):
            head = "".join(units[:unit])
            assert found.end_of(unit) == (len(head.encode()), len(head))
        ends = fill_middle.chunk_ends(raw)
        assert ends == sorted(set(ends)) and (ends[-1:] or [0]) == [len(raw)]
        for start, end in zip([0, *ends], ends):
            raw[start:end].decode()
            assert end - start <= 50 + 3


def test_shared_passages_fall_into_shared_chunks():
    draw = random.Random(8)
    words = lambda n: " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(n)).encode()
    passage, cache = words(2000), fill_middle.ChunkCache()
    fill_middle.Units(words(50) + passage + words(30), cache)
    missed = cache.misses
    fill_middle.Units(words(91) + passage + words(77), cache)
    # Of the second text only the chunks outside the passage and at its edges are new
    assert cache.misses - missed < 15 < cache.hits


def test_chunks_with_one_hash_are_told_apart_by_content():
    cache = fill_middle.ChunkCache(digest=lambda chunk: 7)
    for chunk in (b"one two", b"three", b"one two", b" four", b"one two"):
        assert cache.summary(chunk) == fill_middle.summarise(chunk)
    assert cache.hits == 2


def test_cuts_of_odd_texts_and_clashing_columns(spark, frame):
    docs = frame(*ODD_TEXTS, (9, "marks <M> inside"), (10, " \n ")).withColumn("FORM", F.lit("old")).withColumn("restored", F.lit("old"))
    done = fill_middle.fill_in_middle(docs)
    assert done.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "n_words", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    rows = done.collect()
    assert len(rows) == docs.count()
    for row in rows:
        expected = plain_cut(row["doc_id"], row["text"])
        assert (row["n"], row["form"], row["prefix_chars"], row["middle_chars"], row["output"].decode()) == expected
        assert row["restored"].decode() == (row["text"] or "")
    assert fill_middle.fill_in_middle(docs.limit(0)).count() == 0


# Vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(id, code, error, label_error) by plain k-means in Python's integers, and the codebooks."""
    kept = [(i, [int(np.floor(float(x) * scale)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = -(-max((len(v) for _, v, _ in kept), default=0) // parts)
    cut = lambda v: [(v + [0] * (width * parts - len(v)))[p * width : (p + 1) * width] for p in range(parts)]
    pieces = [cut(v) for _, v, _ in kept]
    first = {}
    for (i, v, _), piece in zip(kept, pieces):
        if i is not None and (i not in first or v < first[i][0]):
            first[i] = (v, piece)
    books = [[first[i][1][p] for i in sorted(first)[:entries]] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda p, x: min(range(len(books[p])), key=lambda e: (gap(x, books[p][e]), e))
    for _ in range(rounds):
        for p in range(parts):
            own = [nearest(p, piece[p]) for piece in pieces]
            for e in range(len(books[p])):
                mine = [piece[p] for piece, o in zip(pieces, own) if o == e]
                if mine:
                    books[p] = [*books[p][:e], [sum(c) // len(mine) for c in zip(*mine)], *books[p][e + 1 :]]
                    # Own entries were taken before any entry of this part moved
    out, by_label = [], {}
    for (i, _, label), piece in zip(kept, pieces):
        code = [nearest(p, piece[p]) for p in range(parts)]
        error = sum(gap(piece[p], books[p][code[p]]) for p in range(parts))
        out.append((i, "".join(f"{e:02x}" for e in code), error, label))
        by_label[label] = by_label.get(label, 0) + error
    return sorted([(repr(i), c, e, by_label[label]) for i, c, e, label in out]), books


def vectors(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    return frame.withColumns({"entry": F.lit("old"), "_label": F.lit(1), "V": F.lit(2)})


def check_codes(spark, rows, **options):
    codes, books = vector_codes.compress(vectors(spark, rows), **options)
    expected, plain = plain_codes(rows, **options)
    assert sorted((repr(r["vec_id"]), r["code"], r["error"], r["label_error"]) for r in codes.collect()) == expected
    assert books.latest.tolist() == plain
    return codes, books


def test_codes_equal_plain_rounds(spark):
    draw = np.random.default_rng(5)
    centres = draw.normal(size=(9, 16))
    rows = [(int(i), [float(np.float32(x)) for x in centres[draw.integers(9)] + 0.3 * draw.normal(size=16)], int(draw.integers(3)) if i % 7 else None) for i in draw.permutation(300)]
    codes, books = check_codes(spark, rows)
    near = vector_codes.decoded(codes, books).join(vectors(spark, rows).select("vec_id", "embedding"), "vec_id")
    off = F.aggregate(F.zip_with("embedding", "approximation", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    for row in near.select("error", off.alias("off")).collect():
        assert row["off"] * 4096**2 == pytest.approx(row["error"], rel=0.05)


def test_codes_of_ties_repeats_nulls_and_few_ids(spark):
    same = [(i, [0.0, 0.5] * 4, 1) for i in range(40)] + [(3, [0.0, 0.5] * 4, 1), (3, [-1.0, 0.5] * 4, None)]
    check_codes(spark, same)
    nan, inf = float("nan"), float("inf")
    odd = [(1, None, 1), (2, [0.1] * 8, None), (None, [0.2] * 8, 2), (4, [nan] * 8, 1), (5, [inf] * 8, 1), (6, [None, *[0.1] * 7], 1), (7, [0.3, -0.3], 2), (8, [], None)]
    check_codes(spark, odd)
    check_codes(spark, [(2, [0.25] * 11, None)])
    check_codes(spark, odd, entries=1, rounds=2)
    for rows in ([], [(None, [1.0] * 8, 1)], [(1, None, 1)]):
        codes, books = vector_codes.compress(vectors(spark, rows))
        assert codes.count() == 0 and codes.columns == ["vec_id", "label", "code", "error", "label_error"] and books.latest.size == 0
    with pytest.raises(Exception, match="too large"):
        vector_codes.compress(vectors(spark, [(1, [1e30] * 8, 1)]))


def test_labels_are_joined_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "BROADCAST_LABELS", 0)
    monkeypatch.setattr(vector_codes, "HOT_LABEL_ROWS", 20)
    draw = np.random.default_rng(1)
    check_codes(spark, [(i, draw.normal(size=8).astype(np.float32).tolist(), None if i % 3 == 0 else 1 if i < 40 else i) for i in range(80)], rounds=1)


def test_net_displacement_spares_rescans_and_keeps_assignments():
    """Entries wander to and fro: bounds by net displacement stay exact and rescan less than added-up moves."""
    draw = np.random.default_rng(2)
    base = draw.integers(-4000, 4000, size=(2, 12, 4))
    rows = base[np.arange(2), draw.integers(12, size=(3000, 2))] + draw.integers(-500, 500, size=(3000, 2, 4))
    books, bounds = vector_codes.Codebooks([base]), vector_codes.Bounds.blank(3000, 2)
    summed = vector_codes.Bounds.blank(3000, 2)
    net = drift = 0
    for turn in range(12):
        _, again = vector_codes.assign(rows, bounds, books)
        net += again if turn else 0
        for part in range(2):
            expected = vector_codes.squares(rows[:, part], books.latest[part]).argmin(axis=1)
            assert (bounds.entry[:, part] == expected).all()
        # The same bounds, moved by every step instead of by the way from start to end
        last = vector_codes.Codebooks(books.history[-2:])
        summed.near_round[:] = summed.far_round[:] = 0
        gone, others = last.displacement()
        place = np.arange(2)
        own, far = gone[0][place, summed.entry], others[0][place, summed.entry]
        _, again = vector_codes.assign(rows, summed, last)
        drift += again if turn else 0
        stale = summed.near_round == 0 if turn else np.zeros_like(summed.near_round, dtype=bool)
        summed.near[stale] += own[stale]
        stale = summed.far_round == 0 if turn else stale
        summed.far[stale] -= far[stale]
        books = vector_codes.Codebooks([*books.history, base + draw.integers(-300, 300, size=base.shape)])
    assert 0 < net < 0.8 * drift


def test_large_components_stay_exact():
    far = np.array([[(1 << 24) - 1, -(1 << 24)]]), np.array([[-(1 << 24), 1 << 24], [(1 << 24) - 2, -(1 << 24)]])
    assert vector_codes.squares(*far).tolist() == [[int(sum((int(a) - int(b)) ** 2 for a, b in zip(far[0][0], c))) for c in far[1]]]


# Web archives


def plain_records(raw):
    """(offset, type, payload) by walking from record to record."""
    out, at = [], 0
    while raw.startswith(b"WARC/1.1\r\n", at) and (end := raw.find(b"\r\n\r\n", at)) >= 0:
        fields = dict(line.split(": ", 1) for line in raw[at:end].decode().split("\r\n")[1:])
        if "Content-Length" not in fields:
            break
        stop = end + 4 + int(fields["Content-Length"])
        if stop + 4 > len(raw):
            break
        out.append((at, fields["WARC-Type"], raw[end + 4 : stop]))
        at = stop + 4
    return out


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "700b", "spark.sql.files.openCostInBytes": "1b"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def trap(inner):
    """A payload that looks like a record, with a length of its own."""
    return f"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: {inner}\r\n\r\nabc\r\n\r\n"


PAGES = [
    (1, "http://a/1", "<p>one</p>"),
    (2, None, trap(3)),
    (3, "http://a/3\r\nContent-Length: 9", "\r\n\r\n" + trap(3) * 4 + "\r\n"),
    (4, "http://a/4", "WARC/1.1\r\n" * 80),
    (5, "http://a/5", None),
    (6, "http://a/6", ""),
    (7, "http://a/7", "x" * 5000),
    (8, "http://a/8", "x" * 5000),
    (8, "http://a/8", "x" * 5000),
    (None, "http://a/n", "x" * 5000),
    (9, "http://a/9", "é\n" * 900 + trap(100000) + "\n\r\n" * 50),
    (10, "http://a/10", "z" * 999),
    (11, "http://a/11", "z" * 999),
    (None, "http://a/m", "y" * 1000),
    (12, "http://a/12", "WARC/1.1\r\nContent-Length: 5" + "\r\n" * 200 + trap(7)),
]


def page_frame(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"_payload": F.lit("old"), "block": F.lit(1)})


def test_archives_are_read_as_by_walking_from_the_start(spark, small_blocks, tmp_path):
    pages = page_frame(spark, PAGES + [(100 + i, f"http://b/{i}", f"{i} " * (i * 7 % 900) + (trap(i) if i % 3 else "\r\n")) for i in range(40)])
    warc.write_archives(warc.as_records(pages).coalesce(1), f"{tmp_path}/w")
    files = [f"{tmp_path}/w/{n}" for n in os.listdir(tmp_path / "w") if n.startswith("part-")]
    expected = [r for f in files for r in plain_records(open(f, "rb").read())]
    assert len(expected) == len(PAGES) + 40
    rows = warc.read_archives(spark, f"{tmp_path}/w").collect()
    assert sorted((r["record_offset"], r["record_type"], bytes(r["payload"])) for r in rows) == expected
    assert warc.lines_of(spark, f"{tmp_path}/w").select("block").distinct().count() > 50


@pytest.mark.parametrize("bytes_", [137, 1500])
def test_blocks_may_end_anywhere(spark, small_blocks, tmp_path, bytes_):
    spark.conf.set("spark.sql.files.maxPartitionBytes", f"{bytes_}b")
    warc.write_archives(warc.as_records(page_frame(spark, PAGES[:6] + PAGES[-1:])).coalesce(1), f"{tmp_path}/w")
    raw = b"".join(open(tmp_path / "w" / n, "rb").read() for n in os.listdir(tmp_path / "w") if n.startswith("part-"))
    rows = warc.read_archives(spark, f"{tmp_path}/w").collect()
    assert sorted((r["record_offset"], r["record_type"], bytes(r["payload"])) for r in rows) == plain_records(raw)


def test_damaged_archives_end_at_the_damage(spark, small_blocks, tmp_path):
    whole = lambda n: f"WARC/1.1\r\nWARC-Type: a\r\nContent-Length: {n}\r\n\r\n".encode() + b"p" * n + b"\r\n\r\n"
    bad = {
        "cut": whole(10) + whole(2000)[:-3],
        "garbage": whole(1000) + b"not a record\r\n\r\n" + whole(5) * 100,
        "no_length": whole(900) + b"WARC/1.1\r\nWARC-Type: a\r\n\r\n" + whole(5) * 3,
        "too_long": whole(1) + b"WARC/1.1\r\nWARC-Type: a\r\nContent-Length: 99999999999\r\n\r\n" + whole(5) * 300,
        "short": whole(3) + b"WARC/1.1\r\nWARC-Type: a\r\nContent-Length: 2\r\n\r\nppppp\r\n\r\n" + whole(5) * 3,
        "late": b"\r\n" + whole(3),
        "nothing": b"",
    }
    (tmp_path / "w").mkdir()
    for name, raw in bad.items():
        (tmp_path / "w" / name).write_bytes(raw)
    rows = warc.read_archives(spark, f"{tmp_path}/w").collect()
    found = {name: sorted((r["record_offset"], bytes(r["payload"])) for r in rows if r["file"].endswith(f"/{name}")) for name in bad}
    for name, raw in bad.items():
        assert found[name] == [(at, payload) for at, _, payload in plain_records(raw)], name


def test_pages_come_back_and_copies_are_revisits(spark, monkeypatch):
    def plain(rows):
        out = []
        for i, _, html in rows:
            raw = (html or "").encode()
            ids = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
            again = len(raw) >= 1000 and ids and i != max(ids)
            out.append((repr(i), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", max(ids) if again else None))
        return sorted(out, key=repr)

    for most in (warc.BROADCAST_ROWS, 0):
        monkeypatch.setattr(warc, "BROADCAST_ROWS", most)
        monkeypatch.setattr(warc, "HOT_ROWS", 3)
        rows = warc.archived_pages(page_frame(spark, PAGES)).collect()
        assert sorted([(repr(r["page_id"]), *list(r)[1:]) for r in rows], key=repr) == plain(PAGES)
    assert warc.archived_pages(page_frame(spark, PAGES).limit(0)).count() == 0


def test_many_archives_are_read_in_turns(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "MOST_BLOCKS", 2)
    warc.write_archives(warc.as_records(page_frame(spark, PAGES)).repartition(5), f"{tmp_path}/w")
    rows = warc.read_archives(spark, f"{tmp_path}/w")
    assert rows.count() == len(PAGES) and rows.select("file").distinct().count() == 5


def test_a_wrong_digest_is_an_error(spark, tmp_path):
    text = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Payload-Digest: sha1:00\r\nContent-Length: 1\r\n\r\np"
    warc.write_archives(spark.createDataFrame([(text,)], "record string"), f"{tmp_path}/w")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.with_payload_facts(warc.read_archives(spark, f"{tmp_path}/w")).collect()
