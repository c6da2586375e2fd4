"""Licences, tokens, secrets and languages against plain versions of themselves."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from urllib.parse import quote

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from replyscope.llm import byte_bpe, fixed_values, language_id, license_scan, queries, secret_scan
from replyscope.llm import rows as rows_module

from .conftest import ODD_TEXTS, SF_DIR

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(fixed_values.UPPER, fixed_values.LOWER)


def plain_words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain_base(text):
    words, found = plain_words(text), []
    for label, phrase in fixed_values.BASE_PHRASES:
        parts = phrase.split()
        found += [(at, label) for at in range(len(words)) if words[at : at + len(parts)] == parts]
    return words, found


def documents(spark):
    return {row["doc_id"]: row for row in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}


def test_licence_base_equals_plain_search(spark):
    texts = documents(spark)
    rows = queries.op1_license_scans(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for row in rows:
        words, found = plain_base(texts[row["doc_id"]]["text"])
        starts = [at for at, _ in found]
        assert (row["n_words"], row["n_base"]) == (len(words), len(found))
        assert (row["first_word"], row["last_word"]) == (min(starts, default=None), max(starts, default=None))
        assert row["base_labels"] == ",".join(sorted({label for _, label in found}))
        assert set(row["base_labels"].split(",")) <= set(row["labels"].split(",")) | {""}
        assert 0 <= row["score"] <= 1


def test_matching_statistics_equal_plain_search():
    """Random texts over few words: every whole phrase and every longest match is found."""
    draw = random.Random(5)
    for _ in range(150):
        make = lambda n: [draw.choice("abc") for _ in range(n)]
        phrases = [("p", " ".join(make(draw.randint(1, 4)))) for _ in range(3)]
        templates = [("t", " ".join(make(draw.randint(3, 9)))) for _ in range(3)]
        automaton = license_scan.LicenceAutomaton(phrases, templates, 2, 0.8, 2)
        text = make(30)
        found, matches = automaton.stream([word.encode() for word in text])
        plain = [
            (n, at) for n, (_, p) in enumerate(phrases) for at in range(len(text)) if text[at : at + len(p.split())] == p.split()
        ]
        assert sorted(found) == sorted(plain)
        pieces = [p.split() for _, p in phrases + templates]
        for end, _, length in matches:
            inside = lambda part: any(p[i : i + len(part)] == part for p in pieces for i in range(len(p)))
            assert inside(text[end - length : end])
            assert end - length == 0 or not inside(text[end - length - 1 : end])


def test_licence_templates_in_part(frame):
    notice = fixed_values.LICENCE_TEMPLATES[1][1]
    changed = notice.replace("You may obtain a copy of the License at ", "")
    rows = license_scan.scan_licences(frame((1, "Intro. " + changed), (2, "under the terms of business"))).collect()
    assert rows[0]["labels"] == "apache-2.0" and 0.75 <= rows[0]["score"] < 1 and rows[0]["spans"][0]["first_word"] == 1
    assert rows[1]["labels"] == "" and rows[1]["score"] == 0 and rows[1]["source"] == "s"


def test_tokens_equal_tiktoken(spark):
    ranks = byte_bpe.read_ranks(RANKS)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = documents(spark)
    for row in queries.op3_byte_bpe(spark, SF_DIR).collect():
        text = texts[row["doc_id"]]["text"]
        ids = plain.encode_ordinary(text)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("at_spaces", [True, False])
def test_tokens_of_odd_strings(at_spaces):
    ranks = byte_bpe.read_ranks(RANKS)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoder = byte_bpe.PieceEncoder(byte_bpe.model_proto(ranks), ranks, public_tokenizers.PATTERN, at_spaces, memory=50)
    parts = [" ", "  ", "\n", "\t", "a", "don't", "\u3000", "\u200b", "1", "²", "é", "。", "😀", "'s", "\x1c", "\x85", "\xa0", "\x00"]
    parts += ["<unk>", "</s>", "▁", "B", "\u0301", "٣", ".", ",", "ā", "<|endoftext|>"]
    draw = random.Random(2)
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 9))) for _ in range(4000)] + ["a" * 3000, " " * 500 + "x"]
    for text, packed in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(packed, np.int32).tolist() == plain.encode_ordinary(text), repr(text)


def plain_secrets(text):
    out = []
    for number, (kind, pattern, group, least) in enumerate(fixed_values.SECRET_PATTERNS):
        flags = re.ASCII | (re.IGNORECASE if kind == "assign" else 0)
        out += [(m.start(), number, kind, m.end()) for m in re.finditer(pattern, text or "", flags) if len(m.group(group)) >= least]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(out)]


def test_secret_base_equals_plain_search(spark):
    texts = documents(spark)
    for row in queries.op8_secret_scans(spark, SF_DIR).collect():
        spans = plain_secrets(texts[row["doc_id"]]["text"])
        assert row["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert set(spans) <= set(row["spans"].split(","))
        assert row["n_assign"] + row["n_access"] + row["n_hex"] == len(spans)


def test_secrets_of_odd_texts(frame):
    texts = [
        'é Password:  "abcdefghijkl" AKIA' + "Z" * 14,
        "ſecret=abcdefghijklm token==abcdefghijkl",
        "deadbeefdeadbeef",
        "f" * 15,
        "ab12" * 4 + "\n" + "cd34" * 4,
    ]
    rows = secret_scan.find_secrets(frame(*enumerate(texts)), keep=["doc_id"]).collect()
    for row in rows:
        assert [f"{s['kind']}:{s['start']}:{s['end']}" for s in row["base_spans"]] == plain_secrets(texts[row["doc_id"]])


def wrapped(text):
    raw = text.encode()
    return {
        "base64": base64.b64encode(raw).decode(),
        "twice": base64.b64encode(base64.b64encode(raw)).decode(),
        "gzip": base64.b64encode(gzip.compress(raw)).decode(),
        "zlib": base64.urlsafe_b64encode(zlib.compress(raw)).decode(),
        "url": "".join(f"%{b:02x}" for b in raw),
        "url of base64": quote(base64.b64encode(raw).decode().replace("=", "%3D"), safe=""),
        "unicode": "".join(f"\\u{ord(c):04x}" for c in text),
        "unicode of url": "".join(f"\\u{ord(c):04x}" for c in "%" + quote(text)[0:] if True)[6:],
    }


@pytest.mark.parametrize("how", ["base64", "twice", "gzip", "zlib", "url", "url of base64", "unicode"])
def test_wrapped_secrets_are_found_where_they_stand(how):
    inner = "password = hunter2hunter2!"
    text = "Mañana " + wrapped(inner)[how] + " end"
    base, spans = secret_scan.scan_text(text, 1 << 20)
    added = [span for span in spans if span not in base and span[1] == 0]
    assert added and all(7 <= start and end <= len(text) - 4 for start, _, end in added)


def test_worklist_ends_and_bombs_stay_closed():
    loop = "%2525" * 2000 + base64.b64encode(gzip.compress(b"a" * 5_000_000)).decode()
    assert secret_scan.scan_text(loop, 1 << 16)[0] == secret_scan.scan_layer(loop)


@pytest.mark.parametrize("odd", ["\u00a0", "\u3000", "\ufeff", "\u200b", "\u00ad", "\f", "\0", b"\xff"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress])
def test_odd_characters_do_not_hide_a_layer(odd, pack):
    raw = (odd if isinstance(odd, bytes) else odd.encode()) + b" password = hunter2hunter2!"
    text = "x " + base64.b64encode(pack(raw)).decode() + " end"
    assert (2, 0, len(text) - 4) in scan_text_spans(text)


def scan_text_spans(text, most=1 << 20):
    return secret_scan.scan_text(text, most)[1]


def test_all_of_a_compressed_stream_is_scanned():
    secret, filler = b"password = hunter2hunter2!", bytes(random.Random(4).choices(b"ghijkl ,", k=200_000))
    members = gzip.compress(b"nothing") + gzip.compress(filler) + gzip.compress(secret)
    cut_off = gzip.compress(secret + b", " + filler)[:60_000]
    damaged = bytearray(gzip.compress(secret + b", " + filler))
    damaged[50_000:50_100] = bytes(100)
    large = gzip.compress(filler + secret + filler)
    twice = gzip.compress(zlib.compress(filler + secret))
    for raw in (members, cut_off, bytes(damaged), large, twice):
        text = "x " + base64.b64encode(raw).decode()
        for most in (1 << 12, 1 << 26):
            assert (2, 0, len(text)) in scan_text_spans(text, most)


def payloads(number):
    """Texts of some 500 bytes with a secret, plain and compressed."""
    draw = random.Random(6)
    for _ in range(number):
        words = ["".join(draw.choices("ghijklmnopqrstuvwxyz", k=draw.randint(2, 9))) for _ in range(80)]
        words.insert(draw.randint(0, 80), "password = hunter2hunter2!")
        raw = " ".join(words).encode()
        yield from (raw, zlib.compress(raw), gzip.compress(raw))


@pytest.mark.parametrize("before", ["x ", "https://h.example/cb/", "https://h.example/callback/v1/", "q=a-", "data_"])
@pytest.mark.parametrize("after", [" end", "\nnext line", ""])
@pytest.mark.parametrize("encode", [base64.b64encode, base64.urlsafe_b64encode, lambda raw: base64.urlsafe_b64encode(raw).rstrip(b"=")])
def test_no_base64_payload_is_cut_or_out_of_step(before, after, encode):
    for raw in payloads(50):
        payload = encode(raw).decode()
        spans = [(a, b) for a, kind, b in scan_text_spans(before + payload + after) if kind == 0]
        assert spans and any(b >= len(before) + 30 for _, b in spans)
        assert raw[:1] not in (b"x", b"\x1f") or (len(before), len(before) + len(payload)) in spans or payload[-1] != "="


@pytest.mark.parametrize("width", [24, 64, 75, 76])
@pytest.mark.parametrize("line_break", ["\n", "\r\n", "\n  "])
def test_wrapped_base64_is_joined(width, line_break):
    for raw in payloads(50):
        payload = base64.b64encode(raw).decode()
        wrapped_lines = line_break.join(payload[i : i + width] for i in range(0, len(payload), width))
        for before, after in (("x ", " end"), ("https://h.example/cb/", "\n\nnext")):
            spans = [(a, b) for a, kind, b in scan_text_spans(before + wrapped_lines + after) if kind == 0]
            assert spans and all(a < b <= len(before) + len(wrapped_lines) for a, b in spans)


def test_random_bytes_hold_no_secret():
    text = base64.b64encode(random.Random(7).randbytes(2_000_000)).decode()
    assert scan_text_spans(text, 1 << 26) == []


def test_only_lines_with_a_secret_are_marked():
    raw = b"ghij klmn " * 20 + b"password = hunter2hunter2! " + b"ghij klmn " * 20
    text = base64.encodebytes(raw).decode()
    ((start, _, end),) = scan_text_spans(text)
    at = raw.index(b"password") // 57
    assert (start, end) == (77 * at, 77 * at + 76 + 77 * (raw.index(b"!") // 57 - at))


def test_pieces_hold_every_secret():
    draw = random.Random(5)
    raw = b"".join(bytes(draw.choices(b"ghij ,", k=draw.randint(0, 300))) + b",token=ghijklmnopqr " for _ in range(200))
    for text in (raw, raw.replace(b",", b" ")):
        found = [piece for piece, _ in secret_scan.pieces(((text[i : i + 700], i) for i in range(0, len(text), 700)), 512)]
        assert all(len(piece) <= 512 for piece in found)
        assert sum(piece.count(b"token=ghijklmnopqr") for piece in found) >= 200


def test_masking(frame):
    rows = secret_scan.mask_secrets(frame((1, 'x token = "0123456789abcdef0123" y'), (2, None), (3, "plain"))).collect()
    assert [row["text"] for row in rows] == ['x [secret]" y', None, "plain"]
    assert rows[0]["score"] == "old"


def test_languages_are_told_apart_on_held_out_texts(spark):
    texts = documents(spark)
    rows = queries.op9_language_id(spark, SF_DIR).collect()
    assert {row["held_out"] for row in rows} == {True, False}
    for row in rows:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)
    held = [row for row in rows if row["held_out"] and len(texts[row["doc_id"]]["text"]) >= 50]
    right = sum(row["lang_pred"] == texts[row["doc_id"]]["lang"] for row in held)
    assert right >= 0.97 * len(held)


def test_bundles_equal_plain_vectors():
    first, second, third = language_id.letter_vectors()
    table = language_id.symbol_table()
    symbols = [0, *(int(table[ord(c)]) for c in "abcab"), 0]
    plain = sum(first[a].astype(int) * second[b] * third[c] for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False))
    trigrams, counts = language_id.trigram_counts(" -ABC.ab"[2:].replace(".", "") + "!!")
    assert (counts @ language_id.bind(trigrams).astype(int) == plain).all()


@pytest.mark.parametrize("rows", [ODD_TEXTS, []])
def test_odd_and_empty_tables(spark, frame, rows):
    docs = frame(*rows)
    licences = license_scan.scan_licences(docs)
    tokens = byte_bpe.decode(byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN, at_spaces=True), RANKS)
    secrets = secret_scan.find_secrets(docs)
    learned = language_id.prototypes(language_id.learning_texts(docs))
    languages = language_id.identify(docs, learned)
    for result in (licences, tokens, secrets, languages, secret_scan.mask_secrets(docs)):
        found = result.collect()
        assert len(found) == len(rows) and set(docs.columns) <= set(result.columns)
    for row in languages.collect():
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] == "und") == (not letters) and (letters or row["score"] == 0)
    for row in tokens.collect():
        assert bytes(row["decoded"]) == (row["text"] or "").encode()


def test_nothing_learned_means_unknown(frame):
    row = language_id.identify(frame((1, "words")), []).first()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)


def test_trigram_counts_do_not_depend_on_how_many_a_task_holds(spark, monkeypatch):
    rows = [(lang, f"{lang} word{number} {'abc' * (number % 5)} über") for lang in ("de", "en", "fr") for number in range(40)]
    rows += [("de", None), ("en", ""), ("fr", "123")]
    texts = spark.createDataFrame(rows, "lang string, text string").coalesce(1)

    def counts():
        found = [tuple(row) for row in language_id.learned_counts(texts).collect()]
        assert len({row[:2] for row in found}) == len(found)
        return sorted(found)

    whole = counts()
    expected = {}
    for lang, text in rows:
        for gram, n in zip(*(part.tolist() for part in language_id.trigram_counts(text)), strict=True):
            expected[lang, gram] = expected.get((lang, gram), 0) + n
    assert whole == sorted((*key, n) for key, n in expected.items())
    for held in (1, 30, 400):
        monkeypatch.setattr(language_id, "COUNTS_AT_ONCE", held)
        assert counts() == whole


def test_arrow_passes_keep_every_row_of_a_batch_larger_than_a_slice(spark, monkeypatch):
    monkeypatch.setattr(rows_module, "ROWS_AT_ONCE", 7)
    numbered = spark.range(100).coalesce(1)

    def work():
        return lambda batch: [pa.array([batch.num_rows] * batch.num_rows, pa.int64())]

    found = rows_module.map_batches(numbered, ["id"], ["id"], "n bigint", work).collect()
    assert sorted(row.id for row in found) == list(range(100))
    assert max(row.n for row in found) <= 7


@pytest.mark.parametrize(("head", "again", "tail"), [("%", "25", "41"), ("\\u", "005cu", "0041"), ("%", "25", "zz"), ("\\u", "005Cu", "zzzz")])
def test_escapes_of_escapes_take_linear_work(monkeypatch, head, again, tail):
    """However deep, few layers are made, each no longer than the text."""
    made = []
    layer = secret_scan.Layer.__init__
    monkeypatch.setattr(secret_scan.Layer, "__init__", lambda self, text, *rest: (made.append(len(text)), layer(self, text, *rest))[1])
    text = f"{head}{again * 50_000}{tail} password=Abcdef1234567890"
    _, spans = secret_scan.scan_text(text, 1 << 24)
    assert (len(text) - 25, 0, len(text)) in spans
    assert len(made) < 10 and sum(made) < 3 * len(text)


@pytest.mark.parametrize("depth", range(9))
def test_deeply_escaped_secrets_are_found(depth):
    secret = "password=Abcdef1234567890"
    percent = "".join("%" + "25" * depth + f"{ord(c):02X}" for c in secret)
    uni = "".join("\\u" + "005cu" * depth + f"{ord(c):04x}" for c in secret)
    for text in (percent, uni):
        _, spans = secret_scan.scan_text(f"see {text} there", 1 << 24)
        assert (4, 0, 4 + len(text)) in spans
