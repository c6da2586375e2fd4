"""Secrets in texts and in what texts wrap: a worklist of decoded layers.

Each layer is scanned like the text itself. Percent escapes, backslash-u escapes, base64 and
compressed data inside a layer make further layers, until no new one appears; a layer whose
content was seen on the way down is not opened again. An escape that was itself escaped three times or more
is opened to its end at once, so layers stay few. Every layer maps its characters to spans
of the text, so a finding deep inside is reported at the place that holds it. Decoded bytes need
not be text: bytes outside UTF-8 become lone surrogates, which no pattern holds.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from replyscope.llm import fixed_values as fixed
from replyscope.llm.rows import map_batches

KINDS = [kind for kind, *_ in fixed.SECRET_PATTERNS]
ASSIGN, ACCESS, HEX = (pattern for _, pattern, *_ in fixed.SECRET_PATTERNS)
ASSIGN_GROUP, ASSIGN_LEAST = fixed.SECRET_PATTERNS[0][2:]
ACCESS_LEAST, HEX_LEAST = fixed.SECRET_PATTERNS[1][3], fixed.SECRET_PATTERNS[2][3]
ASSIGN_RE = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
ACCESS_RE = re.compile(ACCESS)
# Runs are maximal either way, so the length can stand in the pattern
HEX_RE = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)
KEYWORD = "(?i)passw(or)?d|secret|token|api_?key"
# One escape; an escape of an escape, three deep or deeper, is one too, so that depth costs no layers
PERCENT_ONE = re.compile(r"%(?:(?:25){3,}(?=[0-9A-Fa-f]{2}))?([0-9A-Fa-f]{2})")
UNICODE_ONE = re.compile(r"\\u(?:(?:005[cC]u){3,}(?=[0-9A-Fa-f]{4}))?([0-9A-Fa-f]{4})")
PERCENT_RE = re.compile(r"(?:%(?:(?:25){3,}(?=[0-9A-Fa-f]{2}))?[0-9A-Fa-f]{2})+")
UNICODE_RE = re.compile(r"(?:\\u(?:(?:005[cC]u){3,}(?=[0-9A-Fa-f]{4}))?[0-9A-Fa-f]{4})+")
LEAST_BASE64 = 20
LINE_RE = re.compile("[A-Za-z0-9+/_-]+")
# Long lines and the line after them, whatever its length
BREAK = r"[ \t]*\r?\n[ \t]*"
BASE64_RE = re.compile(
    r"[A-Za-z0-9+/_-]{%d,}(?:%s[A-Za-z0-9+/_-]{%d,})*(?:%s[A-Za-z0-9+/_-]+)?={0,2}" % (LEAST_BASE64, BREAK, LEAST_BASE64, BREAK)
)
STANDARD = str.maketrans("-_", "+/")
BASE64_BYTES = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"))
HEX_BYTES = np.isin(np.arange(256), list(b"0123456789abcdef"))
# What every secret and every wrapped layer has; bytes without it hold none
LEADS_RE = re.compile(
    rb"(?i:passw(?:or)?d|secret|token|api_?key)|AKIA|%%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|[0-9a-f]{%d}|[A-Za-z0-9+/_-]{%d}"
    % (HEX_LEAST, LEAST_BASE64)
)
# As much as possible, up to a byte that stands in no secret and no wrapped layer
CUT_RE = re.compile(rb"(?s:.*)[^A-Za-z0-9+/_=.:'\"\\%\s-]")
# Compressed bytes that are opened at a time
INPUT_BYTES = 1 << 16
PROBE_BYTES, SOUND_BYTES = 4096, 512
SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
FIELDS = "base_spans array<struct<kind:string,start:bigint,end:bigint>>, spans array<struct<kind:string,start:bigint,end:bigint>>"

Span = tuple[int, int, int]


def scan_layer(text: str) -> list[Span]:
    """(start, kind number, end) of the secrets that stand in a text as they are, sorted."""
    found = [
        (match.start(), 0, match.end())
        for match in ASSIGN_RE.finditer(text)
        if len(match.group(ASSIGN_GROUP)) >= ASSIGN_LEAST
    ]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS_RE.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    found += [(match.start(), 2, match.end()) for match in HEX_RE.finditer(text)]
    return sorted(found)


class Layer:
    """Decoded text with the span of the original that each of its characters stands for."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray, above: frozenset[bytes]):
        self.text, self.starts, self.ends = text, starts, ends
        self.name = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
        self.above, self.seen = above, above | {self.name}

    def spans(self) -> list[Span]:
        return [(int(self.starts[a]), kind, int(self.ends[b - 1])) for a, kind, b in scan_layer(self.text)]

    def whole(self, raw: bytes, start: int, end: int) -> Layer:
        """A layer of decoded bytes of which every character stands for the same stretch of the original."""
        text = raw.decode("utf-8", "surrogateescape")
        return Layer(text, np.broadcast_to(start, len(text)), np.broadcast_to(end, len(text)), self.seen)


def unescape(layer: Layer, pattern: re.Pattern, decoded) -> Layer | None:
    """The layer with all stretches of escapes replaced; text between them keeps its places."""
    texts, starts, ends, at = [], [], [], 0
    for match in pattern.finditer(layer.text):
        pieces = decoded(match.group())
        if pieces is None:
            continue
        texts.append(layer.text[at : match.start()])
        starts.append(layer.starts[at : match.start()])
        ends.append(layer.ends[at : match.start()])
        for text, first, last in pieces:
            texts.append(text)
            starts.append(np.full(len(text), layer.starts[match.start() + first]))
            ends.append(np.full(len(text), layer.ends[match.start() + last - 1]))
        at = match.end()
    if not at:
        return None
    texts.append(layer.text[at:])
    starts.append(layer.starts[at:])
    ends.append(layer.ends[at:])
    return Layer("".join(texts), np.concatenate(starts), np.concatenate(ends), layer.seen)


def percent_pieces(run: str) -> list[tuple[str, int, int]]:
    """Characters of a run of percent escapes with their places; a byte outside UTF-8 stays one character."""
    escapes = list(PERCENT_ONE.finditer(run))
    raw, out, at = bytes(int(escape[1], 16) for escape in escapes), [], 0
    for char in raw.decode("utf-8", "surrogateescape"):
        size = 1 if "\udc80" <= char <= "\udcff" else len(char.encode())
        out.append((char, escapes[at].start(), escapes[at + size - 1].end()))
        at += size
    return out


def unicode_pieces(run: str) -> list[tuple[str, int, int]]:
    """Characters of a run of backslash-u escapes; a surrogate pair is one character."""
    escapes = list(UNICODE_ONE.finditer(run))
    units, out, at = [int(escape[1], 16) for escape in escapes], [], 0
    while at < len(units):
        pair = 0xD800 <= units[at] < 0xDC00 and at + 1 < len(units) and 0xDC00 <= units[at + 1] < 0xE000
        code = 0x10000 + ((units[at] - 0xD800) << 10) + units[at + 1] - 0xDC00 if pair else units[at]
        out.append((chr(code), escapes[at].start(), escapes[at + pair].end()))
        at += 1 + pair
    return out


def is_packed(raw: bytes) -> bool:
    """Whether bytes begin like gzip or zlib data."""
    if raw[:3] == b"\x1f\x8b\x08":
        return True
    return len(raw) > 2 and raw[0] & 0x8F == 8 and not raw[1] & 0x20 and (raw[0] << 8 | raw[1]) % 31 == 0


def up_to_fault(opened, data: bytes) -> bytes:
    """What a decompressor gives for damaged data before the fault."""
    out = bytearray()
    try:
        for at in range(len(data)):
            out += opened.decompress(data[at : at + 1])
    except zlib.error:
        pass
    return bytes(out)


def unpacked(source: Iterable[tuple[bytes, int]], most: int) -> Iterator[tuple[bytes, int]]:
    """Content of all members of a gzip or zlib stream, at most ``most`` bytes at a time, with the place where the input read so far ends.

    ``source`` gives the stream in parts, each with the place where it ends. A stream that is cut
    off or damaged gives what stands before the fault.
    """
    opened, rest = None, b""
    for data, end in source:
        data, rest = rest + data, b""
        while True:
            if opened is None:
                data = data.lstrip(b"\0")
                if len(data) < 3:
                    rest = data
                    break
                if not is_packed(data):
                    return
                opened = zlib.decompressobj(47)
            before = opened.copy()
            try:
                out = opened.decompress(data, most)
            except zlib.error:
                yield up_to_fault(before, data), end
                return
            if out:
                yield out, end - len(opened.unused_data)
            if opened.eof:
                data, opened = opened.unused_data, None
            else:
                data = opened.unconsumed_tail
                if not data and len(out) < most:
                    break


def pieces(parts: Iterable[tuple[bytes, int]], most: int) -> Iterator[tuple[bytes, int]]:
    """Parts joined to pieces of at most ``most`` bytes.

    A cut is made behind a byte that stands in no secret and no wrapped layer; if the last quarter
    of a piece has none, it is repeated in the next.
    """
    held, end, quarter = bytearray(), 0, max(1, most // 4)
    for part, end in parts:
        held += part
        while len(held) > most:
            cut = CUT_RE.match(held, most - quarter, most)
            yield bytes(held[: cut.end() if cut else most]), end
            del held[: cut.end() if cut else most - quarter]
    if held:
        yield bytes(held), end


def contents(source: Callable[[], Iterable[tuple[bytes, int]]], most: int, seen: frozenset[bytes] = frozenset()) -> Iterator[tuple[bytes, int]]:
    """Pieces of what a compressed stream holds, and of what that holds if it is compressed again."""

    def parts() -> Iterator[tuple[bytes, int]]:
        return unpacked(source(), most)

    first = next(parts(), (b"", 0))[0]
    name = hashlib.blake2b(first, digest_size=16).digest()
    if first and name not in seen:
        yield from pieces(parts(), most)
        if is_packed(first):
            yield from contents(parts, most, seen | {name})


def stream_of(raw: bytes, start: int = 0) -> Iterator[tuple[bytes, int]]:
    """Bytes from a place on in parts, each with the place where it ends."""
    for at in range(start, len(raw), INPUT_BYTES):
        part = raw[at : at + INPUT_BYTES]
        yield part, at + len(part)


def packed_places(raw: bytes) -> list[int]:
    """Places, in steps of three bytes, at which gzip or zlib data may begin."""
    values = np.frombuffer(raw, dtype=np.uint8).astype(np.uint16)
    second = values[1::3]
    first = values[::3][: len(second)]
    zlib_head = (first & 0x8F == 8) & (second & 0x20 == 0) & ((first << 8 | second) % 31 == 0)
    places = np.flatnonzero(zlib_head | (first == 0x1F) & (second == 0x8B)) * 3
    return [at for at in places.tolist() if is_packed(raw[at : at + 3])]


def is_sound(raw: bytes, place: int) -> bool:
    """Whether data behind two or three fitting bytes is a stream: no fault in its first bytes, or only after much content.

    Chance gives such bytes every few thousand, and a fault soon after them.
    """
    part = raw[place : place + PROBE_BYTES]
    try:
        zlib.decompressobj(47).decompress(part, INPUT_BYTES)
        return True
    except zlib.error:
        return len(up_to_fault(zlib.decompressobj(47), part)) >= SOUND_BYTES


class Run:
    """A run of base64 in a layer, its lines joined.

    What stands before the payload (a path, a line of other text) can be part of the run, so it is
    decoded from each of the four places where a group can begin, and compressed data is looked for
    behind every character. A finding stands for the lines that hold it; it begins behind the mark that
    comes first after the last character that is no text, if that leaves a payload in step.
    """

    def __init__(self, layer: Layer, start: int, end: int):
        lines = [match.span() for match in LINE_RE.finditer(layer.text, start, end)]
        self.layer = layer
        self.body = "".join(layer.text[a:b] for a, b in lines).translate(STANDARD)
        self.stops = np.cumsum([b - a for a, b in lines])
        # Places in the layer: of each character, of the ends of lines, with the padding of the last
        self.places = np.concatenate([np.arange(a, b) for a, b in lines])
        self.line_starts = np.array([a for a, _ in lines])
        self.line_ends = np.array([*(b for _, b in lines[:-1]), end])

    def line(self, at: np.ndarray) -> np.ndarray:
        """Lines of places in the body."""
        return np.minimum(np.searchsorted(self.stops, at, side="right"), len(self.stops) - 1)

    def layers(self, most: int) -> Iterator[Layer]:
        for offset in range(4):
            size = len(self.body) - offset
            part = self.body[offset : offset + size - (size % 4 == 1)]
            raw = base64.b64decode(part + "=" * (-len(part) % 4))
            if LEADS_RE.search(raw):
                yield self.text_layer(raw, offset)
            for place in packed_places(raw):
                if offset + place and not is_sound(raw, place):
                    continue
                first = self.layer.starts[self.places[offset + place // 3 * 4]]
                for piece, end in contents(partial(stream_of, raw, place), most):
                    if LEADS_RE.search(piece):
                        last = self.line_ends[self.line(offset + (end - 1) // 3 * 4 + (end - 1) % 3 + 1)]
                        yield self.layer.whole(piece, first, self.layer.ends[last - 1])

    def text_layer(self, raw: bytes, offset: int) -> Layer:
        text = raw.decode("utf-8", "surrogateescape")
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        odd = (codes >= 0xDC80) & (codes <= 0xDCFF) | (codes < 32) & ~np.isin(codes, [0, 9, 10, 12, 13])
        escaped = (codes >= 0xDC80) & (codes <= 0xDCFF)
        sizes = np.where(escaped, 1, 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000))
        ends = np.cumsum(sizes)
        firsts = ends - sizes
        # In the body: the character with the first bit, and the one with the last
        at = offset + firsts // 3 * 4 + firsts % 3
        last = offset + (ends - 1) // 3 * 4 + (ends - 1) % 3 + 1
        starts = self.line_starts[self.line(at)]
        marks = np.flatnonzero(np.isin(np.frombuffer(self.body.encode(), dtype=np.uint8), list(b"+/"))) + 1
        heads = np.concatenate([[0], marks])
        heads = np.append(heads[heads % 4 == offset], len(self.body))
        clean = np.maximum.accumulate(np.where(odd, last, 0))
        head = heads[np.searchsorted(heads, clean)]
        starts = np.where(head <= at, np.maximum(starts, self.places[np.minimum(head, len(self.places) - 1)]), starts)
        stops = self.line_ends[self.line(last)]
        return Layer(text, self.layer.starts[starts], self.layer.ends[stops - 1], self.layer.seen)


def below(layer: Layer, most: int) -> Iterator[Layer]:
    """The layers one step inside a layer, one at a time."""
    if "%" in layer.text and (inner := unescape(layer, PERCENT_RE, percent_pieces)):
        yield inner
    if "\\u" in layer.text and (inner := unescape(layer, UNICODE_RE, unicode_pieces)):
        yield inner
    for match in BASE64_RE.finditer(layer.text):
        yield from Run(layer, match.start(), match.end()).layers(most)


def scan_text(text: str, most: int) -> tuple[list[Span], list[Span]]:
    """Secrets in the text itself, and those together with all that its decoded layers hold."""
    base = scan_layer(text)
    found, done = set(base), set()
    places = np.arange(len(text) + 1)
    work = [below(Layer(text, places[:-1], places[1:], frozenset()), most)]
    first = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        here = (layer.name, int(layer.starts[0]), int(layer.ends[-1]))
        # Nothing new: the text itself, a layer it came from, or the same content at the same place
        if layer.name == first or layer.name in layer.above or here in done:
            continue
        done.add(here)
        found.update(layer.spans())
        work.append(below(layer, most))
    return base, sorted(found)


def runs_of(values: np.ndarray, allowed: np.ndarray, least: int) -> np.ndarray:
    """Places where runs of at least ``least`` allowed bytes begin."""
    inside = np.zeros(len(values) + 2, dtype=np.int8)
    inside[1:-1] = allowed[values]
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    return starts[ends - starts >= least]


def suspects(texts: pa.Array) -> np.ndarray:
    """Rows that may hold a secret or a wrapped layer; every other row has none for certain."""
    texts = texts.cast(pa.large_string())
    marked = pc.match_substring_regex(texts, KEYWORD).to_numpy(zero_copy_only=False)
    for wanted in (r"%[0-9A-Fa-f]{2}", r"\\u[0-9A-Fa-f]{4}", "AKIA"):
        marked |= pc.match_substring_regex(texts, wanted).to_numpy(zero_copy_only=False)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if texts.buffers()[2] is not None and len(texts):
        values = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        # A run that goes on into the next row only marks a row too much
        for allowed, least in ((HEX_BYTES, HEX_LEAST), (BASE64_BYTES, LEAST_BASE64)):
            starts = runs_of(values, allowed, least) + offsets[0]
            first = np.searchsorted(offsets, starts, side="right") - 1
            marked[first] = True
            # Rows that such a run crosses into
            for row in np.unique(first):
                after = row + 1
                while after < len(texts) and crosses(values, offsets, offsets[0], after, allowed):
                    marked[after] = True
                    after += 1
    return marked


def crosses(values: np.ndarray, offsets: np.ndarray, base: int, row: int, allowed: np.ndarray) -> bool:
    """Whether a run of allowed bytes goes on over the start of a row."""
    at = offsets[row] - base
    return at >= len(values) or bool(allowed[values[at]])


def find_secrets(docs: DataFrame, most_bytes: int = 1 << 26, keep: Iterable[str] | None = None) -> DataFrame:
    """Add ``base_spans`` and ``spans``: kind, start and end (code points, end exclusive) of secrets.

    Base spans stand in the text itself; ``spans`` has those and what decoded layers hold, at the
    place of the text that holds them, sorted by start, kind and end. Null and empty texts have
    none, repeated rows repeat, an empty table stays empty, and other columns are kept unless they
    have the name of a result. Compressed data is unpacked and scanned whole, ``most_bytes`` at a
    time, which bounds the memory of a task. Nothing is shuffled.
    """

    def work():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = batch.column("text").fill_null("")
            base: list[list[dict]] = [[]] * batch.num_rows
            full: list[list[dict]] = [[]] * batch.num_rows
            for row in np.flatnonzero(suspects(texts)).tolist():
                both = scan_text(texts[row].as_py(), most_bytes)
                base[row], full[row] = ([{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans] for spans in both)
            return [pa.array(base, pa.list_(SPAN)), pa.array(full, pa.list_(SPAN))]

        return step

    return map_batches(docs, ["text"], docs.columns if keep is None else keep, FIELDS, work)


def mask_secrets(docs: DataFrame, mask: str = "[secret]", most_bytes: int = 1 << 26) -> DataFrame:
    """The same rows and columns, with every span of a secret in ``text`` replaced by ``mask``.

    Overlapping and touching spans are replaced once. Null texts stay null.
    """

    def work():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            column = batch.column("text")
            out = column.to_pylist()
            for row in np.flatnonzero(suspects(column.fill_null(""))).tolist():
                _, spans = scan_text(out[row], most_bytes)
                for start, end in reversed(merged(spans)):
                    out[row] = out[row][:start] + mask + out[row][end:]
            return [pa.array(out, pa.string())]

        return step

    return map_batches(docs, ["text"], docs.columns, "text string", work).select(*docs.columns)


def merged(spans: list[Span]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, _, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out
