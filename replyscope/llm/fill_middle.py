"""Fill-in-the-middle samples whose cuts are found from memoised chunks of the text.

A rolling hash cuts a text where its last bytes say so, so a passage that many documents share falls into
the same chunks in all of them. What a chunk adds to the count of units depends on nothing but its bytes
and on whether a word runs into it; that summary is kept by content. The summaries of a document's
chunks, added up, give its count of units and the chunk in which a cut lies; only that chunk is looked into.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from replyscope.llm.rows import map_batches, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = [mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE)]
SEED = 42
# Of 100 texts so many are cut, and of 100 cut ones so many have the suffix first
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 50, 80
# A byte ends a chunk with a chance of one in 2^CHUNK_BITS; a chunk without such a byte ends at LONGEST_CHUNK
CHUNK_BITS = 8
LONGEST_CHUNK = 4096
# Bytes of chunks that a task remembers
CACHE_BYTES = 32 << 20
WORD_RE = re.compile(rb"[^\x20\x09-\x0D]+")
BLANKS = frozenset(b" \t\n\x0b\x0c\r")
# One random number per byte value, from a rule
GEAR = np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:4]) for b in range(256)], dtype=np.uint32)


def chunk_ends(raw: bytes) -> list[int]:
    """Where the chunks of a UTF-8 text end. A chunk never ends inside a character.

    The hash of a place covers the 32 bytes before it: h = 2 * h + GEAR[byte], modulo 2^32, for all
    places at once by doubling the width of the window five times.
    """
    if not raw:
        return []
    data = np.frombuffer(raw, dtype=np.uint8)
    rolling = GEAR[data]
    for width in (1, 2, 4, 8, 16):
        wider = rolling.copy()
        wider[width:] += rolling[:-width] << np.uint32(width)
        rolling = wider
    inside = np.zeros(len(data), dtype=bool)
    inside[:-1] = (data[1:] & 0xC0) == 0x80
    ends, last = [], 0
    for end in [*(np.flatnonzero((rolling >> np.uint32(32 - CHUNK_BITS) == 0) & ~inside) + 1).tolist(), len(data)]:
        while end - last > LONGEST_CHUNK:
            last += LONGEST_CHUNK
            while last < end and inside[last - 1]:
                last += 1
            ends.append(last)
        if end > last:
            ends.append(end)
            last = end
    return ends


@dataclass(frozen=True)
class Summary:
    """What a chunk tells about its text: characters, words, and whether it starts and ends inside a word."""

    chars: int
    words: int
    opens: bool
    closes: bool


def summarise(chunk: bytes) -> Summary:
    chars = len(chunk) - sum(map(chunk.count, CONTINUATIONS)) if not chunk.isascii() else len(chunk)
    return Summary(chars, len(chunk.split()), chunk[0] not in BLANKS, chunk[-1] not in BLANKS)


CONTINUATIONS = [bytes([b]) for b in range(0x80, 0xC0)]


class ChunkCache:
    """Summaries by content: the hash finds an entry, its bytes prove that it is the chunk.

    Holds at most ``limit`` bytes of chunks; when full it starts anew. Results do not depend on what is remembered.
    """

    def __init__(self, limit: int = CACHE_BYTES, digest: Callable[[bytes], int] = xxhash.xxh3_64_intdigest):
        self.limit, self.digest = limit, digest
        self.known: dict[int, tuple[bytes, Summary]] = {}
        self.held = self.hits = self.misses = 0

    def summary(self, chunk: bytes) -> Summary:
        name = self.digest(chunk)
        entry = self.known.get(name)
        if entry is not None and entry[0] == chunk:
            self.hits += 1
            return entry[1]
        self.misses += 1
        found = summarise(chunk)
        if entry is None:
            if self.held + len(chunk) > self.limit:
                self.known.clear()
                self.held = 0
            self.known[name] = (chunk, found)
            self.held += len(chunk)
        return found


class Units:
    """The units of one text: blanks with the word behind them, and blanks at the end.

    ``ended[i]`` words and ``before[i]`` characters lie before chunk i; a word that runs on into chunk i has not ended yet.
    """

    def __init__(self, raw: bytes, cache: ChunkCache):
        self.raw = raw
        self.starts, self.ended, self.before, self.running = [], [], [], []
        start = words = chars = 0
        running = False
        for end in chunk_ends(raw):
            found = cache.summary(raw[start:end])
            self.starts.append(start)
            self.before.append(chars)
            self.ended.append(words - running)
            self.running.append(running)
            words += found.words - (running and found.opens)
            chars += found.chars
            start, running = end, found.closes
        self.chars = chars
        self.count = words + (bool(raw) and not running)

    def end_of(self, unit: int) -> tuple[int, int]:
        """(byte, character) behind the first ``unit`` units."""
        if unit == 0:
            return 0, 0
        if unit == self.count:
            return len(self.raw), self.chars
        # The last chunk before which fewer words have ended holds the end of this word
        at = bisect_left(self.ended, unit) - 1
        start = self.starts[at]
        stop = self.starts[at + 1] if at + 1 < len(self.starts) else len(self.raw)
        chunk = self.raw[start:stop]
        left = unit - self.ended[at]
        if self.running[at]:
            left -= 1
            if left == 0 and chunk[0] in BLANKS:
                return start, self.before[at]
            left += chunk[0] not in BLANKS
        for number, word in enumerate(WORD_RE.finditer(chunk), 1):
            if number == left:
                break
        inner = word.end()
        return start + inner, self.before[at] + len(chunk[:inner].decode("utf-8", "replace"))


def draws(key: object, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits that depend on the id and the seed only; a null id has no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return tuple(int(digest[at : at + 8], 16) for at in range(0, 32, 8))


def transformed(raw: bytes, key: object, cache: ChunkCache, seed: int = SEED) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, characters of the prefix, characters of the middle, output) of one text."""
    units = Units(raw, cache)
    first, second, whether, which = draws(key, seed)
    if not raw or any(mark in raw for mark in MARKS) or whether % 100 >= CUT_PERCENT:
        return units.count, "plain", None, None, raw
    low, high = sorted((first % (units.count + 1), second % (units.count + 1)))
    (from_byte, from_char), (to_byte, to_char) = units.end_of(low), units.end_of(high)
    prefix, middle, suffix = raw[:from_byte], raw[from_byte:to_byte], raw[to_byte:]
    before, behind, between = MARKS
    if which % 100 < SUFFIX_FIRST_PERCENT:
        form, output = "spm", b"".join((behind, suffix, before, prefix, between, middle))
    else:
        form, output = "psm", b"".join((before, prefix, behind, suffix, between, middle))
    return units.count, form, from_char, to_char - from_char, output


def restored(output: bytes, form: str) -> bytes:
    """The text of an output. A cut text holds no mark, so the first mark of each kind is the one that was put in."""
    if form == "plain":
        return output
    before, behind, between = MARKS
    head, tail = (behind, before) if form == "spm" else (before, behind)
    body, middle = output[len(head) :].split(between, 1)
    one, other = body.split(tail, 1)
    return other + middle + one if form == "spm" else one + middle + other


def fill_in_middle(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None, seed: int = SEED
) -> DataFrame:
    """Add n, form, prefix_chars, middle_chars, output and restored (both binary) to every row.

    A null text counts as empty; an empty text and one that holds a mark stay plain, with null lengths. A null id
    draws like an id without digits. Repeated rows and equal ids give equal cuts. A text of blanks is one unit;
    a text of any length is cut into chunks of bounded length. An empty table gives an empty one. ``keep``
    names the columns of the result (all if null); one with the name of a result is replaced, also where it
    differs in case only. No row changes place; a task remembers chunks of at most ``CACHE_BYTES``.
    """
    results = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary, restored binary"
    taken = {part.split()[0] for part in results.split(", ")}
    keep = [name for name in (docs.columns if keep is None else keep) if name.lower() not in taken]

    def work():
        cache = ChunkCache()

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            keys = batch.column(key).to_pylist()
            rows = [transformed(raw.as_py(), name, cache, seed) for raw, name in zip(text_bytes(batch, text), keys, strict=True)]
            n, form, prefix, middle, output = zip(*rows, strict=True) if rows else ([],) * 5
            back = [restored(made, kind) for made, kind in zip(output, form, strict=True)]
            numbers = [pa.array(column, pa.int64()) for column in (prefix, middle)]
            return [pa.array(n, pa.int64()), pa.array(form, pa.string()), *numbers, pa.array(output, pa.binary()), pa.array(back, pa.binary())]

        return step

    return map_batches(docs, [key, text], keep, results, work)
