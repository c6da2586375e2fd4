"""Byte-level BPE by a sentencepiece model that is written straight from a rank file.

Every token becomes a piece whose bytes stand as characters U+0100 to U+01FF and whose score is
its negative rank, so the best merge is the lowest rank. The normaliser is the identity.
"""

from __future__ import annotations

import base64
import gc
import re
import struct
from array import array
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from replyscope.llm.rows import map_batches

FIRST = 0x100
TO_PIECE = {byte: chr(FIRST + byte) for byte in range(256)}
# Field numbers of the sentencepiece model format
PIECES, TRAINER, NORMALIZER = 1, 2, 3
BPE_MODEL, NORMAL, UNKNOWN = 2, 1, 2
# Places that are surely a space before a non-space, and texts in which a plain split would find others
CUT = re.compile(r" (?=[^\s\x1c-\x1f\x85\u180e\u200b])")
UNSAFE = re.compile(r" (?:[\s\x1c-\x1f\x85\u180e\u200b]|\Z)")
STOPS = (".", ",", ";", ":", "!", "?")
ROWS_AT_ONCE = 512


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file: a line holds the token in base64 and its rank."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, file))}


def as_piece(token: bytes) -> str:
    return token.decode("latin-1").translate(TO_PIECE)


def _varint(value: int) -> bytes:
    value &= (1 << 64) - 1
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _message(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece BPE model whose piece ids follow the order of the ranks, with the unknown piece last."""
    ordered = sorted(ranks, key=ranks.__getitem__)

    def piece(text: str, score: float, kind: int) -> bytes:
        return _message(PIECES, _message(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _number(3, kind))

    pieces = [piece(as_piece(token), -float(ranks[token]), NORMAL) for token in ordered]
    pieces.append(piece("<unk>", 0.0, UNKNOWN))
    size = len(pieces)
    trainer = _number(3, BPE_MODEL) + _number(4, size) + _number(40, size - 1) + b"".join(_number(n, -1) for n in (41, 42, 43))
    # Name, no dummy prefix, white space kept as it is
    normalizer = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _message(TRAINER, trainer) + _message(NORMALIZER, normalizer)


class PieceEncoder:
    """Packed ids of texts. Stretches and pre-tokens met before are remembered until the memory is full, then forgotten.

    With ``at_spaces`` a text is first cut before each space that a non-space follows, which is right
    for patterns that always begin a match there, take letters with a space before them as one match
    and a stop behind them as another.
    """

    def __init__(self, proto: bytes, ranks: dict[bytes, int], pattern: str, at_spaces: bool, memory: int = 150_000):
        import regex
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        self.ids = np.array(sorted(ranks.values()), dtype=np.int32)
        self.whole = {token: np.int32(rank).tobytes() for token, rank in ranks.items()}
        self.pre_tokens = regex.compile(pattern).findall
        self.at_spaces, self.memory = at_spaces, memory
        self.gapless = bool((self.ids == np.arange(len(self.ids))).all())
        self.heads: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        cut = [self._cut(text) for text in texts]
        heads = [parts.pop(0) for parts in cut]
        self._learn(set(heads), self.heads, "")
        self._learn(set().union(*cut), self.rest, " ")
        out = [self.heads[head] + b"".join(map(self.rest.__getitem__, parts)) for head, parts in zip(heads, cut, strict=True)]
        for known in (self.heads, self.rest):
            if len(known) > self.memory:
                known.clear()
        return out

    def _cut(self, text: str) -> list[str]:
        if not self.at_spaces:
            return [text]
        return CUT.split(text) if UNSAFE.search(text) else text.split(" ")

    def _pre_tokens(self, before: str, part: str) -> list[str]:
        """Matches of the pattern; letters with at most one stop behind them need no pattern where it is cut at spaces."""
        if self.at_spaces:
            if part.isalpha():
                return [before + part]
            if part[-1:] in STOPS and part[:-1].isalpha():
                return [before + part[:-1], part[-1]]
        return self.pre_tokens(before + part)

    def _learn(self, parts: set[str], known: dict[str, bytes], before: str) -> None:
        """Encode the stretches that are not known yet, all in one call of the model."""
        fresh = [part for part in parts if part not in known]
        tokens = [[token.encode() for token in self._pre_tokens(before, part)] for part in fresh]
        # A pre-token that is itself in the vocabulary needs no merges
        missing = [token for token in {token for row in tokens for token in row} if token not in self.whole]
        packed = {}
        if missing:
            shown = np.frombuffer(b"".join(missing), dtype=np.uint8).astype("<u2") + FIRST
            shown, ends = shown.tobytes().decode("utf-16-le"), np.cumsum([len(token) for token in missing]).tolist()
            pieces = [shown[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            for token, ids in zip(missing, self.model.encode(pieces, num_threads=1), strict=True):
                packed[token] = (array("i", ids) if self.gapless else self.ids[ids]).tobytes()
        whole = self.whole
        for part, row in zip(fresh, tokens, strict=True):
            known[part] = b"".join([whole[token] if token in whole else packed[token] for token in row])


def encoding(ranks: dict[bytes, int], pattern: str, text: str, at_spaces: bool) -> Callable[[pa.RecordBatch], pa.ListArray]:
    """A function from a batch with texts to the ids of each."""
    encoder = PieceEncoder(model_proto(ranks), ranks, pattern, at_spaces)

    def step(batch: pa.RecordBatch) -> pa.ListArray:
        column, packed = batch.column(text), []
        # Millions of small lists and no cycles: the cyclic collector would only cost time
        gc.disable()
        try:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                packed += encoder.encode([row or "" for row in column.slice(start, ROWS_AT_ONCE).to_pylist()])
        finally:
            gc.enable()
        offsets = np.concatenate([[0], np.cumsum([len(row) // 4 for row in packed])])
        if offsets[-1] > np.iinfo(np.int32).max:
            raise ValueError("a batch has more than 2^31 ids; lower spark.sql.execution.arrow.maxRecordsPerBatch")
        ids = pa.array(np.frombuffer(b"".join(packed), dtype=np.int32))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids)

    return step


def decoding(ranks: dict[bytes, int]) -> Callable[[pa.ListArray], pa.Array]:
    """A function from lists of ids to the bytes of each."""
    token_of = {rank: token for token, rank in ranks.items()}.__getitem__

    def step(lists: pa.ListArray) -> pa.Array:
        rows = (lists.slice(at, 1).flatten().to_numpy(zero_copy_only=False) for at in range(len(lists)))
        return pa.array([b"".join(map(token_of, row.tolist())) for row in rows], pa.binary())

    return step


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    at_spaces: bool = False,
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """Add ``token_ids`` (array<int>): ids of all matches of ``pattern`` in the whole text, without special tokens.

    Null and empty texts give no ids. Every row is encoded alone, so nothing is shuffled, repeated
    rows repeat and an empty table stays empty. Other columns are kept unless named ``token_ids``.
    The vocabulary file must lie at ``ranks_path`` on each executor; every byte must be a token.
    ``at_spaces`` may be set for patterns of the kind that ``PieceEncoder`` describes.
    """

    def work():
        ids = encoding(read_ranks(ranks_path), pattern, text, at_spaces)
        return lambda batch: [ids(batch)]

    return map_batches(docs, [text], docs.columns if keep is None else keep, "token_ids array<int>", work)


def decode(tokens: DataFrame, ranks_path: str, ids: str = "token_ids", keep: Iterable[str] | None = None) -> DataFrame:
    """Add ``decoded`` (binary): the bytes of the ids, by the inverse of the vocabulary.

    Null or no ids give no bytes; an id outside the vocabulary raises an error.
    """

    def work():
        raw = decoding(read_ranks(ranks_path))
        return lambda batch: [raw(batch.column(ids))]

    return map_batches(tokens, [ids], tokens.columns if keep is None else keep, "decoded binary", work)


def encode_and_decode(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", at_spaces: bool = False, keep: Iterable[str] | None = None
) -> DataFrame:
    """Add ``token_ids`` as ``encode`` and ``decoded`` as ``decode``, in one pass, so that a task has one Python worker and one vocabulary."""

    def work():
        ranks = read_ranks(ranks_path)
        ids, raw = encoding(ranks, pattern, text, at_spaces), decoding(ranks)

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            found = ids(batch)
            return [found, raw(found)]

        return step

    return map_batches(docs, [text], docs.columns if keep is None else keep, "token_ids array<int>, decoded binary", work)
