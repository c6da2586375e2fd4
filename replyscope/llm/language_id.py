"""Language by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram is bound as the product of its letters'
vectors, rolled twice, once and not at all; a text bundles (adds) the vectors of its trigrams, a
language those of its learning texts. A text gets the language whose prototype has the highest
cosine with it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from replyscope.llm.rows import map_batches
from replyscope.session import tidy

DIMENSIONS = 1024
# Symbols: 0 for everything that is no letter, one for each code point below DIRECT, the rest shared by hash
SYMBOLS, DIRECT = 1024, 0x250
UNKNOWN = "und"
MAX_LANGUAGES = 8192
# Trigram counts that a learning task holds before it adds them up
COUNTS_AT_ONCE = 1 << 19


@lru_cache(maxsize=1)
def symbol_table() -> np.ndarray:
    """Symbol of each code point; upper and lower case share one."""
    table = np.zeros(sys.maxunicode + 1, dtype=np.int64)
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if char.isalpha():
            low = ord(char.lower()[0])
            table[code] = low if low < DIRECT else DIRECT + (low * 2654435761 >> 7) % (SYMBOLS - DIRECT)
    return table


@lru_cache(maxsize=1)
def letter_vectors() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors of the symbols, rolled twice, once and not at all."""
    letters = np.random.default_rng(20240229).choice(np.array([-1, 1], dtype=np.int8), (SYMBOLS, DIMENSIONS))
    return np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters


def bind(trigrams: np.ndarray) -> np.ndarray:
    """Vectors of trigram numbers."""
    first, second, third = letter_vectors()
    return first[trigrams // SYMBOLS**2] * second[trigrams // SYMBOLS % SYMBOLS] * third[trigrams % SYMBOLS]


def trigram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Trigram numbers of the whole text and how often each occurs; none if the text has no letter."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    symbols = symbol_table()[codes]
    if not symbols.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    symbols = np.concatenate([[0], symbols, [0]])
    # Any stretch without letters is one gap
    symbols = symbols[np.concatenate([[True], (symbols[1:] != 0) | (symbols[:-1] != 0)])]
    return np.unique((symbols[:-2] * SYMBOLS + symbols[1:-1]) * SYMBOLS + symbols[2:], return_counts=True)


def summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram numbers of several counts and their total counts."""
    trigrams, place = np.unique(np.concatenate([t for t, _ in parts]), return_inverse=True)
    return trigrams, np.bincount(place, np.concatenate([n for _, n in parts])).astype(np.int64)


def learned_counts(texts: DataFrame) -> DataFrame:
    """(lang, trigram, n): trigram counts of all learning texts, summed inside each task before the shuffle.

    A task adds up ``COUNTS_AT_ONCE`` counts at a time; sums that do not get smaller are passed on and dropped.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list] = {}
        waiting = 0

        def given_out() -> Iterator[pa.RecordBatch]:
            for lang, found in parts.items():
                trigrams, totals = summed(found)
                columns = [pa.array([lang] * len(trigrams), pa.string()), pa.array(trigrams), pa.array(totals)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "trigram", "n"])
            parts.clear()

        for batch in batches:
            for row in range(batch.num_rows):
                found = trigram_counts(batch.column("text")[row].as_py())
                if not len(found[0]):
                    continue
                parts.setdefault(batch.column("lang")[row].as_py(), []).append(found)
                waiting += len(found[0])
                if waiting < COUNTS_AT_ONCE:
                    continue
                for lang in parts:
                    parts[lang] = [summed(parts[lang])]
                waiting = sum(len(found[0][0]) for found in parts.values())
                if waiting > COUNTS_AT_ONCE // 2:
                    yield from given_out()
                    waiting = 0
        yield from given_out()

    parts = texts.select("lang", "text").mapInArrow(tidy(count), "lang string, trigram bigint, n bigint")
    return parts.groupBy("lang", "trigram").agg(F.sum("n").alias("n"))


def prototypes(texts: DataFrame) -> list[tuple[str, np.ndarray]]:
    """(lang, unit vector) of each language in ``texts`` (lang, text), in order of their names.

    Trigrams are bound and bundled in tasks; the driver gets one vector per task and language, so
    its memory is bounded by the number of languages, at most ``MAX_LANGUAGES``.
    """

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            trigrams, counts = (batch.column(name).to_numpy() for name in ("trigram", "n"))
            for lang in set(langs):
                rows = np.flatnonzero(langs == lang)
                for start in range(0, len(rows), 4096):
                    at = rows[start : start + 4096]
                    part = counts[at].astype(np.float64) @ bind(trigrams[at])
                    sums[lang] = sums.get(lang, 0) + part
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([vector.tolist()])], names=["lang", "vector"])

    parts = learned_counts(texts).mapInArrow(tidy(bundle), "lang string, vector array<double>")
    places = F.posexplode("vector").alias("place", "x")
    sums = parts.select("lang", places).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    rows = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("v")).limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    vectors = ((row["lang"], np.array([x for _, x in row["v"]])) for row in rows)
    return sorted(((lang, v / (np.linalg.norm(v) or 1.0)) for lang, v in vectors), key=lambda p: p[0])


def identify(docs: DataFrame, learned: list[tuple[str, np.ndarray]], keep: Iterable[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score``, the cosine with the prototype (negative counts as 0).

    A null text and a text without a letter get ``und`` and 0, as does every text if nothing was
    learned; ties go to the first name. Only the text is looked at. Nothing is shuffled, repeated
    rows repeat, an empty table stays empty, and other columns are kept unless they have the name
    of a result.
    """
    names = [lang for lang, _ in learned]
    matrix = np.array([vector for _, vector in learned], dtype=np.float32)

    def work():
        def judge(text: str | None) -> tuple[str, float]:
            trigrams, counts = trigram_counts(text)
            if not names or not len(trigrams):
                return UNKNOWN, 0.0
            bundled = np.zeros(DIMENSIONS, dtype=np.float32)
            for start in range(0, len(trigrams), 2048):
                part = slice(start, start + 2048)
                bundled += counts[part].astype(np.float32) @ bind(trigrams[part]).astype(np.float32)
            cosines = matrix @ bundled / (np.linalg.norm(bundled) or 1.0)
            best = int(cosines.argmax())
            return names[best], min(1.0, max(0.0, float(cosines[best])))

        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            found = [judge(text.as_py()) for text in batch.column("text")]
            return [pa.array([lang for lang, _ in found], pa.string()), pa.array([score for _, score in found], pa.float64())]

        return step

    return map_batches(docs, ["text"], docs.columns if keep is None else keep, "lang_pred string, score double", work)


def fold(doc_id: str = "doc_id") -> Column:
    """CRC-32 of the id as text, modulo 4; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def learning_texts(docs: DataFrame) -> DataFrame:
    """(lang, text) of rows with both, whose fold is not 2; rows without an id teach nothing."""
    return docs.where((fold() != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
