"""TF-IDF weights and exact sparse nearest neighbours.

Terms are lower-cased words of two or more letters, digits or underscores, and pairs of
adjacent words. The vocabulary keeps terms found in at least two texts and, of those, the most
frequent ones, so it never exceeds ``max_features`` rows and can be broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from replyscope import fixed_values as fixed
from replyscope.functions.text import let
from replyscope.operators.ranking import highest_rows
from replyscope.operators.similarity import QUERY_PART_ROWS, SCALE, part_count, stream_past
from replyscope.session import bound_batches, cut_lineage, tidy

WORD = r"[\p{L}\p{N}_]{2,}"
CORPUS_BLOCK_ROWS = 65_536
QUERY_BLOCK_ROWS = 512
# Similarities are rounded to SCALE, and sums may differ in their last bits
MARGIN = 2.0 / SCALE


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def terms(text: Column) -> Column:
    """Array of words followed by word pairs."""

    def with_pairs(single: Column) -> Column:
        n_pairs = F.greatest(F.size(single) - 1, F.lit(0))
        pairs = F.zip_with(
            F.slice(single, F.lit(1), n_pairs),
            F.slice(single, F.lit(2), n_pairs),
            lambda left, right: F.concat_ws(" ", left, right),
        )
        return F.concat(single, pairs)

    return let(words(text), with_pairs)


def count_terms(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Names of the terms in a batch, and for each term of a row: the row, the place of its name, its count."""
    encoded = lists.flatten().dictionary_encode()
    rows = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    width = max(1, len(encoded.dictionary))
    pairs, tf = np.unique(rows * width + encoded.indices.to_numpy(), return_counts=True)
    return encoded.dictionary, pairs // width, pairs % width, tf


def lists_of(rows: np.ndarray, values: pa.Array, n_rows: int) -> pa.ListArray:
    """One list per row from values that are ordered by row."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n_rows))])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def term_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, tf) of each text, one text per row. Terms are counted inside the row, so no text is shuffled."""
    bound_batches(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, rows, places, tf = count_terms(batch.column(1))
            found = lists_of(rows, names.take(pa.array(places)), batch.num_rows)
            counts = lists_of(rows, pa.array(tf), batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), found, counts], names=[key, "terms", "tf"])

    read = df.select(key, terms(F.col(text)).alias("_terms"))
    fields = StructType([df.schema[key], *StructType.fromDDL("terms array<string>, tf array<bigint>").fields])
    return read.mapInArrow(tidy(count), fields).select(key, F.inline(F.arrays_zip("terms", "tf")).alias("term", "tf"))


@dataclass(frozen=True)
class Vocabulary:
    """``table`` holds (term, term_id, df, idf), at most ``max_features`` rows."""

    table: DataFrame
    n_texts: int
    max_features: int = fixed.MAX_FEATURES


def fit_vocabulary(
    df: DataFrame,
    key: str,
    text: str,
    max_features: int = fixed.MAX_FEATURES,
    min_df: int = fixed.MIN_DOCUMENT_FREQUENCY,
) -> Vocabulary:
    """Terms in enough texts, most frequent first; equal frequencies are ordered by term."""
    n_texts = df.count()
    frequent = cut_lineage(
        term_counts(df, key, text)
        .groupBy("term")
        .agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
        .where(F.col("df") >= min_df)
    )
    numbered = highest_rows(frequent, max_features, "total", "term").withColumn("term_id", F.row_number().over(Window.orderBy(F.desc("total"), "term")) - 1)
    idf = F.log(F.lit(1.0 + n_texts) / (F.lit(1.0) + F.col("df"))) + 1.0
    return Vocabulary(numbered.select("term", "term_id", "df", idf.alias("idf")), n_texts, max_features)


def sparse_texts(df: DataFrame, key: str, text: str, vocabulary: Vocabulary, keep: Iterable[str] = ()) -> DataFrame:
    """(key, keep, terms, weights) of each text: its vocabulary numbers, ascending, and (1 + ln tf) * idf with unit length.

    Nothing is shuffled: the vocabulary has at most ``max_features`` rows and goes to every task. A
    text without a known term gets empty arrays.
    """
    bound_batches(df.sparkSession)
    table = vocabulary.table.select("term", "term_id", "idf").orderBy("term_id").toPandas()
    known, idf = pa.array(table["term"], pa.string()), table["idf"].to_numpy()
    numbers = table["term_id"].to_numpy().astype(np.int32)
    names = [key, *keep]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, rows, places, tf = count_terms(batch.column("_terms"))
            at = pc.fill_null(pc.index_in(found, value_set=known), -1).to_numpy()[places]
            rows, at, tf = rows[at >= 0], at[at >= 0], tf[at >= 0]
            order = np.lexsort((at, rows))
            rows, at, tf = rows[order], at[order], tf[order]
            raw = (np.log(tf) + 1.0) * idf[at]
            weights = raw / np.sqrt(np.bincount(rows, raw * raw, batch.num_rows))[rows]
            kept = [batch.column(name) for name in names]
            lists = [lists_of(rows, pa.array(values), batch.num_rows) for values in (numbers[at], weights)]
            yield pa.RecordBatch.from_arrays([*kept, *lists], names=[*names, "terms", "weights"])

    read = df.select(*names, terms(F.col(text)).alias("_terms"))
    fields = StructType.fromDDL("terms array<int>, weights array<double>").fields
    return read.mapInArrow(tidy(weigh), StructType([*(df.schema[name] for name in names), *fields]))


def tfidf(df: DataFrame, key: str, text: str, vocabulary: Vocabulary) -> DataFrame:
    """(key, term, term_id, weight): the known terms of each text with their weights."""
    rows = sparse_texts(df, key, text, vocabulary)
    each = rows.select(key, F.inline(F.arrays_zip("terms", "weights")).alias("term_id", "weight"))
    names = F.broadcast(vocabulary.table.select("term_id", "term"))
    return each.join(names, "term_id").select(key, "term", "term_id", "weight")


@dataclass(frozen=True)
class Lists:
    """Inverted lists of a block of texts: for each term the texts that have it, ascending, its weights and the largest of them."""

    starts: np.ndarray
    texts: np.ndarray
    weights: np.ndarray
    largest: np.ndarray
    n_texts: int

    @classmethod
    def of(cls, terms_: pa.ListArray, weights: np.ndarray, width: int) -> Lists:
        numbers = terms_.flatten().to_numpy()
        owner = np.repeat(np.arange(len(terms_)), terms_.value_lengths().to_numpy(zero_copy_only=False))
        order = np.argsort(numbers, kind="stable")
        numbers, owner, weights = numbers[order], owner[order], weights[order]
        starts = np.searchsorted(numbers, np.arange(width + 1))
        largest = np.zeros(width)
        used = np.flatnonzero(starts[1:] > starts[:-1])
        if len(used):
            largest[used] = np.maximum.reduceat(weights, starts[used])
        return cls(starts, owner, weights, largest, len(terms_))

    def winner(self, terms_: np.ndarray, weights: np.ndarray, totals: np.ndarray) -> tuple[int, float]:
        """(place, similarity) of the most similar text, the first of equal ones.

        Lists are read from the rarest term on, until no text outside them can reach the best one found; the
        terms left over are looked up only for texts that still can win. ``totals`` is zero work space and is left so.
        """
        sizes = self.starts[terms_ + 1] - self.starts[terms_]
        order = np.argsort(sizes, kind="stable")
        terms_, weights, sizes = terms_[order], weights[order], sizes[order]
        # What all terms from here on can add to a text
        rest = np.append(np.cumsum((weights * self.largest[terms_])[::-1])[::-1], 0.0)
        best, seen, read = 0.0, [], 0
        while read < len(terms_) and rest[read] >= best - MARGIN:
            if sizes[read]:
                span = slice(self.starts[terms_[read]], self.starts[terms_[read] + 1])
                at = self.texts[span]
                totals[at] += weights[read] * self.weights[span]
                best = max(best, totals[at].max())
                seen.append(at)
            read += 1
        if not seen:
            return 0, 0.0
        touched = np.unique(np.concatenate(seen))
        scores = totals[touched]
        totals[touched] = 0.0
        open_ = scores + rest[read] >= best - MARGIN
        touched, scores = touched[open_], scores[open_]
        for term, weight in zip(terms_[read:], weights[read:], strict=True):
            lo, hi = self.starts[term], self.starts[term + 1]
            if hi > lo:
                at = np.minimum(np.searchsorted(self.texts[lo:hi], touched), hi - lo - 1)
                scores += np.where(self.texts[lo:hi][at] == touched, weight * self.weights[lo:hi][at], 0.0)
        scaled = np.rint(scores * SCALE)
        top = int(scaled.argmax())
        return (int(touched[top]), scaled[top] / SCALE) if scaled[top] > 0 else (0, 0.0)


def nearest_text(
    queries: DataFrame,
    corpus: DataFrame,
    query_key: str,
    corpus_key: str,
    width: int = fixed.MAX_FEATURES,
    corpus_block_rows: int = CORPUS_BLOCK_ROWS,
    query_part_rows: int = QUERY_PART_ROWS,
) -> DataFrame:
    """(query_key, corpus_key, similarity): the most similar corpus row of each query.

    Both inputs come from ``sparse_texts``. Exact: a task holds the inverted lists of one block of the corpus, so no
    list is longer than a block, and queries stream past it, each giving one row; equal similarities go
    to the lower id. The corpus is copied once for every ``query_part_rows`` queries. Without a common term
    the similarity is 0 and the row that of the lowest id; an empty corpus gives no rows.
    """
    blocks = max(1, -(-corpus.count() // corpus_block_rows))
    parts = part_count(queries.count(), blocks, corpus.sparkSession.sparkContext.defaultParallelism, query_part_rows)
    left = (
        queries.select(F.col(query_key).alias("_query"), F.col("terms").alias("_terms"), F.col("weights").alias("_weights"))
        .withColumn("_part", F.pmod(F.xxhash64("_query"), F.lit(parts)).cast("int"))
        .withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    )
    right = (
        corpus.select(F.col(corpus_key).alias("_match"), F.col("terms").alias("_terms"), F.col("weights").alias("_weights"))
        .withColumn("_block", F.pmod(F.xxhash64("_match"), F.lit(blocks)).cast("int"))
        .withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    )
    query_type, match_type = left.schema["_query"].dataType, right.schema["_match"].dataType
    out = pa.schema(
        [("_query", to_arrow_type(query_type)), ("_match", to_arrow_type(match_type)), ("similarity", pa.float64())]
    )

    def load(table: pa.Table) -> tuple[pa.ChunkedArray, Lists]:
        table = table.sort_by("_match")
        weights = table.column("_weights").combine_chunks().flatten().to_numpy()
        return table.column("_match"), Lists.of(table.column("_terms").combine_chunks(), weights, width)

    def best(table: pa.Table, block: tuple[pa.ChunkedArray, Lists]) -> pa.Table:
        matches, lists = block
        asked = table.column("_terms").combine_chunks()
        ends = np.cumsum(asked.value_lengths().to_numpy(zero_copy_only=False))
        numbers, weights = asked.flatten().to_numpy(), table.column("_weights").combine_chunks().flatten().to_numpy()
        totals = np.zeros(lists.n_texts)
        found = [lists.winner(numbers[a:b], weights[a:b], totals) for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        places, values = zip(*found, strict=True)
        return pa.Table.from_arrays([table.column("_query"), matches.take(pa.array(places)), pa.array(values, pa.float64())], schema=out)

    kinds = f"_query {query_type.simpleString()}, _match {match_type.simpleString()}, similarity double"
    number = F.col("_block") * parts + F.col("_part")
    found = stream_past(left, right, ["_block", "_part"], number, blocks * parts, load, best, kinds, QUERY_BLOCK_ROWS)
    if blocks > 1:
        order = Window.partitionBy("_query").orderBy(F.desc("similarity"), "_match")
        found = found.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") == 1)
    return found.select(F.col("_query").alias(query_key), F.col("_match").alias(corpus_key), "similarity")


def template_replies(
    queries: DataFrame,
    query_key: str,
    text: str,
    pairs: DataFrame | None,
    vocabulary: Vocabulary | None,
    pair_key: str = "thread_id",
    pair_text: str = "customer_text",
    reply: str = "brand_reply",
) -> DataFrame:
    """(query_key, pair_key, similarity, draft_reply): the reply given to the most similar message.

    Without resolved pairs every query gets the same fixed reply.
    """
    if pairs is None or vocabulary is None:
        return queries.select(query_key, F.lit(fixed.NO_INDEX_REPLY).alias("draft_reply"))
    asked = sparse_texts(queries, query_key, text, vocabulary)
    known = sparse_texts(pairs, pair_key, pair_text, vocabulary)
    match_key = "_pair"
    known = known.withColumnRenamed(pair_key, match_key)
    nearest = nearest_text(asked, known, query_key, match_key, width=vocabulary.max_features)
    answers = pairs.select(F.col(pair_key).alias(match_key), F.col(reply).alias("draft_reply"))
    found = nearest.join(answers, match_key).select(query_key, match_key, "similarity", "draft_reply")
    return found if pair_key == query_key else found.withColumnRenamed(match_key, pair_key)
