"""Toxicity categories by a chain of linear classifiers.

The categories are predicted in a fixed order. The model of a category sees the words of the text
and the probabilities of all earlier categories; while learning, those probabilities come from
models that did not see the row (out-of-fold), so later models meet them as they will be in use.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.llm import fixed_values as fixed
from replyscope.llm.rows import map_batches, stored

FEATURES = 1 << 18


def word_places(raw: bytes) -> np.ndarray:
    """Hashed places of the distinct words of a whole text, A-Z lower-cased."""
    words = set(re.findall(fixed.WORD_BYTES, raw.lower()))
    return np.unique(np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words)) % FEATURES)


class Rows:
    """Texts as sparse rows: word places, and dense columns for earlier probabilities and the constant."""

    def __init__(self, places: list[np.ndarray], dense: np.ndarray):
        self.sizes = np.array([len(row) for row in places])
        self.places = np.concatenate([np.empty(0, np.int64), *places]).astype(np.int64)
        self.owner = np.repeat(np.arange(len(places)), self.sizes)
        self.dense = np.column_stack([dense, np.ones(len(places))])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        words = np.bincount(self.owner, weights[: FEATURES][self.places], len(self.sizes))
        return words + self.dense @ weights[FEATURES:]

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.concatenate([np.bincount(self.places, errors[self.owner], FEATURES), errors @ self.dense])


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(rows: Rows, truth: np.ndarray, penalty: float, iterations: int) -> np.ndarray:
    """Ridge logistic regression by L-BFGS; the constant is not penalised."""
    n = len(truth)
    ridge = np.full(FEATURES + rows.dense.shape[1], penalty)
    ridge[-1] = 0.0

    def value(weights: np.ndarray) -> tuple[float, np.ndarray]:
        margin = rows.dot(weights)
        loss = np.logaddexp(0.0, margin).sum() - margin @ truth
        slope = rows.back(logistic(margin) - truth) / n + ridge * weights
        return loss / n + 0.5 * (ridge * weights) @ weights, slope

    weights = np.zeros(len(ridge))
    now, slope = value(weights)
    history: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(iterations):
        step, kept = slope.copy(), []
        for moved, turned, scale in reversed(history):
            part = scale * (moved @ step)
            kept.append(part)
            step -= part * turned
        if history:
            moved, turned, scale = history[-1]
            step /= scale * (turned @ turned)
        for (moved, turned, scale), part in zip(history, reversed(kept), strict=True):
            step += moved * (part - scale * (turned @ step))
        length, fall = 1.0, slope @ step
        while True:
            tried = weights - length * step
            there, steeper = value(tried)
            if there <= now - 1e-4 * length * fall or length < 1e-8:
                break
            length /= 2
        moved, turned = tried - weights, steeper - slope
        if moved @ turned > 1e-12:
            history = [*history[-7:], (moved, turned, 1.0 / (moved @ turned))]
        done = abs(now - there) < 1e-7 * max(1.0, abs(now))
        weights, now, slope = tried, there, steeper
        if done:
            break
    return weights


def fit_rows(
    places: list[np.ndarray], truth: np.ndarray, folds: np.ndarray, penalty: float, iterations: int
) -> list[np.ndarray]:
    """Weights of each category (columns of ``truth``), later ones learned with out-of-fold probabilities of earlier ones."""
    earlier, models = np.empty((len(places), 0)), []
    for column in range(truth.shape[1]):
        models.append(fit_logistic(Rows(places, earlier), truth[:, column], penalty, iterations))
        outside = np.zeros(len(places))
        for fold in np.unique(folds):
            inside, others = np.flatnonzero(folds == fold), np.flatnonzero(folds != fold)
            model = models[-1]
            if len(others):
                model = fit_logistic(Rows([places[i] for i in others], earlier[others]), truth[others, column], penalty, iterations)
            outside[inside] = logistic(Rows([places[i] for i in inside], earlier[inside]).dot(model))
        earlier = np.column_stack([earlier, outside])
    return models


@dataclass
class Chain:
    """Weights of the categories, in the order in which they are applied."""

    categories: list[str]
    weights: list[np.ndarray]

    def probabilities(self, raw: bytes) -> list[float]:
        places, out = word_places(raw), []
        for weights in self.weights:
            dense = np.array([*out, 1.0])
            out.append(float(logistic(weights[places].sum() + weights[FEATURES:] @ dense)))
        return out


def fit_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: Sequence[str] = ("quality", "toxic"),
    max_rows: int = 12_000,
    folds: int = 3,
    penalty: float = 0.0002,
    iterations: int = 40,
) -> Chain | None:
    """Learn the chain from a sample of at most ``max_rows`` labelled documents, those whose ids hash lowest.

    Rows with a null id or label, and ids that ``labels`` holds with different values, are left out; of
    documents with one id the text whose word places come first counts. None if no labelled document is left. The sample is
    bounded, so one task fits all models; the driver gets their weights.
    """
    categories = list(categories)
    marks = [F.col(name).cast("double").alias(f"_y{number}") for number, name in enumerate(categories)]
    known = labels.select("doc_id", *marks).dropna().distinct()
    values = [F.max(f"_y{number}").alias(f"_y{number}") for number in range(len(categories))]
    single = known.groupBy("doc_id").agg(F.count("*").alias("_n"), *values)
    sample = single.where("_n = 1").drop("_n").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    # At most max_rows rows of numbers, so the broadcast has a proven size
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")

    def work():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            rows = [word_places((text.as_py() or "").encode()) for text in batch.column("text")]
            return [pa.array(rows, pa.list_(pa.int64()))]

        return step

    names = ["doc_id", *(f"_y{number}" for number in range(len(categories)))]
    rows = stored(map_batches(texts, ["text"], names, "places array<bigint>", work), "labelled-words")
    # One row per id before anything meets in one task, whatever share of the table an id holds
    rows = rows.groupBy(*names).agg(F.min("places").alias("places"))
    rows = rows.withColumn("_fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(folds)))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [batch for batch in batches if batch.num_rows]
        if not read:
            return
        table = pa.Table.from_batches(read)
        places = [np.array(row.as_py(), dtype=np.int64) for row in table.column("places")]
        truth = np.column_stack([table.column(f"_y{number}").to_numpy() for number in range(len(categories))])
        models = fit_rows(places, truth, table.column("_fold").to_numpy(), penalty, iterations)
        for number, model in enumerate(models):
            used = np.flatnonzero(model)
            arrays = [pa.array(np.full(len(used), number), pa.int32()), pa.array(used), pa.array(model[used])]
            yield pa.RecordBatch.from_arrays(arrays, names=["category", "place", "weight"])

    together = rows.repartition(1).sortWithinPartitions("doc_id")
    found = together.mapInArrow(fit, "category int, place bigint, weight double").toPandas()
    if found.empty:
        return None
    weights = []
    for number in range(len(categories)):
        model, part = np.zeros(FEATURES + number + 1), found[found["category"] == number]
        model[part["place"].to_numpy()] = part["weight"].to_numpy()
        weights.append(model)
    return Chain(categories, weights)


def classify(docs: DataFrame, chain: Chain | None, categories: Sequence[str] = ("quality", "toxic"), threshold: float = 0.4) -> DataFrame:
    """doc_id and, per category, its probability ``p_<category>`` and whether it reaches the threshold.

    One row per row of ``docs``, whose other columns are not looked at; texts are read whole and not
    shuffled. A null text is judged as an empty one; without a chain (nothing was labelled) all results
    are null; repeated rows repeat and an empty table stays empty.
    """
    categories = list(chain.categories if chain else categories)

    def work():
        def step(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = batch.column("text")
            if chain is None:
                return [pa.nulls(batch.num_rows, pa.float64()) for _ in categories]
            rows = [chain.probabilities((text.as_py() or "").encode()) for text in texts]
            return [pa.array([row[number] for row in rows], pa.float64()) for number in range(len(categories))]

        return step

    fields = ", ".join(f"p_{name} double" for name in categories)
    scored = map_batches(docs.select("doc_id", "text"), ["text"], ["doc_id"], fields, work)
    return scored.select("doc_id", *(c for name in categories for c in (f"p_{name}", (F.col(f"p_{name}") >= threshold).alias(name))))
