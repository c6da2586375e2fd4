"""Text to vectors for a whole column."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from replyscope.session import bound_batches

DIMENSIONS = 384
BATCH = 256


def fit_encoder(df: DataFrame, text: str, dimensions: int = DIMENSIONS) -> PipelineModel:
    """Hashed TF-IDF encoder: words, hashed counts, inverse document frequency, unit length."""
    stages = [
        RegexTokenizer(inputCol="_text", outputCol="_words", pattern=r"(?U)\w+", gaps=False),
        HashingTF(inputCol="_words", outputCol="_counts", numFeatures=dimensions),
        IDF(inputCol="_counts", outputCol="_weights"),
        Normalizer(inputCol="_weights", outputCol="_unit"),
    ]
    return Pipeline(stages=stages).fit(filled_text(df, text))


def filled_text(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))


def encode(df: DataFrame, text: str, model: PipelineModel, vector: str = "embedding") -> DataFrame:
    """Add the vector of the text as array<float>; null text counts as empty."""
    encoded = model.transform(filled_text(df, text))
    return encoded.withColumn(vector, vector_to_array("_unit", "float32")).drop(
        "_text", "_words", "_counts", "_weights", "_unit"
    )


def encode_with(
    df: DataFrame,
    text: str,
    load: Callable[[], Callable[[list[str]], np.ndarray]],
    vector: str = "embedding",
    batch: int = BATCH,
) -> DataFrame:
    """Add vectors from any model. ``load`` runs once per task and returns texts -> matrix.

    Vectors are normalised to unit length.
    """
    bound_batches(df.sparkSession)

    def run(frames):
        model = load()
        for frame in frames:
            texts = frame[text].fillna("").tolist()
            parts = [np.asarray(model(texts[i : i + batch]), dtype=np.float64) for i in range(0, len(texts), batch)]
            if not parts:
                continue
            values = np.vstack(parts)
            norms = np.linalg.norm(values, axis=1, keepdims=True)
            unit = np.divide(values, norms, out=np.zeros_like(values), where=norms > 0).astype(np.float32)
            yield frame.assign(**{vector: pd.Series(list(unit), index=frame.index)})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{fields}, `{vector}` array<float>")
