"""Language of a text from character trigram profiles.

A trigram is kept as one whole number, 21 bits for each code point, which sorts like its text.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from replyscope.session import bound_batches

BITS = 21
CHUNK_CHARACTERS = 1 << 20


def trigrams(text: str) -> np.ndarray:
    """All character trigrams of the lower-cased text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    if len(points) < 3:
        return np.zeros(0, dtype=np.int64)
    return (points[:-2] << (2 * BITS)) | (points[1:-1] << BITS) | points[2:]


def language_profiles(df: DataFrame, text: str, language: str, size: int = 1000) -> DataFrame:
    """(lang, gram, log_p, total): the most frequent trigrams of each language, smoothed log shares.

    Trigrams are counted inside the batches of a task, so no row per character is made. A
    profile holds at most ``size`` trigrams: the model has languages x size rows.
    """
    bound_batches(df.sparkSession)

    def count(frames):
        for frame in frames:
            for lang, texts in frame.groupby("lang")["text"]:
                pending, length = [], 0
                for grams in map(trigrams, texts):
                    pending.append(grams)
                    length += len(grams)
                    if length >= CHUNK_CHARACTERS:
                        yield counted(lang, pending)
                        pending, length = [], 0
                if length:
                    yield counted(lang, pending)

    def counted(lang: str, pending: list[np.ndarray]) -> pd.DataFrame:
        grams, numbers = np.unique(np.concatenate(pending), return_counts=True)
        return pd.DataFrame({"lang": lang, "gram": grams, "n": numbers})

    known = df.select(F.col(language).alias("lang"), F.col(text).alias("text")).dropna()
    counts = (
        known.mapInPandas(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    )
    frequent = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("_rank", F.row_number().over(frequent)).where(F.col("_rank") <= size).drop("_rank")
    total = F.sum("n").over(Window.partitionBy("lang"))
    return top.select("lang", "gram", F.log((F.col("n") + 1.0) / (total + size)).alias("log_p"), total.alias("total"))


def language_detector(profiles: DataFrame, size: int = 1000):
    """A vectorised function from text to language; null where no trigram is known.

    Only the profiles come to the driver: languages x size rows.
    """
    bound_batches(profiles.sparkSession)
    model = profiles.orderBy("lang", "gram").toPandas()
    languages = sorted(model["lang"].unique())
    grams = np.unique(model["gram"].to_numpy())
    totals = model.groupby("lang")["total"].first()
    floor = np.array([math.log(1.0 / (totals[lang] + size)) for lang in languages])
    scores = np.tile(floor, (len(grams) + 1, 1))
    scores[np.searchsorted(grams, model["gram"]), model["lang"].map(languages.index)] = model["log_p"]
    unknown = len(grams)

    def language(text: str) -> str | None:
        found = trigrams(text)
        at = np.searchsorted(grams, found)
        at = np.where(grams[np.minimum(at, unknown - 1)] == found, np.minimum(at, unknown - 1), unknown)
        if (at == unknown).all():
            return None
        times = np.bincount(at, minlength=unknown + 1)
        return languages[int(np.argmax(times @ scores))]

    @F.pandas_udf(StringType())
    def detect(texts: pd.Series) -> pd.Series:
        return texts.map(language, na_action="ignore")

    # Keeps the optimizer from running it a second time below a filter on its result
    return detect.asNondeterministic()


def keep_language(df: DataFrame, detected: str, wanted: str = "en") -> DataFrame:
    """Rows in the wanted language; rows whose language is unknown are kept."""
    return df.where(F.coalesce(F.col(detected), F.lit(wanted)) == wanted)
