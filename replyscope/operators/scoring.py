"""Batched scoring with a function of the caller."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame

from replyscope.session import bound_batches


def score_batches(
    df: DataFrame,
    key: str,
    inputs: str | Sequence[str],
    load: Callable[[], Callable[[list], list]],
    result: str,
    result_type: str,
    *,
    batch_size: int = 64,
    attempts: int = 3,
    default=None,
) -> DataFrame:
    """(key, result): the function applied to the inputs in batches, one result per row.

    ``load`` runs once per task and returns a function from a list of inputs to a list of
    results in the same order; with several input columns an input is a dict. A batch that
    still fails after ``attempts`` calls gets the default for each of its rows. Rows are spread
    over tasks as they come, so batches form inside partitions and nothing is shuffled.
    """
    bound_batches(df.sparkSession)
    names = [inputs] if isinstance(inputs, str) else list(inputs)

    def results(function, values: list) -> list:
        for _ in range(attempts):
            try:
                answer = list(function(values))
            except Exception:
                continue
            if len(answer) == len(values):
                return answer
        return [default] * len(values)

    def run(frames):
        function = load()
        for frame in frames:
            values = frame[names[0]].tolist() if isinstance(inputs, str) else frame[names].to_dict("records")
            scored = []
            for start in range(0, len(values), batch_size):
                scored.extend(results(function, values[start : start + batch_size]))
            yield pd.DataFrame({key: frame[key], result: pd.Series(scored, index=frame.index, dtype=object)})

    key_type = df.schema[key].dataType.simpleString()
    return df.select(key, *names).mapInPandas(run, f"`{key}` {key_type}, `{result}` {result_type}")
