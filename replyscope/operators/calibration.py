"""Calibration of confidences and choice of a threshold, each in one pass over the rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from replyscope import fixed_values as fixed


def steps_reached(value: Column, limits: list[float]) -> Column:
    """How many of the ascending limits are at or below the value."""
    return sum(((value >= F.lit(limit)).cast("int") for limit in limits[1:]), (value >= F.lit(limits[0])).cast("int"))


def calibration_bins(
    df: DataFrame, confidence: str, correct: str, bins: int = fixed.CALIBRATION_BINS
) -> DataFrame:
    """(bin, n, mean_confidence, accuracy) of the equal bins on [0, 1) that hold rows.

    A confidence of exactly 1 falls in no bin.
    """
    edges = [float(edge) for edge in np.linspace(0, 1, bins + 1)]
    value = F.col(confidence).cast("double")
    return (
        df.withColumn("bin", steps_reached(value, edges) - 1)
        .where(F.col("bin").between(0, bins - 1))
        .groupBy("bin")
        .agg(
            F.count("*").alias("n"),
            F.avg(value).alias("mean_confidence"),
            F.avg(F.col(correct).cast("double")).alias("accuracy"),
        )
    )


def expected_calibration_error(
    df: DataFrame, confidence: str, correct: str, bins: int = fixed.CALIBRATION_BINS
) -> DataFrame:
    """Expected calibration error to four decimals; rows in no bin count in the denominator."""
    edges = [float(edge) for edge in np.linspace(0, 1, bins + 1)]
    value = F.col(confidence).cast("double")
    place = steps_reached(value, edges) - 1
    parts = df.groupBy(F.when(place.between(0, bins - 1), place).alias("bin")).agg(
        F.count("*").alias("n"), F.avg(value).alias("conf"), F.avg(F.col(correct).cast("double")).alias("acc")
    )
    gap = F.when(F.col("bin").isNotNull(), F.col("n") * F.abs(F.col("acc") - F.col("conf")))
    return parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.bround(F.coalesce(F.try_divide(F.sum(gap), F.sum("n")), F.lit(0.0)), 4).alias("ece"),
    )


def threshold_sweep(df: DataFrame, confidence: str, correct: str) -> DataFrame:
    """(step, threshold, n_kept, n_right, precision, coverage) for the 20 thresholds.

    Rows are counted once per highest threshold they reach, then summed from the top.
    """
    limits = [fixed.THRESHOLD_START + i * fixed.THRESHOLD_STEP for i in range(fixed.THRESHOLD_STEPS)]
    reached = df.groupBy((steps_reached(F.col(confidence).cast("double"), limits) - 1).alias("step")).agg(
        F.count("*").alias("_n"), F.sum(F.col(correct).cast("long")).alias("_right")
    )
    grid = df.sparkSession.createDataFrame(list(enumerate([float("-inf"), *limits], start=-1)), "step int, threshold double")
    above = Window.orderBy(F.desc("step"))
    return (
        grid.join(reached, "step", "left")
        .fillna(0, ["_n", "_right"])
        .select(
            "step",
            "threshold",
            F.sum("_n").over(above).alias("n_kept"),
            F.sum("_right").over(above).alias("n_right"),
            F.sum("_n").over(Window.partitionBy()).alias("_all"),
        )
        .where(F.col("step") >= 0)
        .select(
            "step",
            "threshold",
            "n_kept",
            "n_right",
            F.try_divide(F.col("n_right").cast("double"), F.col("n_kept")).alias("precision"),
            F.try_divide(F.col("n_kept").cast("double"), F.col("_all")).alias("coverage"),
        )
    )


def best_threshold(
    df: DataFrame, confidence: str, correct: str, target: float = fixed.TARGET_PRECISION
) -> DataFrame:
    """The highest threshold whose kept rows reach the target precision, else 0.9."""
    good = F.col("precision") >= target
    return threshold_sweep(df, confidence, correct).agg(
        F.coalesce(F.max(F.when(good, F.col("threshold"))), F.lit(fixed.FALLBACK_THRESHOLD)).alias("threshold"),
        F.max_by(F.when(good, F.col("precision")), F.when(good, F.col("step"))).alias("precision"),
        F.max_by(F.when(good, F.col("coverage")), F.when(good, F.col("step"))).alias("coverage"),
    )
