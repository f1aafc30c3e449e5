"""Motion operators: rolling z-score of the acceleration magnitude."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundings.functions.columns import accel_magnitude, all_present, exact_avg
from soundings.plans.cells import DEFAULT_SIZE, CellSize, RunCells
from soundings.plans.selection import exact_percentiles
from soundings.schema import ACCEL_AXES, RUN, SEQ, TIME


def accel_zscores(
    df: DataFrame,
    window: int = 10,
    drop_nulls: bool = True,
    size: CellSize = DEFAULT_SIZE,
) -> DataFrame:
    """Acceleration magnitude against mean and deviation of itself and ``window`` samples before."""
    samples = df.where(all_present(*ACCEL_AXES)) if drop_nulls else df
    magnitudes = samples.select(RUN, TIME, SEQ, accel_magnitude().alias("accel_mag"))

    def rolling(w):
        frame = w.rowsBetween(-window, 0)
        return {
            "rolling_mean": F.avg("accel_mag").over(frame),
            "rolling_std": F.stddev_samp("accel_mag").over(frame),
        }

    deviation = F.col("accel_mag") - F.col("rolling_mean")
    z_score = F.when(
        F.col("rolling_std") > 0, deviation / F.col("rolling_std")
    ).otherwise(F.lit(0.0))
    return (
        RunCells(magnitudes, counted=df, lookback=window, size=size)
        .with_columns(rolling)
        .select(
            RUN,
            TIME,
            SEQ,
            "accel_mag",
            "rolling_mean",
            "rolling_std",
            z_score.alias("z_score"),
        )
    )


def motion_anomalies(
    df: DataFrame,
    z: float = 3.0,
    window: int = 10,
    drop_nulls: bool = True,
    size: CellSize = DEFAULT_SIZE,
) -> DataFrame:
    """Samples at least ``z`` deviations from the rolling mean."""
    scores = accel_zscores(df, window, drop_nulls, size)
    return scores.where(F.abs("z_score") >= z)


def motion_zscore_summary(
    df: DataFrame,
    window: int = 10,
    accuracy: int = 10_000,
    size: CellSize = DEFAULT_SIZE,
    exact: bool = False,
) -> DataFrame:
    """Absolute z-scores per run. The percentiles are sketches, merged after partial aggregation.

    With ``exact`` they are the smallest scores that the wanted share of a run does not exceed, found by
    :func:`soundings.plans.selection.exact_percentiles`: four more passes, and no run in one task.
    """
    abs_z = F.abs("z_score")
    scores = accel_zscores(df, window, size=size)
    counted = [
        F.count(F.lit(1)).alias("rows_seen"),
        F.max(abs_z).alias("max_abs_z_score"),
        exact_avg("abs(z_score)").alias("avg_abs_z_score"),
    ]
    if exact:
        wanted = {"p95_abs_z_score": 0.95, "p99_abs_z_score": 0.99}
        tails = exact_percentiles(scores, "abs(z_score)", wanted).withColumnRenamed(RUN, "_run")
        summary = scores.groupBy(RUN).agg(*counted)
        return summary.join(tails, F.col(RUN).eqNullSafe(F.col("_run")), "left").drop("_run")
    tail = F.percentile_approx(abs_z, [0.95, 0.99], accuracy).alias("_tail")
    return (
        scores.groupBy(RUN)
        .agg(*counted, tail)
        .select(
            RUN,
            "rows_seen",
            "max_abs_z_score",
            "avg_abs_z_score",
            F.get("_tail", F.lit(0)).alias("p95_abs_z_score"),
            F.get("_tail", F.lit(1)).alias("p99_abs_z_score"),
        )
    )
