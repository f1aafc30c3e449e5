"""Humidity operators: hints of water getting in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from soundings.functions.columns import rate_per, round_scaled, seconds_between
from soundings.plans.cells import CELL, DEFAULT_SIZE, LONG, CellSize, RunCells
from soundings.schema import HUMIDITY, RUN, SEQ, TIME


def humidity_clean(df: DataFrame, lo: float = 0.0, hi: float = 100.0) -> DataFrame:
    """Readings a humidity sensor can give; missing and impossible ones are removed."""
    return df.select(TIME, SEQ, RUN, HUMIDITY).where(F.col(HUMIDITY).between(lo, hi))


def humidity_summary(df: DataFrame) -> DataFrame:
    """Lowest, mean and highest humidity per run, and the difference of the extremes."""
    low, high = F.min(HUMIDITY), F.max(HUMIDITY)
    return (
        humidity_clean(df)
        .groupBy(RUN)
        .agg(
            round_scaled(low, 2).alias("min_pct"),
            round_scaled(F.avg(HUMIDITY), 2).alias("avg_pct"),
            round_scaled(high, 2).alias("max_pct"),
            round_scaled(high - low, 2).alias("total_rise_pct"),
        )
    )


def humidity_rapid_rise(
    df: DataFrame, rise_rate: float = 3.0, size: CellSize = DEFAULT_SIZE
) -> DataFrame:
    """Samples that rose by more than ``rise_rate`` percent per minute since the one before."""
    cells = RunCells(humidity_clean(df), counted=df, lookback=1, size=size)
    steps = cells.with_columns(
        lambda w: {
            "_before": F.lag(HUMIDITY).over(w),
            "_before_time": F.lag(TIME).over(w),
        }
    )
    minutes = seconds_between(F.col(TIME), F.col("_before_time")) / F.lit(60.0)
    rate = rate_per(F.col(HUMIDITY) - F.col("_before"), minutes)
    return (
        steps.where(F.col("_before").isNotNull() & F.col("_before_time").isNotNull())
        .select(
            RUN,
            TIME,
            round_scaled(F.col(HUMIDITY), 2).alias(HUMIDITY),
            round_scaled(F.col("_before"), 2).alias("prev_humidity"),
            round_scaled(minutes, 4).alias("dt_minutes"),
            round_scaled(rate, 4).alias("rise_rate_per_min"),
        )
        .where(F.col("rise_rate_per_min") > rise_rate)
    )


def humidity_rolling_elevation(
    df: DataFrame,
    threshold: float = 70.0,
    window: int = 10,
    size: CellSize = DEFAULT_SIZE,
) -> DataFrame:
    """Runs whose mean over a sample and ``window`` before it exceeds the threshold, and how often."""
    cells = RunCells(humidity_clean(df), counted=df, lookback=window, size=size)
    rolling = cells.with_columns(
        lambda w: {"rolling_avg": F.avg(HUMIDITY).over(w.rowsBetween(-window, 0))}
    )
    return (
        rolling.where(F.col("rolling_avg") > threshold)
        .groupBy(RUN)
        .agg(
            F.count(F.lit(1)).alias("samples_elevated"),
            round_scaled(F.max("rolling_avg"), 2).alias("peak_rolling_avg"),
            round_scaled(F.avg("rolling_avg"), 2).alias("mean_rolling_avg"),
        )
    )


def humidity_breach_streaks(
    df: DataFrame,
    threshold: float = 70.0,
    consecutive: int = 3,
    size: CellSize = DEFAULT_SIZE,
) -> DataFrame:
    """Unbroken stretches of at least ``consecutive`` clean samples above the threshold.

    Stretches are found inside cells first. Only the first and last stretch of each cell of a long
    run can go on in a neighbouring cell; those, two rows per cell, are joined up per run.
    """
    cells = RunCells(humidity_clean(df), counted=df, size=size)
    in_short_runs = _stretches(cells, cells.short_rows(), threshold)
    in_long_runs = _stretches(cells, cells.long_rows(), threshold)
    inner = (F.col("_stretch") > 0) & (F.col("_stretch") < F.col("_breaks"))
    return (
        in_short_runs.unionByName(in_long_runs.where(inner))
        .select(RUN, *_STRETCH)
        .unionByName(_joined_up(in_long_runs.where(~inner)))
        .where(F.col("consecutive_samples") >= max(consecutive, 1))
        .select(
            RUN,
            "streak_start",
            "streak_end",
            "consecutive_samples",
            round_scaled(F.col("peak_humidity"), 2).alias("peak_humidity"),
        )
    )


_STRETCH = ("streak_start", "streak_end", "consecutive_samples", "peak_humidity")


def _stretches(cells: RunCells, rows: DataFrame, threshold: float) -> DataFrame:
    """Stretches per cell, numbered by the samples not above the threshold seen so far.

    The last such sample of a cell is kept, so that a cell ending below the threshold still has
    an (empty) last stretch.
    """
    above = F.col(HUMIDITY) > threshold
    break_here = F.when(above, 0).otherwise(1)
    so_far = cells.window().rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def if_above(value: Column) -> Column:
        return F.when(F.col("_above"), value)

    return (
        rows.withColumns(
            {
                "_above": above,
                "_stretch": F.sum(break_here).over(so_far),
                "_breaks": F.sum(break_here).over(cells.whole_cell()),
            }
        )
        .where(F.col("_above") | (F.col(LONG) & (F.col("_stretch") == F.col("_breaks"))))
        .groupBy(RUN, CELL, LONG, "_stretch", "_breaks")
        .agg(
            F.min(if_above(F.col(TIME))).alias("streak_start"),
            F.max(if_above(F.col(TIME))).alias("streak_end"),
            F.count(if_above(F.lit(1))).alias("consecutive_samples"),
            F.max(if_above(round_scaled(F.col(HUMIDITY), 2))).alias("peak_humidity"),
        )
    )


def _joined_up(open_ended: DataFrame) -> DataFrame:
    """Join a cell's last stretch with the first one of the next, across cells without a break."""
    in_order = (
        Window.partitionBy(RUN)
        .orderBy(CELL, "_stretch")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    starts = F.when(F.col("_stretch") > 0, 1).otherwise(0)
    return (
        open_ended.withColumn("_chain", F.sum(starts).over(in_order))
        .groupBy(RUN, "_chain")
        .agg(
            F.min("streak_start").alias("streak_start"),
            F.max("streak_end").alias("streak_end"),
            F.sum("consecutive_samples").alias("consecutive_samples"),
            F.max("peak_humidity").alias("peak_humidity"),
        )
        .select(RUN, *_STRETCH)
    )
