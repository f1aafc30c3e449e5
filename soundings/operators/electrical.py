"""Battery operators: energy use and voltage sag under load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundings.functions.columns import all_present, exact_avg, exact_sum, seconds_between
from soundings.plans.cells import DEFAULT_SIZE, CellSize, RunCells
from soundings.schema import CURRENT, RUN, SEQ, TIME, VOLTAGE


def _battery(df: DataFrame, drop_nulls: bool) -> DataFrame:
    battery = df.select(RUN, TIME, SEQ, VOLTAGE, CURRENT)
    return battery.where(all_present(VOLTAGE, CURRENT)) if drop_nulls else battery


def energy_per_run(
    df: DataFrame, drop_nulls: bool = True, size: CellSize = DEFAULT_SIZE
) -> DataFrame:
    """Watt-hours per run: each sample's power held over the time since the sample before it.

    With ``drop_nulls=False`` samples without a power reading still end the preceding interval.
    """
    power = _battery(df, drop_nulls).select(
        RUN, TIME, SEQ, (F.col(VOLTAGE) * F.col(CURRENT)).alias("power_w")
    )
    steps = RunCells(power, counted=df, lookback=1, size=size).with_columns(
        lambda w: {"delta_seconds": seconds_between(F.col(TIME), F.lag(TIME).over(w))}
    )
    joules = exact_sum("power_w * delta_seconds")
    return (
        steps.where(F.col("delta_seconds").isNotNull())
        .groupBy(RUN)
        .agg((joules / 3600.0).alias("energy_wh"))
    )


def voltage_sag_events(
    df: DataFrame,
    window: int = 10,
    dv: float = -0.45,
    di: float = 8.0,
    size: CellSize = DEFAULT_SIZE,
) -> DataFrame:
    """Samples whose voltage drops and current jumps against the mean of the samples before."""

    def baselines(w):
        before = w.rowsBetween(-window, -1)
        return {
            "baseline_voltage_v": F.avg(VOLTAGE).over(before),
            "baseline_current_a": F.avg(CURRENT).over(before),
        }

    cells = RunCells(_battery(df, drop_nulls=True), df, lookback=window, size=size)
    return (
        cells.with_columns(baselines)
        .select(
            RUN,
            TIME,
            SEQ,
            VOLTAGE,
            CURRENT,
            "baseline_voltage_v",
            "baseline_current_a",
            (F.col(VOLTAGE) - F.col("baseline_voltage_v")).alias("delta_voltage"),
            (F.col(CURRENT) - F.col("baseline_current_a")).alias("delta_current"),
        )
        .where((F.col("delta_voltage") <= dv) & (F.col("delta_current") >= di))
    )


def voltage_sag_step(
    df: DataFrame, dv: float = -0.05, di: float = 0.5, size: CellSize = DEFAULT_SIZE
) -> DataFrame:
    """Like :func:`voltage_sag_events`, against the single sample before, missing values included."""
    cells = RunCells(_battery(df, drop_nulls=False), df, lookback=1, size=size)
    return (
        cells.with_columns(
            lambda w: {
                "delta_voltage": F.col(VOLTAGE) - F.lag(VOLTAGE).over(w),
                "delta_current": F.col(CURRENT) - F.lag(CURRENT).over(w),
            }
        )
        .select(RUN, TIME, VOLTAGE, CURRENT, "delta_voltage", "delta_current")
        .where((F.col("delta_voltage") <= dv) & (F.col("delta_current") >= di))
    )


def avg_voltage(df: DataFrame) -> DataFrame:
    """Mean pack voltage over all samples."""
    return df.agg(exact_avg(VOLTAGE).alias("avg_voltage_v"))
