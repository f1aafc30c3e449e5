"""Depth operators: vertical rates, dive summary and dive phases."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundings.functions.columns import exact_avg, exact_sum, rate_per, seconds_between
from soundings.plans.cells import DEFAULT_SIZE, CellSize, RunCells
from soundings.schema import CURRENT, DEPTH, RUN, SEQ, TIME, VOLTAGE

_RATE_COLUMNS = (RUN, TIME, SEQ, DEPTH, "delta_seconds", "vertical_rate_mps")


def _depth_cells(
    df: DataFrame, drop_nulls: bool, size: CellSize, carried: tuple[str, ...] = ()
) -> RunCells:
    samples = df.select(RUN, TIME, SEQ, DEPTH, *carried)
    if drop_nulls:
        samples = samples.where(F.col(DEPTH).isNotNull())
    return RunCells(samples, counted=df, lookback=1, size=size)


def _rates(cells: RunCells, runs: str = "all") -> DataFrame:
    steps = cells.with_columns(
        lambda w: {
            "_prev_depth": F.lag(DEPTH).over(w),
            "_prev_time": F.lag(TIME).over(w),
        },
        runs,
    )
    elapsed = seconds_between(F.col(TIME), F.col("_prev_time"))
    change = F.col(DEPTH) - F.col("_prev_depth")
    return (
        steps.where(F.col("_prev_time").isNotNull())
        .withColumns(
            {
                "delta_seconds": elapsed,
                "vertical_rate_mps": rate_per(change, elapsed),
            }
        )
        .drop("_prev_depth", "_prev_time")
    )


def vertical_rates(
    df: DataFrame, drop_nulls: bool = True, size: CellSize = DEFAULT_SIZE
) -> DataFrame:
    """Time step and depth change per second; a run's first sample has neither and is left out."""
    return _rates(_depth_cells(df, drop_nulls, size)).select(*_RATE_COLUMNS)


def depth_run_summary(
    df: DataFrame,
    bottom_fraction: float = 0.9,
    drop_nulls: bool = True,
    size: CellSize = DEFAULT_SIZE,
) -> DataFrame:
    """Depth statistics per run and the seconds spent at ``bottom_fraction`` of the deepest sample.

    The deepest sample of an ordinary run comes from a window over its only cell. A long run has
    several cells, so its maximum is aggregated first, from the same shuffled rows; one row per
    long run is broadcast.
    """
    cells = _depth_cells(df, drop_nulls, size)
    short = _rates(cells, "short").withColumn(
        "_deepest", F.max(DEPTH).over(cells.whole_cell())
    )
    long = _rates(cells, "long")
    maxima = long.groupBy(F.col(RUN).alias("_run")).agg(F.max(DEPTH).alias("_deepest"))
    long = long.join(F.broadcast(maxima), F.col(RUN).eqNullSafe(F.col("_run"))).drop("_run")
    rates = short.unionByName(long)
    # A sample without run id equals no run, hence has no maximum to compare with.
    at_bottom = f"{RUN} IS NOT NULL AND {DEPTH} >= {bottom_fraction!r}D * _deepest"
    readings = rates.selectExpr(
        RUN,
        DEPTH,
        "if(vertical_rate_mps > 0, vertical_rate_mps, NULL) AS _descent",
        "if(vertical_rate_mps < 0, vertical_rate_mps, NULL) AS _ascent",
        f"if({at_bottom}, delta_seconds, NULL) AS _at_bottom",
    )
    return readings.groupBy(RUN).agg(
        F.max(DEPTH).alias("max_depth_m"),
        exact_avg(DEPTH).alias("avg_depth_m"),
        exact_avg("_descent").alias("avg_descent_rate_mps"),
        exact_avg("_ascent").alias("avg_ascent_rate_mps"),
        exact_sum("_at_bottom").alias("time_at_depth_seconds"),
    )


def _phase(surface_m: float, rate_mps: float):
    rate = F.col("vertical_rate_mps")
    return (
        F.when(F.col(DEPTH) <= surface_m, "surface")
        .when(rate >= rate_mps, "descending")
        .when(rate <= -rate_mps, "ascending")
        .otherwise("holding_depth")
    )


def run_phase_segments(
    df: DataFrame,
    surface_m: float = 0.25,
    rate_mps: float = 0.03,
    size: CellSize = DEFAULT_SIZE,
) -> DataFrame:
    """Every sample of :func:`vertical_rates` with its dive phase."""
    return vertical_rates(df, size=size).withColumn(
        "phase", _phase(surface_m, rate_mps)
    )


def phase_summary(
    df: DataFrame,
    surface_m: float = 0.25,
    rate_mps: float = 0.03,
    size: CellSize = DEFAULT_SIZE,
) -> DataFrame:
    """Samples, seconds, mean current and voltage, and energy per run and dive phase.

    The battery columns travel with the depth samples, so no join back to the table is needed.
    """
    cells = _depth_cells(df, True, size, carried=(VOLTAGE, CURRENT))
    return (
        _rates(cells)
        .groupBy(RUN, _phase(surface_m, rate_mps).alias("phase"))
        .agg(
            F.count(F.lit(1)).alias("rows_seen"),
            exact_sum("delta_seconds").alias("phase_seconds"),
            exact_avg(CURRENT).alias("avg_current_a"),
            exact_avg(VOLTAGE).alias("avg_voltage_v"),
            (exact_sum(f"{VOLTAGE} * {CURRENT} * delta_seconds") / 3600.0).alias("energy_wh"),
        )
    )


def max_depth(df: DataFrame) -> DataFrame:
    """Deepest sample of all runs."""
    return df.agg(F.max(DEPTH).alias("max_depth_m"))
