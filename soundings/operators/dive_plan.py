"""Expected depth over time of a planned dive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from soundings.schema import DEPTH, RUN

_TICKS_PER_PIECE = 36_000


def dive_plan_profile(
    plan: DataFrame, speed_mps: float = 0.117, hz: int = 10
) -> DataFrame:
    """Depth at every tick of a plan ``(run_id, step, target_depth_m, hold_s)``.

    Each step is a stretch of travel at constant speed and a stretch of holding. A stretch makes
    its own ticks, so no join of ticks and stretches is needed. Long stretches are first cut into
    pieces, which are spread over the cluster before they grow.
    """
    stretches = _stretches(plan, speed_mps)
    first = F.floor(F.col("start_s") * hz) - 1
    last = F.ceil(F.col("end_s") * hz) + 1
    pieces = stretches.withColumns(
        {
            "_last": last,
            "_from": F.explode(F.sequence(first, last, F.lit(_TICKS_PER_PIECE))),
        }
    ).repartition(RUN, "step", "_from")
    piece_end = F.least(
        F.col("_from") + F.lit(_TICKS_PER_PIECE - 1), F.col("_last")
    )
    second = F.col("_tick") / F.lit(float(hz))
    ticks = (
        pieces.withColumn("_tick", F.explode(F.sequence(F.col("_from"), piece_end)))
        .withColumn("t_s", second)
        .where(
            (F.col("t_s") >= F.col("start_s"))
            & (F.col("t_s") < F.col("end_s"))
            & (F.col("_tick") < F.rint(F.col("total_s") * hz))
        )
    )
    travelled = (F.col("t_s") - F.col("start_s")) / (F.col("end_s") - F.col("start_s"))
    depth = F.col("from_m") + travelled * (F.col("to_m") - F.col("from_m"))
    return ticks.select(RUN, "t_s", F.greatest(depth, F.lit(0.0)).alias(DEPTH))


def _stretches(plan: DataFrame, speed_mps: float) -> DataFrame:
    """Two rows per step, travel then hold, with start and end on the run's time axis."""
    by_step = Window.partitionBy(RUN).orderBy("step")
    target = F.col("target_depth_m")
    previous = F.coalesce(F.lag("target_depth_m").over(by_step), target)
    travel = F.struct(
        F.lit(0).alias("leg"),
        F.col("from_m"),
        target.alias("to_m"),
        (F.abs(target - F.col("from_m")) / F.lit(speed_mps)).alias("length_s"),
    )
    hold = F.struct(
        F.lit(1).alias("leg"),
        target.alias("from_m"),
        target.alias("to_m"),
        F.col("hold_s").cast("double").alias("length_s"),
    )
    in_order = Window.partitionBy(RUN).orderBy("step", "leg")
    up_to_here = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        plan.withColumn("from_m", previous)
        .select(RUN, "step", F.inline(F.array(travel, hold)))
        .withColumn("end_s", F.sum("length_s").over(up_to_here))
        .withColumns(
            {
                "start_s": F.coalesce(F.lag("end_s").over(in_order), F.lit(0.0)),
                "total_s": F.max("end_s").over(Window.partitionBy(RUN)),
            }
        )
    )
