"""Checks on the row counter and the clock of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundings.plans.cells import BY_SEQ, DEFAULT_SIZE, CellSize, RunCells
from soundings.schema import RUN, SEQ, TIME


def _by_counter(df: DataFrame, size: CellSize) -> DataFrame:
    cells = RunCells(
        df.select(RUN, SEQ, TIME), counted=df, lookback=1, order=BY_SEQ, size=size
    )
    return cells.with_columns(
        lambda w: {"prev_seq": F.lag(SEQ).over(w), "prev_time": F.lag(TIME).over(w)}
    )


def seq_gaps(df: DataFrame, size: CellSize = DEFAULT_SIZE) -> DataFrame:
    """Places where the row counter skips, with the number of rows missing there."""
    skipped = F.col(SEQ) - F.col("prev_seq") - 1
    return (
        _by_counter(df, size)
        .select(RUN, "prev_seq", SEQ, skipped.alias("missing"))
        .where(F.col("missing") > 0)
    )


def timestamp_disorder(df: DataFrame, size: CellSize = DEFAULT_SIZE) -> DataFrame:
    """Samples stamped earlier than the sample before them in counter order."""
    return (
        _by_counter(df, size)
        .where(F.col(TIME) < F.col("prev_time"))
        .select(RUN, SEQ, "prev_time", TIME)
    )
