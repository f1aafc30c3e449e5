"""Operators on any telemetry frame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from soundings.schema import RUN, SEQ, TIME


def event_counts(events: DataFrame, name: str) -> DataFrame:
    """Events per run under the column ``name``; runs without events, and events without run, are absent."""
    return (
        events.where(F.col(RUN).isNotNull())
        .groupBy(RUN)
        .agg(F.count(F.lit(1)).alias(name))
    )


def filter_run(df: DataFrame, run_id: str) -> DataFrame:
    """Rows of one run. Prunes directories if the table is partitioned by run."""
    return df.where(F.col(RUN) == run_id)


def preview(df: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows by run, time and counter."""
    return in_run_order(df).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def in_run_order(df: DataFrame) -> DataFrame:
    """Sort for display by whichever of run, time and counter the frame has."""
    keys = [c for c in (RUN, TIME, SEQ) if c in df.columns]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in keys])
