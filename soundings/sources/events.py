"""``sensor_data`` derived from a generic table of valued events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the mapping: first sample at 2026-02-05 16:21:00 UTC, ten samples a second.
START_MS = 1_770_308_460_000
STEP_MS = 100


def sensor_data_from_events(events: DataFrame, late_every: int = 0) -> DataFrame:
    """One sample per event; each event type leaves one group of channels empty.

    With ``late_every=n`` the clock of every n-th sample is ten minutes behind.
    """
    kind, value, number = F.col("event_type"), F.col("value"), F.col("event_id")
    current = F.lit(2.5) + value / F.lit(10.0)
    spike = F.when(value > 150, value).otherwise(F.lit(0.0))
    millis = F.lit(START_MS) + number * F.lit(STEP_MS)
    if late_every:
        millis = millis - F.when(number % late_every == 0, 600_000).otherwise(0)

    def unless(missing_for: str, reading):
        return F.when(kind != missing_for, reading)

    return events.select(
        F.timestamp_millis(millis).alias("timestamp_utc"),
        number.cast("int").alias("seq"),
        F.concat(F.lit("run"), F.col("user_id").cast("string")).alias("run_id"),
        unless("signup", F.lit(16.0) - F.lit(0.06) * current).alias(
            "battery_voltage_v"
        ),
        unless("signup", current).alias("battery_current_a"),
        unless("view", value / F.lit(20.0)).alias("depth_m"),
        unless("purchase", F.lit(45.0) + value / F.lit(2.0)).alias("humidity_pct"),
        unless("error", F.lit(0.01) * (number % 3)).alias("imu_ax_mps2"),
        unless("error", F.lit(0.0)).alias("imu_ay_mps2"),
        unless("error", F.lit(9.81) + spike).alias("imu_az_mps2"),
    )


def read_events_as_sensor_data(
    spark: SparkSession, sf_dir: str, late_every: int = 0
) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return sensor_data_from_events(events, late_every)
