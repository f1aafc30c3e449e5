"""The canonical ``sensor_data`` table: one row is one sample of one vehicle run."""

from __future__ import annotations

from pyspark.sql import types as T

RUN = "run_id"
TIME = "timestamp_utc"
SEQ = "seq"
VOLTAGE = "battery_voltage_v"
CURRENT = "battery_current_a"
DEPTH = "depth_m"
HUMIDITY = "humidity_pct"
ACCEL_AXES = ("imu_ax_mps2", "imu_ay_mps2", "imu_az_mps2")

SENSOR_SCHEMA = T.StructType(
    [
        T.StructField(TIME, T.TimestampType()),
        T.StructField(SEQ, T.IntegerType()),
        T.StructField(RUN, T.StringType()),
        T.StructField(VOLTAGE, T.DoubleType()),
        T.StructField(CURRENT, T.DoubleType()),
        T.StructField(DEPTH, T.DoubleType()),
        T.StructField(HUMIDITY, T.DoubleType()),
        *[T.StructField(axis, T.DoubleType()) for axis in ACCEL_AXES],
    ]
)

# Identifier columns looked for, in this order of preference.
DEFAULT_ID_COLUMNS = ("timestamp_utc", "seq", "run_id", "source")
