"""Small hand-made telemetry frames."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from soundings.schema import SENSOR_SCHEMA

START = datetime(2026, 2, 5, 16, 21, tzinfo=timezone.utc)
_NAMES = [f.name for f in SENSOR_SCHEMA]


def at(seconds):
    return None if seconds is None else START + timedelta(seconds=seconds)


def seconds(stamp):
    """Inverse of ``at`` for collected (zone-less, UTC) values."""
    return (stamp - START.replace(tzinfo=None)).total_seconds()


def samples(spark, **runs):
    """One list of per-sample dicts per run; ``t`` is in seconds, ``seq`` counts by default."""
    rows = []
    for run_id, readings in runs.items():
        for number, reading in enumerate(readings):
            row = {"run_id": run_id, "seq": number, **reading}
            row["timestamp_utc"] = at(row.pop("t"))
            rows.append(tuple(row.get(name) for name in _NAMES))
    return spark.createDataFrame(rows, SENSOR_SCHEMA)


def battery(t, v, i):
    return {"t": t, "battery_voltage_v": v, "battery_current_a": i}


def depth(t, d):
    return {"t": t, "depth_m": d}


def humid(t, h):
    return {"t": t, "humidity_pct": h}


def accel(t, az):
    return {"t": t, "imu_ax_mps2": 0.0, "imu_ay_mps2": 0.0, "imu_az_mps2": az}
