"""The six results as SQL over a table of samples, for views that live in a catalog."""

from __future__ import annotations

from soundings.functions.columns import exact_avg_sql, exact_sum_sql
from soundings.schema import ACCEL_AXES

_ORDER = "PARTITION BY run_id ORDER BY timestamp_utc NULLS LAST, seq NULLS LAST"
_SECONDS = "(unix_micros(timestamp_utc) - lag(unix_micros(timestamp_utc)) OVER run) / 1e6D"
_SAMPLE = "run_id, timestamp_utc, seq"


def results(table: str) -> dict[str, str]:
    """The SQL of each result by name, with the usual thresholds."""
    return {
        "energy_per_run": _energy(table),
        "depth_run_summary": _depth_summary(table),
        "run_phase_segments": _phases(table),
        "voltage_sag_events": _sag(table),
        "motion_anomalies": f"SELECT * FROM ({_scores(table)}) WHERE abs(z_score) >= 3",
        "motion_zscore_summary": _score_summary(table),
    }


def _energy(table: str) -> str:
    return f"""
        SELECT run_id, {exact_sum_sql("power_w * delta_seconds")} / 3600 AS energy_wh
        FROM (SELECT run_id, battery_voltage_v * battery_current_a AS power_w,
                     {_SECONDS} AS delta_seconds
              FROM {table} WHERE battery_voltage_v IS NOT NULL AND battery_current_a IS NOT NULL
              WINDOW run AS ({_ORDER}))
        WHERE delta_seconds IS NOT NULL GROUP BY run_id"""


def _rates(table: str) -> str:
    return f"""
        SELECT {_SAMPLE}, depth_m, delta_seconds, climb / nullif(delta_seconds, 0D) AS vertical_rate_mps
        FROM (SELECT *, {_SECONDS} AS delta_seconds, depth_m - lag(depth_m) OVER run AS climb
              FROM {table} WHERE depth_m IS NOT NULL WINDOW run AS ({_ORDER}))
        WHERE delta_seconds IS NOT NULL"""


def _depth_summary(table: str) -> str:
    return f"""
        SELECT run_id, max(depth_m) AS max_depth_m, {exact_avg_sql("depth_m")} AS avg_depth_m,
               {exact_avg_sql("down")} AS avg_descent_rate_mps,
               {exact_avg_sql("up")} AS avg_ascent_rate_mps,
               {exact_sum_sql("deep")} AS time_at_depth_seconds
        FROM (SELECT run_id, depth_m,
                     if(vertical_rate_mps > 0, vertical_rate_mps, NULL) AS down,
                     if(vertical_rate_mps < 0, vertical_rate_mps, NULL) AS up,
                     if(run_id IS NOT NULL AND depth_m >= 0.9D * max(depth_m) OVER (PARTITION BY run_id),
                        delta_seconds, NULL) AS deep
              FROM ({_rates(table)}))
        GROUP BY run_id"""


def _phases(table: str) -> str:
    return f"""
        SELECT *, CASE WHEN depth_m <= 0.25D THEN 'surface'
                       WHEN vertical_rate_mps >= 0.03D THEN 'descending'
                       WHEN vertical_rate_mps <= -0.03D THEN 'ascending'
                       ELSE 'holding_depth' END AS phase
        FROM ({_rates(table)})"""


def _sag(table: str) -> str:
    return f"""
        SELECT * FROM (
            SELECT {_SAMPLE}, battery_voltage_v, battery_current_a, baseline_voltage_v, baseline_current_a,
                   battery_voltage_v - baseline_voltage_v AS delta_voltage,
                   battery_current_a - baseline_current_a AS delta_current
            FROM (SELECT *, avg(battery_voltage_v) OVER before AS baseline_voltage_v,
                         avg(battery_current_a) OVER before AS baseline_current_a
                  FROM {table} WHERE battery_voltage_v IS NOT NULL AND battery_current_a IS NOT NULL
                  WINDOW before AS ({_ORDER} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)))
        WHERE delta_voltage <= -0.45D AND delta_current >= 8"""


def _scores(table: str) -> str:
    x, y, z = ACCEL_AXES
    return f"""
        SELECT {_SAMPLE}, accel_mag, rolling_mean, rolling_std,
               if(rolling_std > 0, (accel_mag - rolling_mean) / rolling_std, 0D) AS z_score
        FROM (SELECT *, avg(accel_mag) OVER recent AS rolling_mean,
                     stddev_samp(accel_mag) OVER recent AS rolling_std
              FROM (SELECT {_SAMPLE}, sqrt({x} * {x} + {y} * {y} + {z} * {z}) AS accel_mag
                    FROM {table} WHERE {x} IS NOT NULL AND {y} IS NOT NULL AND {z} IS NOT NULL)
              WINDOW recent AS ({_ORDER} ROWS BETWEEN 10 PRECEDING AND CURRENT ROW))"""


def _score_summary(table: str) -> str:
    return f"""
        SELECT run_id, count(*) AS rows_seen, max(abs(z_score)) AS max_abs_z_score,
               {exact_avg_sql("abs(z_score)")} AS avg_abs_z_score,
               percentile_approx(abs(z_score), 0.95, 10000) AS p95_abs_z_score,
               percentile_approx(abs(z_score), 0.99, 10000) AS p99_abs_z_score
        FROM ({_scores(table)}) GROUP BY run_id"""
