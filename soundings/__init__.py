"""Vehicle telemetry analytics on Spark DataFrames."""

from soundings.operators.common import (
    event_counts,
    filter_run,
    in_run_order,
    preview,
    row_count,
)
from soundings.operators.depth import (
    depth_run_summary,
    max_depth,
    phase_summary,
    run_phase_segments,
    vertical_rates,
)
from soundings.operators.dive_plan import dive_plan_profile
from soundings.operators.electrical import (
    avg_voltage,
    energy_per_run,
    voltage_sag_events,
    voltage_sag_step,
)
from soundings.operators.humidity import (
    humidity_breach_streaks,
    humidity_clean,
    humidity_rapid_rise,
    humidity_rolling_elevation,
    humidity_summary,
)
from soundings.operators.motion import (
    accel_zscores,
    motion_anomalies,
    motion_zscore_summary,
)
from soundings.operators.quality import seq_gaps, timestamp_disorder
from soundings.plans.cells import CellSize
from soundings.sources.catalog import create_sensor_table, publish_sensor_data, register_views
from soundings.sources.csv import (
    convert_csv_raw,
    drop_all_null_rows,
    ingest_csv,
    parse_time_columns,
    read_sensor_csv,
)
from soundings.sources.split import (
    split_by_column,
    split_by_groups,
    split_by_keywords,
    split_csv,
)
from soundings.sources.tables import read_sensor_data, write_sensor_data
from soundings.streaming.detect import detect_events, read_events
from soundings.streaming.refresh import read_output, read_samples, refresh_outputs

__all__ = [name for name in dir() if not name.startswith("_")]
