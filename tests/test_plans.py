"""Shape of the executed plans: what is shuffled, scanned and broadcast."""

from __future__ import annotations

import re

import pytest

import soundings as s
from soundings.plans.cells import CellSize
from soundings.sources.events import read_events_as_sensor_data

SF_DIR = "/root/testdata/sf0.001"
CUT = CellSize(hot_rows=30, cell_rows=8, marks_per_cell=2)

ROW_LEVEL = [
    s.vertical_rates,
    s.run_phase_segments,
    s.voltage_sag_events,
    s.voltage_sag_step,
    s.accel_zscores,
    s.motion_anomalies,
    s.humidity_rapid_rise,
    s.seq_gaps,
]
PER_RUN = [
    s.energy_per_run,
    s.depth_run_summary,
    s.phase_summary,
    s.motion_zscore_summary,
    s.humidity_rolling_elevation,
]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("samples"))
    s.write_sensor_data(read_events_as_sensor_data(spark, SF_DIR), path)
    return s.read_sensor_data(spark, path)


def _executed(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def _live(plan: str) -> list[str]:
    """Operators of the final plan, without branches adaptive execution emptied."""
    kept, dead_depth = [], None
    for line in plan.splitlines():
        depth = re.search(r"[A-Za-z*]", line)
        depth = depth.start() if depth else 0
        if dead_depth is not None and depth > dead_depth:
            continue
        dead_depth = None
        if "EmptyRelation" in line:
            dead_depth = depth
        kept.append(line)
    return kept


@pytest.mark.parametrize("operator", ROW_LEVEL)
def test_rows_are_shuffled_once_when_no_run_is_long(stored, operator):
    lines = _live(_executed(operator(stored)))
    scans = [line for line in lines if "FileScan" in line]
    assert len(scans) == 1
    assert not any("Join" in line and "EmptyRelation" not in line for line in lines)
    main = [line for line in lines if "Exchange hashpartitioning(run_id" in line]
    assert len(main) == 1


@pytest.mark.parametrize("operator", PER_RUN)
def test_aggregates_are_partial_before_the_second_shuffle(stored, operator):
    plan = _executed(operator(stored))
    assert "partial_" in plan
    assert sum("FileScan" in line for line in _live(plan)) == 1


@pytest.mark.parametrize("operator", ROW_LEVEL + PER_RUN)
def test_cut_runs_are_never_windowed_whole(stored, operator):
    plan = _executed(operator(stored, size=CUT))
    windows = re.findall(r"windowspecdefinition\(([^)]*)", plan)
    assert windows
    # Besides the cells only the marks of long runs are put in order.
    assert all("_cell" in w or "_long_run" in w for w in windows)
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "operator, columns",
    [
        (s.energy_per_run, {"battery_voltage_v", "battery_current_a"}),
        (s.depth_run_summary, {"depth_m"}),
        (s.humidity_rapid_rise, {"humidity_pct"}),
    ],
)
def test_scans_read_only_what_is_needed(stored, operator, columns):
    plan = _executed(operator(stored))
    keys = {"timestamp_utc", "seq", "run_id"}
    schemas = re.findall(r"ReadSchema: struct<([^>\n]*)>", plan)
    assert schemas
    for schema in schemas:
        assert {part.split(":")[0] for part in schema.split(",")} <= keys | columns
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert all(any(f"IsNotNull({c})" in p for p in pushed) for c in columns)


def test_long_runs_are_found_from_the_run_column_alone(stored):
    df = s.energy_per_run(stored)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<run_id:string>" in plan
