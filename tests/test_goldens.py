"""Hand-computed results on hand-made runs."""

from __future__ import annotations

import pytest
from frames import accel, battery, depth, humid, samples, seconds

import soundings as s
from soundings.plans.cells import CellSize

# Results must not depend on how runs are cut: not at all, or after about every second row.
SIZES = [CellSize(), CellSize(hot_rows=1, cell_rows=2, marks_per_cell=1)]


@pytest.fixture(params=SIZES, ids=["whole", "cut"])
def size(request):
    return request.param


def test_energy_drops_samples_without_power_before_the_time_step(spark, size):
    df = samples(
        spark,
        A=[
            battery(0, 10.0, 1.0),
            battery(1, 10.0, 2.0),
            battery(2, None, 5.0),
            battery(3, 10.0, 3.0),
        ],
        B=[battery(0, 10.0, 1.0)],
    )
    (row,) = s.energy_per_run(df, size=size).collect()
    assert (row.run_id, row.energy_wh) == ("A", pytest.approx(80 / 3600))
    (row,) = s.energy_per_run(df, drop_nulls=False, size=size).collect()
    assert row.energy_wh == pytest.approx(50 / 3600)


def test_dive_summary_leaves_out_the_first_sample(spark, size):
    df = samples(spark, A=[depth(t, d) for t, d in enumerate([9.0, 0.0, 2.0, 2.0, 1.0])])
    (row,) = s.depth_run_summary(df, size=size).collect()
    assert tuple(row) == ("A", 2.0, 1.25, 2.0, -5.0, 2.0)


def test_dive_summary_above_water_has_no_bottom_time(spark, size):
    df = samples(spark, A=[depth(t, d) for t, d in enumerate([-3.0, -2.0, -2.0])])
    (row,) = s.depth_run_summary(df, size=size).collect()
    assert (row.max_depth_m, row.time_at_depth_seconds) == (-2.0, None)


def test_samples_without_run_have_no_bottom_time(spark, size):
    readings = [depth(t, d) | {"run_id": None} for t, d in enumerate([1.0, 2.0, 3.0])]
    (row,) = s.depth_run_summary(samples(spark, A=readings), size=size).collect()
    assert (row.run_id, row.max_depth_m, row.time_at_depth_seconds) == (None, 3.0, None)


def test_phases(spark, size):
    readings = [(0, 0.0), (1, 0.2), (2, 0.25), (3, 1.0), (4, 1.01), (5, 0.5), (5, 0.8), (6, 0.1)]
    df = samples(spark, A=[depth(t, d) for t, d in readings])
    rows = s.in_run_order(s.run_phase_segments(df, size=size)).collect()
    assert [(r.seq, r.phase) for r in rows] == [
        (1, "surface"),
        (2, "surface"),
        (3, "descending"),
        (4, "holding_depth"),
        (5, "ascending"),
        (6, "holding_depth"),
        (7, "surface"),
    ]
    assert rows[5].vertical_rate_mps is None


def test_phase_seconds_add_up_to_the_time_steps(spark, size):
    df = samples(spark, A=[depth(t * 0.5, abs(5.0 - t)) for t in range(12)])
    phases = s.phase_summary(df, size=size).collect()
    steps = s.vertical_rates(df, size=size).collect()
    assert sum(p.phase_seconds for p in phases) == pytest.approx(
        sum(r.delta_seconds for r in steps)
    )
    assert sum(p.rows_seen for p in phases) == len(steps) == 11


def test_voltage_sag(spark, size):
    readings = [(16.0, 2.0)] * 10 + [(15.5, 10.0), (16.0, 2.0)]
    df = samples(spark, A=[battery(t, v, i) for t, (v, i) in enumerate(readings)])
    (row,) = s.voltage_sag_events(df, size=size).collect()
    assert (row.seq, row.delta_voltage, row.delta_current) == (10, -0.5, 8.0)
    (row,) = s.voltage_sag_step(df, size=size).collect()
    assert (seconds(row.timestamp_utc), row.delta_voltage) == (10, -0.5)


def test_motion_anomaly_needs_eleven_samples(spark, size):
    df = samples(
        spark,
        A=[accel(t, 9.81) for t in range(10)] + [accel(10, 100.0)],
        B=[accel(t, 9.81) for t in range(9)] + [accel(9, 100.0)],
    )
    (row,) = s.motion_anomalies(df, size=size).collect()
    assert (row.run_id, row.seq) == ("A", 10)
    assert row.rolling_mean == pytest.approx(18.009091, abs=1e-6)
    assert row.rolling_std == pytest.approx(27.193308, abs=1e-6)
    assert row.z_score == pytest.approx(10 / 11**0.5)
    summary = {r.run_id: r for r in s.motion_zscore_summary(df, size=size).collect()}
    a = summary["A"]
    assert a.rows_seen == 11
    assert a.max_abs_z_score == a.p95_abs_z_score == a.p99_abs_z_score
    assert a.avg_abs_z_score == pytest.approx(0.274101, abs=1e-6)
    assert summary["B"].max_abs_z_score == pytest.approx(9 / 10**0.5)


def test_humidity(spark, size):
    readings = [69.0, 71.0, 150.0, 72.0, None, 73.0, 60.0, 80.0, 80.0]
    df = samples(spark, A=[humid(t, h) for t, h in enumerate(readings)])
    (row,) = s.humidity_summary(df).collect()
    assert tuple(row) == ("A", 60.0, 72.14, 80.0, 20.0)
    (row,) = s.humidity_breach_streaks(df, size=size).collect()
    assert (seconds(row.streak_start), seconds(row.streak_end)) == (1, 5)
    assert (row.consecutive_samples, row.peak_humidity) == (3, 73.0)
    (row,) = s.humidity_rolling_elevation(df, size=size).collect()
    assert tuple(row) == ("A", 4, 72.14, 71.22)


def test_rapid_rise(spark, size):
    readings = [(0, 50.0), (2, 50.2), (62, 51.0), (62, 90.0)]
    df = samples(spark, A=[humid(t, h) for t, h in readings])
    (row,) = s.humidity_rapid_rise(df, size=size).collect()
    assert seconds(row.timestamp_utc) == 2
    assert tuple(row)[2:] == (50.2, 50.0, 0.0333, 6.0)


def test_counter_and_clock_checks(spark, size):
    readings = [{"t": 0, "seq": 1}, {"t": 2, "seq": 2}, {"t": 1, "seq": 5}, {"t": 3, "seq": 6}]
    df = samples(spark, A=readings)
    (row,) = s.seq_gaps(df, size=size).collect()
    assert tuple(row) == ("A", 2, 5, 2)
    (row,) = s.timestamp_disorder(df, size=size).collect()
    assert (row.seq, seconds(row.prev_time), seconds(row.timestamp_utc)) == (5, 2, 1)


def test_dive_plan(spark):
    plan = spark.createDataFrame(
        [("A", 1, 0.0, 1.0), ("A", 2, 1.0, 2.0), ("A", 3, 0.5, 0.25)],
        "run_id string, step int, target_depth_m double, hold_s double",
    )
    ticks = s.dive_plan_profile(plan, speed_mps=0.5, hz=2).collect()
    profile = sorted((r.t_s, r.depth_m) for r in ticks)
    # 1 s hold, 2 s down, 2 s hold, 1 s up, 0.25 s hold; 6.25 s make round(12.5) = 12 ticks
    depths = [0, 0, 0, 0.25, 0.5, 0.75, 1, 1, 1, 1, 1, 0.75]
    assert profile == [(i / 2, d) for i, d in enumerate(depths)]


@pytest.mark.parametrize(
    "targets, ticks",
    [
        ([(0, 20), (4, 30), (10, 55), (6, 40), (0, 20)], 3359),
        ([(0, 25), (8, 40), (12, 80), (8, 30), (0, 25)], 4051),
        ([(0, 20), (10, 30), (15, 40), (10, 20), (0, 20)], 3864),
    ],
)
def test_dive_plan_length(spark, targets, ticks):
    rows = [("A", n, float(d), float(h)) for n, (d, h) in enumerate(targets)]
    plan = spark.createDataFrame(
        rows, "run_id string, step int, target_depth_m double, hold_s double"
    )
    profile = s.dive_plan_profile(plan).toPandas()
    assert len(profile) == ticks
    assert profile.t_s.is_unique
    assert profile.depth_m.max() == max(d for d, _ in targets)


def test_counts_leave_out_events_without_run(spark):
    events = samples(spark, A=[{"t": 0}, {"t": 1}], B=[{"t": 0, "run_id": None}])
    assert [tuple(r) for r in s.event_counts(events, "n").collect()] == [("A", 2)]
