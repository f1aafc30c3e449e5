"""Cutting long runs: results stay those of the uncut run, and no task gets a whole run."""

from __future__ import annotations

import random

import pytest
from frames import samples
from pyspark.sql import functions as F

import soundings as s
from soundings.plans.cells import BY_TIME, CELL, CellSize, RunCells

CUT = CellSize(hot_rows=40, cell_rows=6, marks_per_cell=2, marks_per_segment=5)
WINDOWED = [
    s.energy_per_run,
    s.voltage_sag_events,
    s.voltage_sag_step,
    s.vertical_rates,
    s.depth_run_summary,
    s.run_phase_segments,
    s.phase_summary,
    s.accel_zscores,
    s.motion_anomalies,
    s.motion_zscore_summary,
    s.humidity_rapid_rise,
    s.humidity_rolling_elevation,
    s.humidity_breach_streaks,
    s.seq_gaps,
    s.timestamp_disorder,
    lambda df, size=CellSize(): s.energy_per_run(df, drop_nulls=False, size=size),
    lambda df, size=CellSize(): s.depth_run_summary(df, drop_nulls=False, size=size),
    lambda df, size=CellSize(): s.motion_anomalies(df, z=1.0, drop_nulls=False, size=size),
    lambda df, size=CellSize(): s.humidity_breach_streaks(
        df, threshold=20.0, consecutive=1, size=size
    ),
    lambda df, size=CellSize(): s.humidity_breach_streaks(
        df, threshold=79.0, consecutive=1, size=size
    ),
]


def _reading(rng, number, missing_times):
    def maybe(value):
        return value if rng.random() > 0.3 else None

    t = number // 3 * rng.choice([1.0, 1.0, 0.0])  # repeated, disordered and stuck times
    if missing_times and rng.random() < 0.4:
        t = None
    return {
        "t": t,
        "seq": number + rng.choice([0, 0, 0, 2]),
        "battery_voltage_v": maybe(rng.choice([16.0, 15.4])),
        "battery_current_a": maybe(rng.choice([2.0, 12.0])),
        "depth_m": maybe(rng.uniform(-0.1, 12)),
        "humidity_pct": maybe(rng.choice([50.0, 75.0, 80.0, 120.0])),
        "imu_ax_mps2": maybe(0.0),
        "imu_ay_mps2": 0.0,
        "imu_az_mps2": rng.choice([9.8, 9.8, 9.8, 60.0]),
    }


@pytest.fixture(scope="module")
def skewed(spark):
    """Two long runs, one of them without many of its times, a long one without id, short ones."""
    rng = random.Random(7)
    short = {f"s{n}": [_reading(rng, i, False) for i in range(n)] for n in (1, 2, 15, 39)}
    nameless = [_reading(rng, i, False) | {"run_id": None} for i in range(90)]
    df = samples(
        spark,
        hot=[_reading(rng, i, False) for i in range(700)],
        stuck=[_reading(rng, i, True) for i in range(300)],
        nameless=nameless,
        **short,
    )
    return df.repartition(8).cache()


def _rows(df):
    frame = df.toPandas()
    for name in frame.columns:
        if frame[name].dtype == "float64":
            frame[name] = frame[name].round(9)
    return sorted(map(repr, frame.itertuples(index=False)))


@pytest.mark.parametrize("operator", WINDOWED)
def test_cutting_changes_nothing(skewed, operator):
    whole = _rows(operator(skewed))
    assert whole and whole == _rows(operator(skewed, size=CUT))


@pytest.mark.parametrize("operator", WINDOWED[:15])
def test_row_placement_changes_nothing(skewed, operator):
    shuffled = skewed.orderBy(F.xxhash64("seq", "depth_m")).coalesce(1)
    assert _rows(operator(skewed, size=CUT)) == _rows(operator(shuffled, size=CUT))


@pytest.mark.parametrize("operator", WINDOWED[:15])
def test_a_run_alone_gives_its_share(skewed, operator):
    alone = s.filter_run(skewed, "hot")
    share = operator(skewed, size=CUT).where("run_id = 'hot'")
    assert _rows(operator(alone, size=CUT)) == _rows(share)


def test_z_scores_stay_within_their_bound(skewed):
    top = s.accel_zscores(skewed, size=CUT).agg(F.max(F.abs("z_score"))).first()[0]
    assert top <= 10 / 11**0.5 + 1e-9


@pytest.mark.parametrize("lookback", [1, 4, 30])
@pytest.mark.parametrize("per_cell", [1, 3, 8])
def test_frames_reach_back_over_cells(spark, lookback, per_cell):
    df = samples(spark, A=[{"t": i, "depth_m": float(i)} for i in range(200)])
    marked = CellSize(10, 2 * per_cell, per_cell, marks_per_lookback=1, marks_per_segment=7)
    keys = df.select("run_id", *BY_TIME, "depth_m")
    cells = RunCells(keys, lookback=lookback, size=marked)
    rows = cells.with_columns(
        lambda w: {"before": F.sum("depth_m").over(w.rowsBetween(-lookback, -1))}
    ).collect()
    assert len(rows) == 200
    assert len({r[CELL] for r in rows}) >= 50 / max(per_cell, lookback)
    for r in rows:
        expected = sum(range(max(0, r.seq - lookback), r.seq)) if r.seq else None
        assert r.before == expected


@pytest.mark.parametrize("lookback", [10, 65, 600])
def test_few_rows_are_sent_twice(spark, lookback):
    df = samples(spark, A=[{"t": i, "depth_m": float(i)} for i in range(30_000)])
    keys = df.select("run_id", *BY_TIME, "depth_m")
    cells = RunCells(keys, lookback=lookback, size=CellSize(hot_rows=100, cell_rows=2000))
    assert cells.long_rows().select(CELL).distinct().count() > 3
    assert 30_000 < cells._long_sent().count() < 1.15 * 30_000


def test_cells_are_small_consecutive_stretches(spark):
    df = samples(spark, A=[{"t": (i // 50) ** 3} for i in range(3000)])
    cells = RunCells(df.select("run_id", *BY_TIME), size=CellSize(100, 40, 10))
    rows = sorted(cells.all_rows().collect(), key=lambda r: (r.timestamp_utc, r.seq))
    numbers = [r[CELL] for r in rows]
    assert numbers == sorted(numbers)
    assert max(numbers.count(n) for n in set(numbers)) < 40 * 3
    assert cells.all_rows().count() == cells.long_rows().count() == 3000


def test_stuck_clock_and_counter_are_cut_by_the_readings(spark):
    readings = [{"t": None, "seq": 5, "depth_m": float(i * 7 % 2000)} for i in range(2000)]
    df = samples(spark, A=readings)
    cells = RunCells(df.select("run_id", *BY_TIME, "depth_m"), size=CellSize(100, 40, 10))
    rows = sorted(cells.all_rows().collect(), key=lambda r: r.depth_m)
    numbers = [r[CELL] for r in rows]
    assert numbers == sorted(numbers)
    assert max(numbers.count(n) for n in set(numbers)) < 40 * 3


def test_short_runs_are_not_cut(skewed):
    cells = RunCells(skewed.select("run_id", *BY_TIME), size=CUT)
    long_runs = {r.run_id for r in cells.long_rows().select("run_id").distinct().collect()}
    assert long_runs == {"hot", "stuck", None}


@pytest.mark.parametrize("operator", [s.energy_per_run, s.humidity_breach_streaks])
def test_results_do_not_rest_on_adaptive_execution(spark, skewed, operator):
    expected = _rows(operator(skewed))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert _rows(operator(skewed)) == _rows(operator(skewed, size=CUT)) == expected
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("per_segment", [1, 6, 10**9])
def test_marks_are_numbered_alike_by_any_segments(spark, per_segment):
    """Cells and tails as if all marks of a run had been numbered at once."""
    df = samples(spark, A=[{"t": (i // 50) ** 2} for i in range(1500)], B=[{"t": i} for i in range(99)])
    size = CellSize(50, 20, 4, marks_per_lookback=1, marks_per_segment=per_segment)
    cells = RunCells(df.select("run_id", *BY_TIME), lookback=3, size=size)
    marks = cells._find_marks(df).collect()
    rows = cells._placed().collect()
    assert len(rows) == 1599
    for run in "AB":
        keys = sorted(m["_key"] for m in marks if m["_long_run"] == run)
        assert len(keys) > 4
        for r in (r for r in rows if r.run_id == run):
            key = (int(r.timestamp_utc.timestamp() * 1e6), r.seq)
            passed = sum(tuple(k) <= key for k in keys)
            assert r[CELL] == max(passed - 1, 0) // 4
            assert r["_tails"] == (passed + 2) // 4


def test_no_window_or_list_over_all_marks_of_a_run(spark):
    """Lists and windows hold a segment's share of the marks, whatever the run's length."""
    most = []
    for n in (2000, 16_000):
        df = samples(spark, A=[{"t": i} for i in range(n)])
        size = CellSize(100, 20, 4, marks_per_segment=40)
        cells = RunCells(df.select("run_id", *BY_TIME), size=size)
        rows = cells.cuts.selectExpr("size(_cuts) AS cuts", "_earlier").collect()
        assert sum(r.cuts for r in rows) > n / 30
        most.append(max(r.cuts for r in rows))
    assert max(most) < 40 / 4 * 12 and len(rows) > 20
