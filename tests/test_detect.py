"""Detecting events as samples arrive."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from frames import at, samples

import soundings as s
from soundings.streaming.detect import _taking, detectors, read_events

OPERATORS = {"voltage_sag_events": s.voltage_sag_events, "motion_anomalies": s.motion_anomalies}


@pytest.fixture
def feed(spark, tmp_path):
    arrived, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))

    class Feed:
        def arrive(self, lateness_s=0.0, **runs):
            samples(spark, **runs).repartition(3).write.mode("append").parquet(arrived)
            s.detect_events(spark, arrived, out, progress, lateness_s)

        def told(self, name):
            return sorted(map(tuple, read_events(spark, out, name).collect()), key=repr)

        def expected(self, name, due=None):
            rows = OPERATORS[name](s.read_sensor_data(spark, arrived))
            if due is not None:
                rows = rows.where(due)
            return sorted(map(tuple, rows.collect()), key=repr)

    return Feed()


def _readings(seed, n):
    dice = random.Random(seed)
    rows = []
    for i in range(n):
        jump = dice.random() < 0.05
        rows.append({
            "t": i // 2,  # times come twice, counters tell them apart
            "seq": None if dice.random() < 0.05 else i,
            "battery_voltage_v": None if dice.random() < 0.1 else 15 - jump * dice.uniform(0.3, 2),
            "battery_current_a": None if dice.random() < 0.1 else 5 + jump * dice.uniform(5, 20),
            "imu_ax_mps2": dice.gauss(0, 1),
            "imu_ay_mps2": None if dice.random() < 0.1 else dice.gauss(0, 1),
            "imu_az_mps2": 9.8 + jump * 40,
        })
    return rows


@pytest.mark.parametrize("name", OPERATORS)
def test_three_arrivals_tell_what_all_samples_tell(feed, name):
    runs = {f"run{k}": _readings(k, n) for k, n in enumerate((400, 90, 7, 1))}
    for begin, end in ((0, 30), (30, 31), (31, 400)):
        feed.arrive(**{run: rows[begin * 2 : end * 2] for run, rows in runs.items()})
    assert feed.told(name) == feed.expected(name)
    assert len(feed.told(name)) > 5


def test_samples_wait_for_earlier_ones(feed):
    rows = _readings(8, 300)
    shuffled = sorted(rows, key=lambda r: r["t"] + random.Random(r["t"]).uniform(0, 9))
    for begin in range(0, 300, 100):
        feed.arrive(lateness_s=10, run=shuffled[begin : begin + 100])
    for name in OPERATORS:
        due = f"timestamp_utc <= '{at(rows[-1]['t'] - 10):%F %T}'"
        assert feed.told(name) == feed.expected(name, due)
    # Nothing more comes of an arrival that is late.
    before = {name: feed.told(name) for name in OPERATORS}
    feed.arrive(lateness_s=10, run=[{**r, "battery_current_a": 99.0} for r in rows[40:60]])
    assert before == {name: feed.told(name) for name in OPERATORS}


def test_rows_without_time_or_run_and_no_rows(feed, spark):
    rows = _readings(3, 200)
    feed.arrive(run=[])
    assert [feed.told(name) for name in detectors()] == [[], []]
    feed.arrive(run=[{**r, "run_id": None} for r in rows])
    for name in OPERATORS:
        assert feed.told(name) == feed.expected(name) != []
    feed.arrive(other=[{**r, "t": None} for r in rows])
    for name in OPERATORS:
        assert all(row[0] is None for row in feed.told(name))


def test_many_short_runs_share_a_group(spark):
    """Runs of a group are told apart, and the work of a trigger is one call per group."""
    taken = []
    detector = detectors()["motion_anomalies"]

    def find(place, *readings):
        taken.append(int((place == 0).sum()))
        return detector.find(place, *readings)

    class State:
        exists, get = False, None

        def update(self, value):
            self.exists, self.get = True, value

    take = _taking(find, 10, ["accel_mag"], 0)
    runs = [f"run{k}" for k in range(500)]
    part = pd.DataFrame({"run_id": runs * 11, "seq": np.repeat(range(11), 500), "micros": 5, "accel_mag": 9.81})
    part.loc[part.index[-1], "accel_mag"] = 100.0
    state = State()
    assert list(take((0,), iter([part[: 500 * 6], part[500 * 6 : 500 * 10]]), state)) == []
    (told,) = take((0,), iter([part[500 * 10 :]]), state)
    assert taken == [500, 500] and told.run_id.tolist() == ["run499"]
    assert told.z_score.round(6).tolist() == [3.015113]
    assert len(state.get[3]) == 500 * 10 * 3 * 8 and set(state.get[2]) == {10}
