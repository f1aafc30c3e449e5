"""Sags and motion anomalies as samples arrive, without reading a run again.

What an event needs of the past is the last few samples of its run. They are kept in the state
of a streaming query, next to the samples that came early and wait for earlier ones. So a
sample is read once, whatever the length of its run, and the events written are those that
:func:`voltage_sag_events` and :func:`motion_anomalies` find in all samples at once.

Samples of a run are taken in order of time, counter and readings. One is *due* once a sample of its
run ``lateness_s`` younger has arrived; it waits until then. One that arrives after a later one of
its run was taken is late and left out, since what followed it is already told; the refresh of stored
results (:mod:`soundings.streaming.refresh`) takes it in. Samples without a time have no place in that
order and are left out as well.

Runs share the state in a fixed number of groups by their hash, so that many short runs cost no more
than a few long ones: the samples of all runs of a group are sorted and compared in one go, a run's never with
another's. A task holds the samples of one group that one trigger brings, which ``files_per_trigger``
bounds; the state holds ``window`` samples per run and those of its last ``lateness_s`` seconds, and
a trigger reads and writes it for the groups it has samples of.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from soundings.functions.columns import accel_magnitude, all_present
from soundings.schema import ACCEL_AXES, CURRENT, RUN, SENSOR_SCHEMA, SEQ, TIME, VOLTAGE
from soundings.sources.tables import canonical, reading_session, stored_schema

_MICROS = "micros"
_NO_SEQ = 1 << 31  # sorts a missing counter after all others
_GROUP = "run_group"

GROUPS = 1024


@dataclass(frozen=True)
class Detector:
    """What is kept of a sample, how many samples back it is compared, and which are events.

    ``find`` gets how many samples of its run stand right before each, and the readings, a column
    each: those of a run in order, one run after another. It gives the further columns of the result
    and which rows are events.
    """

    needed: tuple[str, ...]
    readings: Mapping[str, Callable[[], Column]]
    found: tuple[str, ...]
    window: int
    find: Callable[..., tuple[dict[str, np.ndarray], np.ndarray]]

    @property
    def schema(self) -> T.StructType:
        kept = [f for f in SENSOR_SCHEMA if f.name in (RUN, TIME, SEQ)]
        order = sorted(kept, key=lambda f: (RUN, TIME, SEQ).index(f.name))
        doubles = [T.StructField(c, T.DoubleType()) for c in (*self.readings, *self.found)]
        return T.StructType([*order, *doubles])


def sag_detector(window: int = 10, dv: float = -0.45, di: float = 8.0) -> Detector:
    """As :func:`voltage_sag_events`."""

    def find(
        place: np.ndarray, voltage: np.ndarray, current: np.ndarray
    ) -> tuple[dict[str, np.ndarray], np.ndarray]:
        base_v, base_c = (_means(place, x, window, 1) for x in (voltage, current))
        result = {
            "baseline_voltage_v": base_v,
            "baseline_current_a": base_c,
            "delta_voltage": voltage - base_v,
            "delta_current": current - base_c,
        }
        events = (result["delta_voltage"] <= dv) & _at_least(result["delta_current"], di)
        events[place == 0] = False  # nothing came before the first sample of a run
        return result, events

    found = ("baseline_voltage_v", "baseline_current_a", "delta_voltage", "delta_current")
    readings = {VOLTAGE: lambda: F.col(VOLTAGE), CURRENT: lambda: F.col(CURRENT)}
    return Detector((VOLTAGE, CURRENT), readings, found, window, find)


def anomaly_detector(z: float = 3.0, window: int = 10) -> Detector:
    """As :func:`motion_anomalies`."""

    def find(
        place: np.ndarray, magnitude: np.ndarray
    ) -> tuple[dict[str, np.ndarray], np.ndarray]:
        mean, deviation = _means(place, magnitude, window, 0), _deviations(place, magnitude, window)
        spread = (deviation > 0) | (np.isnan(deviation) & (place > 0))
        score = np.divide(magnitude - mean, deviation, out=np.zeros_like(mean), where=spread)
        result = {"rolling_mean": mean, "rolling_std": deviation, "z_score": score}
        return result, _at_least(np.abs(score), z)

    found = ("rolling_mean", "rolling_std", "z_score")
    return Detector(ACCEL_AXES, {"accel_mag": accel_magnitude}, found, window, find)


def detectors() -> dict[str, Detector]:
    return {"voltage_sag_events": sag_detector(), "motion_anomalies": anomaly_detector()}


def events_as_they_arrive(
    samples: DataFrame, detector: Detector, lateness_s: float = 0.0, groups: int = GROUPS
) -> DataFrame:
    """The events in a stream of canonical samples, in the columns of the operator for stored ones.

    Where an event has a NaN there, it has NULL here. ``groups`` stays as it was when the query began.
    """
    names = list(detector.readings)
    state = "runs array<string>, held array<int>, taken array<int>, samples binary"
    doubles = ", ".join(f"`{name}` double" for name in (*names, *detector.found))
    rows = samples.where(all_present(TIME, *detector.needed)).select(
        F.pmod(F.xxhash64(RUN), F.lit(groups)).cast("int").alias(_GROUP),
        RUN,
        F.unix_micros(TIME).alias(_MICROS),
        F.coalesce(F.col(SEQ).cast("long"), F.lit(_NO_SEQ)).alias(SEQ),
        *[value().alias(name) for name, value in detector.readings.items()],
    )
    found = rows.groupBy(_GROUP).applyInPandasWithState(
        _taking(detector.find, detector.window, names, int(lateness_s * 1_000_000)),
        f"{RUN} string, {_MICROS} bigint, {SEQ} bigint, {doubles}",
        state,
        "append",
        GroupStateTimeout.NoTimeout,
    )
    return found.select(
        RUN,
        F.timestamp_micros(_MICROS).alias(TIME),
        F.when(F.col(SEQ) < _NO_SEQ, F.col(SEQ)).cast("int").alias(SEQ),
        *names,
        *detector.found,
    )


def _taking(
    find: Callable[..., Any], window: int, names: list[str], lateness: int
) -> Callable[[Any, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Takes the due samples of the runs of a group in order and keeps what later ones need."""
    key = [_MICROS, SEQ, *names]
    types = [np.int64, np.int64, *[np.float64] * len(names)]

    def restored(state: GroupState) -> tuple[list[Any], np.ndarray, np.ndarray, list[np.ndarray]]:
        """The runs, the number of each sample's run, whether it was taken, and the samples."""
        if not state.exists:
            return [], np.zeros(0, np.int64), np.zeros(0, bool), [np.zeros(0, t) for t in types]
        runs, held, taken, stored = state.get
        number, counts = np.arange(len(runs)), np.array(held, np.int64)
        of = np.repeat(number, counts)
        place = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        columns = np.frombuffer(stored, np.int64).reshape(len(key), -1)
        samples = [c.view(t) for c, t in zip(columns, types, strict=True)]
        return list(runs), of, place < np.array(taken, np.int64)[of], samples

    def take(
        _: tuple[Any, ...], arrived: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        new = pd.concat([part[[RUN, *key]] for part in arrived], ignore_index=True)
        runs, held_of, past, held = restored(state)
        # A missing run is a run like others.
        of, all_runs = pd.factorize(
            np.array([*runs, *new[RUN].where(new[RUN].notna(), None)], object), use_na_sentinel=False
        )
        runs = [run if isinstance(run, str) else None for run in all_runs]
        values = [new[c].to_numpy(t) for c, t in zip(key, types, strict=True)]
        new_of = of[len(of) - len(new) :]

        # The last sample taken of a run, to which those that arrive are compared.
        last = np.full(len(runs), -1)
        last[held_of[past]] = np.flatnonzero(past)
        begun = last[new_of] >= 0
        early = np.ones(len(new), bool)
        early[begun] = _not_before(
            [c[begun] for c in values], [c[last[new_of[begun]]] for c in held]
        )
        of = np.concatenate([held_of[past], held_of[~past], new_of[early]])
        columns = [
            np.concatenate([h[past], h[~past], v[early]]) for h, v in zip(held, values, strict=True)
        ]
        fresh = np.arange(len(of)) >= past.sum()
        newest = np.full(len(runs), np.iinfo(np.int64).min)
        np.maximum.at(newest, of[fresh], columns[0][fresh])
        # Those taken stand first in their run, in the order they have.
        rank = np.where(fresh, 0, np.arange(len(of)) - len(of))
        tied = [np.where(fresh, c, 0) for c in columns[::-1]]
        order = np.lexsort([*tied, rank, of])
        of, fresh, columns = of[order], fresh[order], [c[order] for c in columns]
        due = ~fresh | (columns[0] <= newest[of] - lateness)

        place = np.arange(len(of)) - np.searchsorted(of, of)
        ready = [c[due] for c in columns]
        result, events = find(place[due], *ready[2:])
        events &= fresh[due]
        upto = np.bincount(of[due], minlength=len(runs))
        kept = place >= upto[of] - window
        matrix = np.stack([c[kept].view(np.int64) for c in columns])
        state.update((
            runs,
            np.bincount(of[kept], minlength=len(runs)).tolist(),
            np.minimum(upto, window).tolist(),
            matrix.tobytes(),
        ))
        if events.any():
            told = {RUN: [runs[k] for k in of[due][events]]}
            told |= {name: column[events] for name, column in zip(key, ready, strict=True)}
            yield pd.DataFrame(told | {name: column[events] for name, column in result.items()})

    return take


def _not_before(new: list[np.ndarray], bounds: list[np.ndarray]) -> np.ndarray:
    """Which rows come at or after their bound in the order of their columns, NaN being the largest."""
    before = np.zeros(len(new[0]), bool)
    same = np.ones(len(new[0]), bool)
    for value, bound in zip(new, bounds, strict=True):
        less, equal = value < bound, value == bound
        if value.dtype.kind == "f":
            less |= np.isnan(bound) & ~np.isnan(value)
            equal |= np.isnan(bound) & np.isnan(value)
        before |= same & less
        same &= equal
    return ~before


def _places(
    place: np.ndarray, values: np.ndarray, first: int, last: int
) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """The values ``first`` to ``last`` places before each in its run, oldest first: for which rows, whether
    the run has one, and they."""
    for back in range(min(first, int(place.max(initial=0))), last - 1, -1):
        yield slice(back, None), place[back:] >= back, values[: len(values) - back]


def _means(place: np.ndarray, values: np.ndarray, first: int, last: int) -> np.ndarray:
    """Means of frames, added oldest first as a window does; NaN where a frame is empty."""
    total, count = np.zeros(len(values)), np.zeros(len(values))
    for rows, has, own in _places(place, values, first, last):
        np.add(total[rows], own, out=total[rows], where=has)
        count[rows] += has
    return np.divide(total, count, out=np.full(len(values), np.nan), where=count > 0)


def _deviations(place: np.ndarray, values: np.ndarray, first: int) -> np.ndarray:
    """Sample deviations of each value and the ``first`` before, updated oldest first; NaN for one value."""
    count, mean, squares = np.zeros((3, len(values)))
    for rows, has, own in _places(place, values, first, 0):
        count[rows] += has
        delta = own - mean[rows]
        step = np.divide(delta, count[rows], out=np.zeros(len(own)), where=has)
        np.add(mean[rows], step, out=mean[rows], where=has)
        np.add(squares[rows], delta * (delta - step), out=squares[rows], where=has)
    variance = np.divide(squares, count - 1, out=np.full(len(values), np.nan), where=count > 1)
    return np.sqrt(variance)


def _at_least(values: np.ndarray, bound: float) -> np.ndarray:
    return (values >= bound) | np.isnan(values)


def detect_events(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    lateness_s: float = 0.0,
    files_per_trigger: int = 1000,
    using: Mapping[str, Detector] | None = None,
) -> None:
    """Find the events of the files added to ``in_dir`` since the last call, and add them to ``out_dir``.

    Each detector is a query of its own, with its own folder of events and of progress. Files are taken
    in once and events written once, also where a call failed half way.
    """
    using = detectors() if using is None else using
    session = reading_session(spark, in_dir)
    files = session.readStream.schema(stored_schema(session, in_dir))
    samples = canonical(files.option("maxFilesPerTrigger", files_per_trigger).parquet(in_dir))
    running = [
        events_as_they_arrive(samples, detector, lateness_s)
        .writeStream.format("parquet")
        .option("path", f"{out_dir.rstrip('/')}/{name}")
        .option("checkpointLocation", f"{checkpoint.rstrip('/')}/{name}")
        .trigger(availableNow=True)
        .start()
        for name, detector in using.items()
    ]
    for query in running:
        query.awaitTermination()


def read_events(
    spark: SparkSession, out_dir: str, name: str, using: Mapping[str, Detector] | None = None
) -> DataFrame:
    """The events of a detector written so far."""
    using = detectors() if using is None else using
    return spark.read.schema(using[name].schema).parquet(f"{out_dir.rstrip('/')}/{name}")
