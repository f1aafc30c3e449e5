"""Refreshing stored results when files arrive."""

from __future__ import annotations

import pytest
from frames import battery, samples

import soundings as s
from soundings.streaming import refresh


@pytest.fixture
def store(spark, tmp_path):
    arrived, out = str(tmp_path / "in"), str(tmp_path / "out")

    class Store:
        def __init__(self):
            self.out, self.checkpoint = out, str(tmp_path / "progress")

        def arrive(self, **runs):
            samples(spark, **runs).write.mode("append").parquet(arrived)

        def refresh(self, operators=None):
            operators = operators or {
                "energy_per_run": s.energy_per_run,
                "voltage_sag_step": s.voltage_sag_step,
            }
            s.refresh_outputs(spark, arrived, out, self.checkpoint, operators)

        def stored(self, name):
            return sorted(map(tuple, s.read_output(spark, out, name).collect()), key=repr)

        def expected(self, name):
            result = getattr(s, name)(s.read_sensor_data(spark, arrived))
            return sorted(map(tuple, result.collect()), key=repr)

    return Store()


def test_late_files_renew_their_run(store):
    drop = [battery(0, 16.0, 1.0) | {"seq": 0}, battery(4, 15.0, 3.0) | {"seq": 2}]
    store.arrive(A=drop, B=drop)
    store.refresh()
    assert [r[0] for r in store.stored("voltage_sag_step")] == ["A", "B"]
    # The late sample explains the drop step by step: the run has no event any more.
    store.arrive(A=[battery(2, 15.0, 1.0) | {"seq": 1}], C=drop)
    store.refresh()
    assert [r[0] for r in store.stored("voltage_sag_step")] == ["B", "C"]
    for name in ("energy_per_run", "voltage_sag_step"):
        assert store.stored(name) == store.expected(name)


def test_nothing_new_changes_nothing(store):
    store.arrive(A=[battery(0, 16.0, 1.0), battery(1, 16.0, 1.0)])
    store.refresh()
    before = store.stored("energy_per_run")
    store.refresh()
    assert store.stored("energy_per_run") == before


def test_failed_refresh_is_repeated(store):
    store.arrive(A=[battery(0, 16.0, 1.0), battery(1, 16.0, 1.0)])

    def broken(_df):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        store.refresh({"energy_per_run": s.energy_per_run, "broken": broken})
    store.refresh()
    assert store.stored("energy_per_run") == store.expected("energy_per_run")


def test_many_runs_and_runs_without_name(store):
    runs = {f"r{n}": [battery(0, 16.0, 1.0), battery(1, 16.0, float(n))] for n in range(5)}
    store.arrive(none=[battery(t, 1.0, 1.0) | {"run_id": None} for t in range(3)], **runs)
    store.refresh({"energy_per_run": s.energy_per_run})
    assert len(store.stored("energy_per_run")) == 6
    assert store.stored("energy_per_run") == store.expected("energy_per_run")


def test_compaction_keeps_results_and_later_refreshes_win(spark, store):
    only = {"energy_per_run": s.energy_per_run}
    store.arrive(A=[battery(0, 16.0, 1.0)], B=[battery(0, 8.0, 2.0), battery(1, 8.0, 2.0)])
    store.refresh(only)
    store.arrive(A=[battery(1, 16.0, 1.0)])
    store.refresh(only)
    refresh.compact_outputs(spark, store.out, only)
    assert store.stored("energy_per_run") == store.expected("energy_per_run")
    store.arrive(A=[battery(2, 16.0, 3.0)])
    store.refresh(only)
    assert store.stored("energy_per_run") == store.expected("energy_per_run")


def test_lost_checkpoint_does_not_bring_old_results_back(store):
    only = {"energy_per_run": s.energy_per_run}
    for t in range(3):
        store.arrive(A=[battery(t, 16.0, 1.0)])
        store.refresh(only)
    store.checkpoint += "-new"
    store.arrive(A=[battery(3, 16.0, 5.0)])
    store.refresh(only)
    assert store.stored("energy_per_run") == store.expected("energy_per_run")


def _files_read(df):
    """What the scan of a plan without exchange says after it has run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_refresh_reads_touched_buckets_only(spark, store, tmp_path):
    """One late sample of one of 400 runs: about a hundredth of the files in 100 buckets."""
    seen = []

    def watched(samples):
        seen.append(_files_read(samples.select("run_id", "depth_m")))
        return s.energy_per_run(samples)

    store.arrive(**{f"r{n}": [battery(t, 16.0, 1.0) for t in range(3)] for n in range(400)})
    operators = {"energy_per_run": watched}
    s.refresh_outputs(spark, str(tmp_path / "in"), store.out, store.checkpoint, operators, buckets=100)
    store.arrive(r7=[battery(9, 16.0, 5.0) | {"seq": 9}])
    store.refresh(operators)
    assert seen[0] >= 90 and seen[1] == 2
    assert store.stored("energy_per_run") == store.expected("energy_per_run")
    one = s.read_samples(spark, store.out, "r7")
    assert one.count() == 4 and _files_read(one) == 2
    assert s.read_samples(spark, store.out).count() == 1201
    refresh.compact_outputs(spark, store.out, operators)
    assert _files_read(s.read_samples(spark, store.out, "r7")) == 1
    assert s.read_samples(spark, store.out).count() == 1201
    written = (tmp_path / "out" / "energy_per_run" / "batch=2").glob("bucket=*")
    assert len(list(written)) == 1


def test_files_are_taken_in_once(spark, store):
    only = {"energy_per_run": s.energy_per_run}
    store.arrive(A=[battery(0, 16.0, 1.0), battery(1, 16.0, 1.0)])
    store.refresh(only)
    for name in ("-b", "-c"):
        store.checkpoint += name
        store.refresh(only)
    assert s.read_samples(spark, store.out).count() == 2
    store.arrive(B=[battery(0, 16.0, 1.0)])
    store.checkpoint += "-d"
    store.refresh(only)
    assert s.read_samples(spark, store.out).count() == 3
