"""Sums that do not depend on order, and percentiles found digit by digit."""

from __future__ import annotations

import math
import random
import struct
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import soundings as s
from soundings.functions.columns import exact_avg, exact_sum
from soundings.plans.cells import CellSize
from soundings.plans.selection import exact_percentiles, from_sort_key, sort_key
from soundings.schema import SENSOR_SCHEMA


def _any_double(rng):
    return rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(-5, 40)


def test_sums_are_those_of_fractions(spark):
    rng = random.Random(2)
    rows = [(g, _any_double(rng)) for g in range(40) for _ in range(150)]
    df = spark.createDataFrame(rows, "g int, x double")
    for r in df.groupBy("g").agg(exact_sum("x").alias("sum")).collect():
        true = float(sum(Fraction(x) for g, x in rows if g == r.g))
        assert r.sum == pytest.approx(true, rel=2**-52, abs=2**-52)


def test_sums_do_not_depend_on_partitions(spark):
    rng = random.Random(4)
    rows = [(g, _any_double(rng), rng.random()) for g in range(20) for _ in range(200)]
    df = spark.createDataFrame(rows, "g int, x double, place double")
    seen = set()
    for n in (1, 3, 16):
        placed = df.repartitionByRange(n, "place").sortWithinPartitions(F.col("place") * -n)
        found = placed.groupBy("g").agg(exact_sum("x"), exact_avg("x"))
        seen.add(tuple(sorted(map(tuple, found.collect()))))
    assert len(seen) == 1


def test_sums_of_odd_values(spark):
    inf, nan = math.inf, math.nan
    groups = {
        1: ([None, None], None),
        2: ([inf, 1.0], inf),
        3: ([nan, 1.0], nan),
        4: ([1e300, 1.5], 1e300),
        5: ([None, 0.25], 0.25),
        6: ([2.0**60, -(2.0**60), 0.5], 0.5),
        7: ([inf, -inf], nan),
        8: ([-0.1], -0.1),
    }
    rows = [(g, x) for g, (values, _) in groups.items() for x in values]
    df = spark.createDataFrame(rows, "g int, x double")
    for r in df.groupBy("g").agg(exact_sum("x").alias("sum")).collect():
        expected = groups[r.g][1]
        if expected is None or math.isnan(expected):
            assert r.sum is None if expected is None else math.isnan(r.sum)
        else:
            assert r.sum == pytest.approx(expected, abs=2**-53)
    assert df.limit(0).agg(exact_avg("x")).first()[0] is None


def test_sort_keys_are_the_bits(spark):
    rng = random.Random(3)
    values = [0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, -5e-324, 0.1, 1.7976931348623157e308]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values += [math.nextafter(2.0**e, up) for e in range(-1074, 1024, 7) for up in (0, 2.0**e, math.inf)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    keys = df.select("x", sort_key("x").alias("key"))
    for x, key, back in keys.select("x", "key", from_sort_key("key")).collect():
        if math.isnan(x):
            assert math.isnan(back) and key > 2047 << 52
            continue
        bits = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        assert key == (bits if math.copysign(1, x) > 0 else -bits) and back == x


def test_percentiles_by_sorting(spark):
    rng = random.Random(6)
    runs = {f"r{n}": [rng.choice([rng.random(), 0.5, -rng.random() * 1e9]) for _ in range(n)] for n in (1, 2, 19, 20, 100, 3000)}
    runs[None] = [1.0, 1.0, 2.0, math.nan, 5e-324]
    rows = [(r, x) for r, values in runs.items() for x in values] + [("r2", None), ("only null", None)]
    df = spark.createDataFrame(rows, "run_id string, x double")
    shares = {"low": 0.0001, "half": 0.5, "p95": 0.95, "all": 1.0}
    found = exact_percentiles(df, "x", shares).collect()
    assert {r.run_id for r in found} == set(runs)
    for r in found:
        ordered = sorted(runs[r.run_id], key=lambda x: (math.isnan(x), x))
        for name, share in shares.items():
            want = ordered[math.ceil(Fraction(str(share)) * len(ordered)) - 1]
            assert repr(r[name]) == repr(want)


def test_exact_percentiles_of_a_run_of_a_million(spark):
    size = CellSize(hot_rows=100_000, cell_rows=50_000)
    micros = F.lit(1_770_308_460_000_000) + F.col("id") * 100_000
    values = {
        "timestamp_utc": F.timestamp_micros(micros),
        "seq": F.col("id").cast("int"),
        "run_id": F.lit("hot"),
        "imu_ax_mps2": F.lit(0.0),
        "imu_ay_mps2": F.lit(0.0),
        "imu_az_mps2": 9.81 + F.rand(3),
    }
    columns = [values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in SENSOR_SCHEMA]
    df = spark.range(1_000_000).select(*columns)
    row = s.motion_zscore_summary(df, exact=True, size=size).first()
    scores = s.accel_zscores(df, size=size).select(F.abs("z_score").alias("z")).toPandas()["z"]
    ordered = scores.sort_values().to_numpy()
    assert row.rows_seen == len(ordered) == 1_000_000
    assert row.p95_abs_z_score == ordered[950_000 - 1]
    assert row.p99_abs_z_score == ordered[990_000 - 1]
    assert row.avg_abs_z_score == pytest.approx(math.fsum(ordered) / 1e6, rel=1e-15)


def test_no_task_gets_a_run_for_its_percentiles(spark):
    """What is shuffled by run alone has been counted before."""
    df = spark.range(100_000).select(F.lit("hot").alias("run_id"), F.rand(1).alias("x"))
    found = exact_percentiles(df, "x", {"p95": 0.95})
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "percentile" not in plan and "collect_list" not in plan and "partial_count" in plan
