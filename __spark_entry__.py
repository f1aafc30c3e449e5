
from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import soundings as s
from soundings.functions.columns import ntz_from_instant, round_scaled
from soundings.schema import ACCEL_AXES, DEFAULT_ID_COLUMNS, SENSOR_SCHEMA
from soundings.sources.catalog import VIEWS
from soundings.sources.events import read_events_as_sensor_data
from soundings.sources.tables import run_group
from soundings.sources.workspace import shared_dir
from soundings.streaming.detect import detectors
from soundings.streaming.refresh import compact_outputs

try:
    import corpus_pipeline
    from soundings.llm import queries as corpus
except ModuleNotFoundError as missing:
    # Only the subpackage and its pipeline may be absent, not what they depend on.
    if not (missing.name or "").startswith(("corpus_pipeline", "soundings.llm")):
        raise
    corpus_pipeline = corpus = None

Query = Callable[[SparkSession, str], DataFrame]

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    return queries()["energy_per_run"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    """One query per operator. Every one starts from the whole table it is given."""
    plain = {
        "row_count": s.row_count,
        "preview": s.preview,
        "filter_run": lambda df: s.filter_run(df, "run1"),
        "energy_per_run": s.energy_per_run,
        "energy_per_run_unfiltered": lambda df: s.energy_per_run(df, drop_nulls=False),
        "voltage_sag_events": s.voltage_sag_events,
        "voltage_sag_step": s.voltage_sag_step,
        "voltage_sag_step_counts": lambda df: s.event_counts(
            s.voltage_sag_step(df), "event_count"
        ),
        "avg_voltage": s.avg_voltage,
        "max_depth": s.max_depth,
        "vertical_rates": s.vertical_rates,
        "depth_run_summary": s.depth_run_summary,
        "depth_run_summary_unfiltered": lambda df: s.depth_run_summary(
            df, drop_nulls=False
        ),
        "run_phase_segments": s.run_phase_segments,
        "phase_summary": s.phase_summary,
        "accel_zscores": s.accel_zscores,
        "accel_zscores_wide": lambda df: s.accel_zscores(df, window=600),
        "motion_anomalies": s.motion_anomalies,
        "motion_anomalies_unfiltered": lambda df: s.motion_anomalies(
            df, drop_nulls=False
        ),
        "motion_anomaly_counts": lambda df: s.event_counts(
            s.motion_anomalies(df), "anomaly_count"
        ),
        "motion_zscore_summary": s.motion_zscore_summary,
        "motion_zscore_summary_exact": lambda df: s.motion_zscore_summary(
            df, exact=True
        ),
        "humidity_clean": s.humidity_clean,
        "humidity_summary": s.humidity_summary,
        "humidity_breach_streaks": s.humidity_breach_streaks,
        "humidity_breach_counts": lambda df: s.event_counts(
            s.humidity_breach_streaks(df), "streak_count"
        ),
        "humidity_rapid_rise": s.humidity_rapid_rise,
        "humidity_rapid_rise_counts": lambda df: s.event_counts(
            s.humidity_rapid_rise(df), "rapid_rise_count"
        ),
        "humidity_rolling_elevation": s.humidity_rolling_elevation,
        "humidity_rolling_elevation_wide": lambda df: s.humidity_rolling_elevation(
            df, window=600
        ),
        "seq_gaps": s.seq_gaps,
        "drop_all_null_rows": _drop_all_null_rows,
    }
    with_session = {
        "timestamp_disorder": _timestamp_disorder,
        "parse_time_columns": _parse_time_columns,
        "ingest_csv": _ingest_csv,
        "ingest_csv_dirty": _ingest_csv_dirty,
        "convert_csv_raw": _convert_csv_raw,
        "split_csv": _split_csv,
        "read_sensor_data": _read_sensor_data,
        "split_by_column": _split_by_column,
        "split_by_groups": _split_by_groups,
        "split_by_keywords": _split_by_keywords,
        "register_views": _register_views,
        "create_sensor_table": _create_sensor_table,
        "catalog_views": _catalog_views,
        "refresh_outputs": _refresh_outputs,
        "detect_events": _detect_events,
        "dive_plan_profile": _dive_plan_profile,
    }
    result = {name: _on_sensor_data(operator) for name, operator in plain.items()}
    result |= {name: _tidied(query) for name, query in with_session.items()}
    if corpus is not None:
        result |= corpus.QUERIES | {"pipeline": corpus_pipeline.run}
    return result


def _on_sensor_data(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _tidied(
        lambda spark, sf_dir: operator(read_events_as_sensor_data(spark, sf_dir))
    )


def _tidied(query: Query) -> Query:
    return lambda spark, sf_dir: _tidy(query(spark, sf_dir))


def _tidy(df: DataFrame) -> DataFrame:
    """Values two engines agree on: doubles to six places without -0.0, times without a zone."""
    columns = []
    for field in df.schema:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            value = round_scaled(value, 6) + F.lit(0.0)
        elif isinstance(field.dataType, T.TimestampType):
            value = ntz_from_instant(value)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def _drop_all_null_rows(df: DataFrame) -> DataFrame:
    motion = df.select("timestamp_utc", "seq", "run_id", *ACCEL_AXES)
    return s.drop_all_null_rows(motion, DEFAULT_ID_COLUMNS)


def _timestamp_disorder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return s.timestamp_disorder(
        read_events_as_sensor_data(spark, sf_dir, late_every=7)
    )


def _with_text_times(df: DataFrame) -> DataFrame:
    text = F.date_format(
        ntz_from_instant(F.col("timestamp_utc")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    )
    return df.withColumn("timestamp_utc", text)


def _parse_time_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = _with_text_times(read_events_as_sensor_data(spark, sf_dir))
    readable = F.when(F.col("seq") % 10 == 0, F.lit("no time")).otherwise(
        F.col("timestamp_utc")
    )
    damaged = text.select(readable.alias("timestamp_utc"), "seq", "run_id")
    return s.parse_time_columns(damaged, DEFAULT_ID_COLUMNS)


def _write_csv(spark: SparkSession, sf_dir: str) -> str:
    path = shared_dir(spark, "csv")
    samples = _with_text_times(read_events_as_sensor_data(spark, sf_dir))
    samples.write.csv(path, header=True)
    return path


def _ingest_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = s.ingest_csv(spark, _write_csv(spark, sf_dir), shared_dir(spark, "ingested"))
    return spark.read.parquet(out)


def _ingest_csv_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large counters, an identifier with leading zeros, a time that is none, short lines."""
    path = shared_dir(spark, "dirty")
    samples = _with_text_times(read_events_as_sensor_data(spark, sf_dir))
    lines = samples.select(
        F.concat_ws(
            ",",
            (F.col("seq") + F.lit(3_000_000_000)).cast("string"),
            F.lpad(F.pmod("seq", F.lit(9)).cast("string"), 3, "0"),
            "run_id",
            F.when(F.col("seq") % 5 != 0, F.concat(F.lit('"at, '), "timestamp_utc", F.lit('"'))),
        )
    )
    header = spark.range(1).select(F.lit("seq,source,run_id,seen_time"))
    header.union(lines).coalesce(1).write.text(path)
    out = s.ingest_csv(spark, path, shared_dir(spark, "ingested"))
    return spark.read.parquet(out)


def _split_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From CSV into groups by a JSON file of members, and one more by a JSON file of keywords."""
    path, config = _write_csv(spark, sf_dir), shared_dir(spark, "config")
    members = '{"electric": ["battery_voltage_v", "battery_current_a"]}'
    for name, text in (("members", members), ("words", '{"deep": ["DEPTH"]}')):
        spark.range(1).select(F.lit(text)).write.text(f"{config}/{name}")
    out = shared_dir(spark, "split")
    (electric,) = s.split_csv(
        spark, path, f"{out}/a", mode="group", groups=f"{config}/members/*.txt"
    )
    (deep,) = s.split_csv(
        spark, path, f"{out}/b", mode="group", keywords=f"{config}/words/*.txt"
    )
    return spark.read.parquet(electric).unionByName(
        spark.read.parquet(deep), allowMissingColumns=True
    )


def _convert_csv_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = s.convert_csv_raw(spark, _write_csv(spark, sf_dir), shared_dir(spark, "raw"))
    return spark.read.parquet(out)


def _stored_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "samples")
    s.write_sensor_data(read_events_as_sensor_data(spark, sf_dir), out)
    return s.read_sensor_data(spark, out)


def _read_sensor_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored_samples(spark, sf_dir)


def _split_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All split tables again as one, with the name of the signal."""
    paths = s.split_by_column(_stored_samples(spark, sf_dir), shared_dir(spark, "split"))
    result = None
    for path in paths:
        signal = path.rsplit("/", 1)[1]
        part = spark.read.parquet(path).withColumn("signal", F.lit(signal))
        part = part.withColumnRenamed(signal, "reading")
        result = part if result is None else result.unionByName(part)
    return result


def _split_by_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = {"Motion": [*ACCEL_AXES, "run_id", "no_such_column"], "none": ["run_id"]}
    paths = s.split_by_groups(
        _stored_samples(spark, sf_dir), shared_dir(spark, "split"), groups
    )
    return spark.read.parquet(*paths)


def _split_by_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = s.split_by_keywords(
        _stored_samples(spark, sf_dir),
        shared_dir(spark, "split"),
        {"battery": ["BATTERY_"], "none": ["sonar"]},
    )
    return spark.read.parquet(*paths)


def _register_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    s.register_views(spark, read_events_as_sensor_data(spark, sf_dir))
    return spark.sql(
        "SELECT run_id, energy_wh, max_depth_m, max_abs_z_score FROM energy_per_run"
        " JOIN depth_run_summary USING (run_id) JOIN motion_zscore_summary USING (run_id)"
    )


def _publish(spark: SparkSession, sf_dir: str) -> str:
    """All samples by run, counters of 32 bits in some directories and 64 in others; half come late.

    Runs share directories by groups, as there may be very many short ones.
    """
    groups = 64
    location, name = shared_dir(spark, "by_run"), f"sensor_data_{uuid.uuid4().hex}"
    samples = read_events_as_sensor_data(spark, sf_dir)
    for half, width in ((0, "int"), (1, "bigint")):
        own = samples.where(run_group(groups) % 2 == half)
        own = own.withColumn("seq", F.col("seq").cast(width))
        s.write_sensor_data(own, location, run_groups=groups, mode="append")
        s.publish_sensor_data(spark, location, name, by_run=True, run_groups=groups)
    return name


def _create_sensor_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published table, read by another session."""
    return spark.newSession().table(_publish(spark, sf_dir))


def _catalog_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six views over the files of the whole table, read by another session."""
    location, name = shared_dir(spark, "published"), f"sensor_data_{uuid.uuid4().hex}"
    s.write_sensor_data(read_events_as_sensor_data(spark, sf_dir), location)
    s.publish_sensor_data(spark, location, name)
    other = spark.newSession()
    return reduce(DataFrame.unionByName, [_numbers(other.table(f"{name}_{n}"), n) for n in VIEWS])


def _refresh_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run arrives in three files, one of them late and after the checkpoint was lost.

    All operators are refreshed; then the results are compacted and all six are read, one row for
    each of their numbers.
    """
    samples = read_events_as_sensor_data(spark, sf_dir)
    arrived, out = shared_dir(spark, "arrived"), shared_dir(spark, "results")
    checkpoint = shared_dir(spark, "progress")
    for part in (0, 2, 1):
        if part == 1:
            checkpoint = shared_dir(spark, "progress")
        samples.where(F.col("seq") % 3 == part).write.mode("append").parquet(arrived)
        s.refresh_outputs(spark, arrived, out, checkpoint, buckets=16)
    compact_outputs(spark, out)
    return reduce(DataFrame.unionByName, [_numbers(s.read_output(spark, out, n), n) for n in VIEWS])


def _detect_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples of three stretches of time arrive one after another; sags and anomalies are detected."""
    samples = read_events_as_sensor_data(spark, sf_dir)
    arrived, out = shared_dir(spark, "arrived"), shared_dir(spark, "events")
    checkpoint = shared_dir(spark, "progress")
    micros = F.unix_micros("timestamp_utc")
    first, last = samples.agg(F.min(micros), F.max(micros)).first()
    third = F.floor((micros - F.lit(first)) * 3 / F.lit((last or 0) - (first or 0) + 1))
    for part in range(3):
        samples.where(third == part).write.mode("append").parquet(arrived)
        s.detect_events(spark, arrived, out, checkpoint)
    return reduce(
        DataFrame.unionByName, [_numbers(s.read_events(spark, out, n), n) for n in detectors()]
    )


def _numbers(result: DataFrame, name: str) -> DataFrame:
    """(output, run_id, seq, label, measure, reading): a row for each number that is not NULL."""
    measures = [f.name for f in result.schema if f.name not in ("run_id", "seq", "timestamp_utc", "phase")]
    long = result.unpivot(
        [c for c in ("run_id", "seq", "phase") if c in result.columns],
        [F.col(c).cast("double").alias(c) for c in measures],
        "measure",
        "reading",
    )
    missing = {c: F.lit(None) for c in ("seq", "phase") if c not in result.columns}
    return long.withColumns(missing).select(
        F.lit(name).alias("output"),
        "run_id",
        F.col("seq").cast("int").alias("seq"),
        F.col("phase").cast("string").alias("label"),
        "measure",
        "reading",
    ).where("reading IS NOT NULL")


def _dive_plan_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each supplier is a step of its nation's plan; depths and times are exact in binary."""
    number = F.col("s_suppkey").cast("int")
    plan = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.concat(F.lit("nation"), F.col("s_nationkey").cast("string")).alias("run_id"),
        number.alias("step"),
        ((number * 7) % 25 * F.lit(0.5)).alias("target_depth_m"),
        (number % 8 * F.lit(0.75)).alias("hold_s"),
    )
    return s.dive_plan_profile(plan, speed_mps=0.125, hz=10)


# ---- SQL for the other engine ----

_SENSOR_DATA = """
SELECT make_timestamp((1770308460000 + event_id * 100) * 1000) AS timestamp_utc,
       CAST(event_id AS INTEGER) AS seq,
       'run' || CAST(user_id AS VARCHAR) AS run_id,
       CASE WHEN event_type <> 'signup'
            THEN 16.0::DOUBLE - 0.06::DOUBLE * (2.5::DOUBLE + value / 10.0::DOUBLE)
       END AS battery_voltage_v,
       CASE WHEN event_type <> 'signup' THEN 2.5::DOUBLE + value / 10.0::DOUBLE END
           AS battery_current_a,
       CASE WHEN event_type <> 'view' THEN value / 20.0::DOUBLE END AS depth_m,
       CASE WHEN event_type <> 'purchase' THEN 45.0::DOUBLE + value / 2.0::DOUBLE END
           AS humidity_pct,
       CASE WHEN event_type <> 'error' THEN 0.01::DOUBLE * (event_id % 3) END AS imu_ax_mps2,
       CASE WHEN event_type <> 'error' THEN 0.0::DOUBLE END AS imu_ay_mps2,
       CASE WHEN event_type <> 'error'
            THEN 9.81::DOUBLE + CASE WHEN value > 150 THEN value ELSE 0.0::DOUBLE END
       END AS imu_az_mps2
FROM events"""

_RUN_ORDER = "(PARTITION BY run_id ORDER BY timestamp_utc NULLS LAST, seq NULLS LAST)"
_BATTERY_KNOWN = "battery_voltage_v IS NOT NULL AND battery_current_a IS NOT NULL"
_IMU_KNOWN = " AND ".join(f"{axis} IS NOT NULL" for axis in ACCEL_AXES)
_HUMIDITY_OK = "humidity_pct BETWEEN 0 AND 100"
_SINCE_LAST = "(epoch_us(timestamp_utc) - lag(epoch_us(timestamp_utc)) OVER run) / 1e6"


_UNIT = f"{2**60}::HUGEINT"


def _units(value: str) -> str:
    """The exact sum of doubles as a whole number of 2^-60."""
    whole = f"trunc({value})"
    part = f"round_even(({value} - {whole}) * {2.0**60!r}::DOUBLE, 0)"
    return f"sum(CAST({whole} AS HUGEINT) * {_UNIT} + CAST({part} AS HUGEINT))"


def _from_units(units: str) -> str:
    part = f"((({units} % {_UNIT}) + {_UNIT}) % {_UNIT})"
    whole = f"(({units} - {part}) // {_UNIT})::DOUBLE"
    return f"({whole} + {part}::DOUBLE / {2.0**60!r}::DOUBLE)"


def _energy(where: str = "TRUE") -> str:
    return f"""
SELECT run_id, {_from_units("joules")} / 3600 AS energy_wh
FROM (SELECT run_id, {_units("watts * secs")} AS joules
      FROM (SELECT run_id, battery_voltage_v * battery_current_a AS watts, {_SINCE_LAST} AS secs
            FROM sensor_data WHERE {where} WINDOW run AS {_RUN_ORDER})
      WHERE secs IS NOT NULL GROUP BY run_id)"""


def _rates(where: str) -> str:
    return f"""
SELECT *, climb / nullif(delta_seconds, 0) AS vertical_rate_mps
FROM (SELECT *, {_SINCE_LAST} AS delta_seconds, depth_m - lag(depth_m) OVER run AS climb,
             row_number() OVER run AS nth
      FROM sensor_data WHERE {where} WINDOW run AS {_RUN_ORDER})
WHERE nth > 1"""


_RATES = _rates("depth_m IS NOT NULL")
_PHASES = f"""
SELECT *, CASE WHEN depth_m <= 0.25 THEN 'surface'
               WHEN abs(vertical_rate_mps) < 0.03 OR vertical_rate_mps IS NULL
               THEN 'holding_depth'
               WHEN vertical_rate_mps > 0 THEN 'descending' ELSE 'ascending' END AS phase
FROM ({_RATES})"""


def _depth_summary(rates: str) -> str:
    return f"""
SELECT run_id, max_depth_m, {_from_units("depths")} / samples AS avg_depth_m,
       {_from_units("descents")} / nullif(descending, 0) AS avg_descent_rate_mps,
       {_from_units("ascents")} / nullif(ascending, 0) AS avg_ascent_rate_mps,
       {_from_units("seconds")} AS time_at_depth_seconds
FROM (SELECT run_id, max(depth_m) AS max_depth_m, count(depth_m) AS samples,
             count(down) AS descending, count(up) AS ascending, {_units("depth_m")} AS depths,
             {_units("down")} AS descents, {_units("up")} AS ascents, {_units("deep")} AS seconds
      FROM (SELECT *, CASE WHEN vertical_rate_mps > 0 THEN vertical_rate_mps END AS down,
                   CASE WHEN vertical_rate_mps < 0 THEN vertical_rate_mps END AS up,
                   CASE WHEN depth_m >= 0.9 * max(depth_m) OVER (PARTITION BY run_id)
                        THEN delta_seconds END AS deep
            FROM ({rates}))
      GROUP BY run_id)"""


_SAG = f"""
SELECT *, battery_voltage_v - baseline_voltage_v AS delta_voltage,
       battery_current_a - baseline_current_a AS delta_current
FROM (SELECT *, avg(battery_voltage_v) OVER recent AS baseline_voltage_v,
             avg(battery_current_a) OVER recent AS baseline_current_a
      FROM sensor_data WHERE {_BATTERY_KNOWN}
      WINDOW recent AS ({_RUN_ORDER[1:-1]} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING))
WHERE battery_voltage_v - baseline_voltage_v <= -0.45::DOUBLE
  AND battery_current_a - baseline_current_a >= 8"""

_SAG_STEP = f"""
SELECT * FROM (
  SELECT *, battery_voltage_v - lag(battery_voltage_v) OVER run AS delta_voltage,
         battery_current_a - lag(battery_current_a) OVER run AS delta_current
  FROM sensor_data WINDOW run AS {_RUN_ORDER})
WHERE delta_voltage <= -0.05::DOUBLE AND delta_current >= 0.5::DOUBLE"""


def _zscores(where: str) -> str:
    return f"""
SELECT *, CASE WHEN rolling_std > 0 THEN (accel_mag - rolling_mean) / rolling_std
               ELSE 0.0::DOUBLE END AS z_score
FROM (SELECT *, avg(accel_mag) OVER recent AS rolling_mean,
             stddev_samp(accel_mag) OVER recent AS rolling_std
      FROM (SELECT *, sqrt(imu_ax_mps2 * imu_ax_mps2 + imu_ay_mps2 * imu_ay_mps2
                           + imu_az_mps2 * imu_az_mps2) AS accel_mag
            FROM sensor_data WHERE {where})
      WINDOW recent AS ({_RUN_ORDER[1:-1]} ROWS BETWEEN 10 PRECEDING AND CURRENT ROW))"""


_ZSCORES = _zscores(_IMU_KNOWN)
_ANOMALIES = f"SELECT * FROM ({_ZSCORES}) WHERE abs(z_score) >= 3"
_ZSCORE_SUMMARY = f"""
SELECT * EXCLUDE (scores), {_from_units("scores")} / rows_seen AS avg_abs_z_score
FROM (SELECT run_id, count(*) AS rows_seen, max(abs(z_score)) AS max_abs_z_score,
             {_units("abs(z_score)")} AS scores,
             quantile_disc(abs(z_score), 0.95) AS p95_abs_z_score,
             quantile_disc(abs(z_score), 0.99) AS p99_abs_z_score
      FROM ({_ZSCORES}) GROUP BY run_id)"""

_STREAKS = f"""
SELECT run_id, min(timestamp_utc) AS streak_start, max(timestamp_utc) AS streak_end,
       count(*) AS consecutive_samples, round(max(humidity_pct), 2) AS peak_humidity
FROM (SELECT *, nth - row_number() OVER (PARTITION BY run_id, humidity_pct > 70
                                         ORDER BY timestamp_utc, seq) AS island
      FROM (SELECT *, row_number() OVER run AS nth FROM sensor_data
            WHERE {_HUMIDITY_OK} WINDOW run AS {_RUN_ORDER}))
WHERE humidity_pct > 70 GROUP BY run_id, island HAVING count(*) >= 3"""

_RAPID_RISE = f"""
SELECT run_id, timestamp_utc, round(humidity_pct, 2) AS humidity_pct,
       round(before, 2) AS prev_humidity, round(secs / 60, 4) AS dt_minutes,
       round((humidity_pct - before) / nullif(secs / 60, 0), 4) AS rise_rate_per_min
FROM (SELECT *, lag(humidity_pct) OVER run AS before, {_SINCE_LAST} AS secs
      FROM sensor_data WHERE {_HUMIDITY_OK} WINDOW run AS {_RUN_ORDER})
WHERE round((humidity_pct - before) / nullif(secs / 60, 0), 4) > 3"""

_ELEVATION = f"""
SELECT run_id, count(*) AS samples_elevated, round(max(level), 2) AS peak_rolling_avg,
       round(avg(level), 2) AS mean_rolling_avg
FROM (SELECT run_id, avg(humidity_pct) OVER (
               {_RUN_ORDER[1:-1]} ROWS BETWEEN 10 PRECEDING AND CURRENT ROW) AS level
      FROM sensor_data WHERE {_HUMIDITY_OK})
WHERE level > 70 GROUP BY run_id"""

_DISORDER = """
SELECT * FROM (
  SELECT run_id, seq, timestamp_utc,
         lag(timestamp_utc) OVER (PARTITION BY run_id ORDER BY seq) AS prev_time
  FROM (SELECT run_id, seq, CASE WHEN seq % 7 = 0 THEN timestamp_utc - INTERVAL 10 MINUTE
                                 ELSE timestamp_utc END AS timestamp_utc FROM sensor_data))
WHERE timestamp_utc < prev_time"""

_GAPS = """
SELECT *, seq - prev_seq - 1 AS missing FROM (
  SELECT run_id, seq, lag(seq) OVER (PARTITION BY run_id ORDER BY seq) AS prev_seq
  FROM sensor_data)
WHERE seq - prev_seq > 1"""

_PLAN_TICKS = """
SELECT run_id, tick / 10.0::DOUBLE AS t_s,
       greatest(from_m + CASE WHEN length_s > 0
           THEN (tick / 10.0::DOUBLE - start_s) / length_s ELSE 0.0::DOUBLE END
           * (to_m - from_m), 0) AS depth_m
FROM (SELECT *, unnest(generate_series(0, CAST(ceil(end_s * 10) AS BIGINT))) AS tick
      FROM (SELECT *, sum(length_s) OVER legs - length_s AS start_s,
                   sum(length_s) OVER legs AS end_s
            FROM (SELECT run_id, step, 0 AS leg, from_m, to_m,
                         abs(to_m - from_m) / 0.125::DOUBLE AS length_s FROM steps
                  UNION ALL
                  SELECT run_id, step, 1, to_m, to_m, hold_s FROM steps)
            WINDOW legs AS (PARTITION BY run_id ORDER BY step, leg ROWS UNBOUNDED PRECEDING)))
JOIN (SELECT run_id, sum(abs(to_m - from_m) / 0.125::DOUBLE + hold_s) AS total_s
      FROM steps GROUP BY run_id) USING (run_id)
WHERE tick / 10.0::DOUBLE >= start_s AND tick / 10.0::DOUBLE < end_s
  AND tick < round_even(total_s * 10, 0)"""

_PLAN_STEPS = """
SELECT run_id, step, to_m, hold_s,
       coalesce(lag(to_m) OVER (PARTITION BY run_id ORDER BY step), to_m) AS from_m
FROM (SELECT 'nation' || CAST(s_nationkey AS VARCHAR) AS run_id, s_suppkey AS step,
             (s_suppkey * 7) % 25 * 0.5::DOUBLE AS to_m,
             s_suppkey % 8 * 0.75::DOUBLE AS hold_s FROM supplier)"""

_SIGNALS = [f.name for f in SENSOR_SCHEMA if isinstance(f.dataType, T.DoubleType)]
_IDS = "timestamp_utc, seq, run_id"


def oracle_sql() -> dict[str, str]:
    """Per query: its SQL and its columns, "~" marking those rounded like the query's."""
    all_columns = [_IDS, *(f"~{name}" for name in _SIGNALS)]
    imu = [f"~{axis}" for axis in ACCEL_AXES]
    rates = ["run_id", "timestamp_utc", "seq", "~depth_m", "~delta_seconds"]
    rates.append("~vertical_rate_mps")
    scores = ["run_id", "timestamp_utc", "seq", "~accel_mag"]
    scores += ["~rolling_mean", "~rolling_std", "~z_score"]
    dive = ["run_id", "~max_depth_m", "~avg_depth_m", "~avg_descent_rate_mps"]
    dive += ["~avg_ascent_rate_mps", "~time_at_depth_seconds"]
    battery = ["~battery_voltage_v", "~battery_current_a"]
    deltas = ["~delta_voltage", "~delta_current"]
    energy = ["run_id", "~energy_wh"]
    everything = "SELECT * FROM sensor_data"
    any_imu = f"SELECT * FROM sensor_data WHERE coalesce({', '.join(ACCEL_AXES)}) IS NOT NULL"

    def counts(events: str, name: str) -> tuple[str, list[str]]:
        sql = f"SELECT run_id, count(*) AS {name} FROM ({events}) GROUP BY run_id"
        return sql, ["run_id", name]

    bodies: dict[str, tuple[str, list[str]]] = {
        "row_count": ("SELECT count(*) AS row_count FROM sensor_data", ["row_count"]),
        "preview": (
            f"{everything} ORDER BY run_id, timestamp_utc, seq LIMIT 10",
            all_columns,
        ),
        "filter_run": (f"{everything} WHERE run_id = 'run1'", all_columns),
        "energy_per_run": (_energy(_BATTERY_KNOWN), energy),
        "energy_per_run_unfiltered": (_energy(), energy),
        "voltage_sag_events": (
            _SAG,
            ["run_id", "timestamp_utc", "seq", *battery]
            + ["~baseline_voltage_v", "~baseline_current_a", *deltas],
        ),
        "voltage_sag_step": (_SAG_STEP, ["run_id", "timestamp_utc", *battery, *deltas]),
        "voltage_sag_step_counts": counts(_SAG_STEP, "event_count"),
        "avg_voltage": (
            f"SELECT {_from_units('volts')} / samples AS avg_voltage_v FROM (SELECT"
            f" {_units('battery_voltage_v')} AS volts, count(battery_voltage_v) AS samples"
            " FROM sensor_data)",
            ["~avg_voltage_v"],
        ),
        "max_depth": (
            "SELECT max(depth_m) AS max_depth_m FROM sensor_data",
            ["~max_depth_m"],
        ),
        "vertical_rates": (_RATES, rates),
        "depth_run_summary": (_depth_summary(_RATES), dive),
        "depth_run_summary_unfiltered": (_depth_summary(_rates("TRUE")), dive),
        "run_phase_segments": (_PHASES, [*rates, "phase"]),
        "phase_summary": (
            f"""
SELECT run_id, phase, rows_seen, {_from_units("seconds")} AS phase_seconds,
       {_from_units("amperes")} / currents AS avg_current_a,
       {_from_units("volts")} / voltages AS avg_voltage_v,
       {_from_units("joules")} / 3600 AS energy_wh
FROM (SELECT run_id, phase, count(*) AS rows_seen, {_units("delta_seconds")} AS seconds,
             {_units("battery_current_a")} AS amperes, count(battery_current_a) AS currents,
             {_units("battery_voltage_v")} AS volts, count(battery_voltage_v) AS voltages,
             {_units("battery_voltage_v * battery_current_a * delta_seconds")} AS joules
      FROM ({_PHASES}) GROUP BY run_id, phase)""",
            ["run_id", "phase", "rows_seen", "~phase_seconds"]
            + ["~avg_current_a", "~avg_voltage_v", "~energy_wh"],
        ),
        "accel_zscores": (_ZSCORES, scores),
        "accel_zscores_wide": (_wide(_ZSCORES), scores),
        "motion_anomalies": (_ANOMALIES, scores),
        "motion_anomalies_unfiltered": (
            f"SELECT * FROM ({_zscores('TRUE')}) WHERE abs(z_score) >= 3",
            scores,
        ),
        "motion_anomaly_counts": counts(_ANOMALIES, "anomaly_count"),
        "motion_zscore_summary_exact": (
            _ZSCORE_SUMMARY,
            ["run_id", "rows_seen", "~max_abs_z_score", "~avg_abs_z_score"]
            + ["~p95_abs_z_score", "~p99_abs_z_score"],
        ),
        "motion_zscore_summary": (
            _ZSCORE_SUMMARY,
            ["run_id", "rows_seen", "~max_abs_z_score", "~avg_abs_z_score"]
            + ["~p95_abs_z_score", "~p99_abs_z_score"],
        ),
        "humidity_clean": (
            f"{everything} WHERE {_HUMIDITY_OK}",
            [_IDS, "~humidity_pct"],
        ),
        "humidity_summary": (
            f"""
SELECT run_id, round(min(humidity_pct), 2) AS min_pct, round(avg(humidity_pct), 2) AS avg_pct,
       round(max(humidity_pct), 2) AS max_pct,
       round(max(humidity_pct) - min(humidity_pct), 2) AS total_rise_pct
FROM sensor_data WHERE {_HUMIDITY_OK} GROUP BY run_id""",
            ["run_id", "~min_pct", "~avg_pct", "~max_pct", "~total_rise_pct"],
        ),
        "humidity_breach_streaks": (
            _STREAKS,
            ["run_id", "streak_start", "streak_end", "consecutive_samples"]
            + ["~peak_humidity"],
        ),
        "humidity_breach_counts": counts(_STREAKS, "streak_count"),
        "humidity_rapid_rise": (
            _RAPID_RISE,
            ["run_id", "timestamp_utc", "~humidity_pct", "~prev_humidity"]
            + ["~dt_minutes", "~rise_rate_per_min"],
        ),
        "humidity_rapid_rise_counts": counts(_RAPID_RISE, "rapid_rise_count"),
        "humidity_rolling_elevation": (
            _ELEVATION,
            ["run_id", "samples_elevated", "~peak_rolling_avg", "~mean_rolling_avg"],
        ),
        "humidity_rolling_elevation_wide": (
            _wide(_ELEVATION),
            ["run_id", "samples_elevated", "~peak_rolling_avg", "~mean_rolling_avg"],
        ),
        "seq_gaps": (_GAPS, ["run_id", "prev_seq", "seq", "missing"]),
        "drop_all_null_rows": (any_imu, [_IDS, *imu]),
        "timestamp_disorder": (
            _DISORDER,
            ["run_id", "seq", "prev_time", "timestamp_utc"],
        ),
        "parse_time_columns": (
            "SELECT CASE WHEN seq % 10 <> 0 THEN timestamp_utc END AS timestamp_utc,"
            " seq, run_id FROM sensor_data",
            [_IDS],
        ),
        "ingest_csv": (everything, all_columns),
        "ingest_csv_dirty": (
            "SELECT seq + 3000000000 AS seq, lpad(CAST(seq % 9 AS VARCHAR), 3, '0') AS source,"
            " run_id, CASE WHEN seq % 5 <> 0 THEN 'at, ' ||"
            " strftime(timestamp_utc, '%Y-%m-%dT%H:%M:%S.%gZ') END AS seen_time"
            " FROM sensor_data",
            ["seq", "source", "run_id", "seen_time"],
        ),
        "split_csv": (
            f"SELECT {_IDS}, battery_voltage_v, battery_current_a, NULL::DOUBLE AS depth_m"
            " FROM sensor_data WHERE battery_voltage_v IS NOT NULL OR battery_current_a IS NOT NULL"
            f" UNION ALL SELECT {_IDS}, NULL, NULL, depth_m FROM sensor_data"
            " WHERE depth_m IS NOT NULL",
            [_IDS, *battery, "~depth_m"],
        ),
        "convert_csv_raw": (
            "SELECT * REPLACE (strftime(timestamp_utc, '%Y-%m-%dT%H:%M:%S.%gZ')"
            " AS timestamp_utc) FROM sensor_data",
            all_columns,
        ),
        "read_sensor_data": (everything, all_columns),
        "create_sensor_table": (everything, all_columns),
        "split_by_column": (
            " UNION ALL ".join(
                f"SELECT {_IDS}, {name} AS reading, '{name}' AS signal FROM sensor_data"
                f" WHERE {name} IS NOT NULL"
                for name in _SIGNALS
            ),
            [_IDS, "~reading", "signal"],
        ),
        "split_by_groups": (any_imu, [_IDS, *imu]),
        "split_by_keywords": (
            f"{everything} WHERE battery_voltage_v IS NOT NULL"
            " OR battery_current_a IS NOT NULL",
            [_IDS, *battery],
        ),
        "register_views": (
            f"SELECT * FROM ({_energy(_BATTERY_KNOWN)}) JOIN ({_depth_summary(_RATES)})"
            f" USING (run_id) JOIN ({_ZSCORE_SUMMARY}) USING (run_id)",
            ["run_id", "~energy_wh", "~max_depth_m", "~max_abs_z_score"],
        ),
        "dive_plan_profile": (_PLAN_TICKS, ["run_id", "~t_s", "~depth_m"]),
    }
    bodies["refresh_outputs"] = bodies["catalog_views"] = (
        " UNION ALL ".join(_long_form(name, *bodies[name]) for name in VIEWS),
        ["output", "run_id", "seq", "label", "measure", "~reading"],
    )
    bodies["detect_events"] = (
        " UNION ALL ".join(_long_form(name, *bodies[name]) for name in detectors()),
        ["output", "run_id", "seq", "label", "measure", "~reading"],
    )
    corpus_sql = {} if corpus is None else corpus.ORACLE_SQL
    return corpus_sql | {
        name: f"WITH sensor_data AS ({_SENSOR_DATA}), steps AS ({_PLAN_STEPS}), "
        f"result AS ({sql})\nSELECT {', '.join(map(_final, columns))} FROM result"
        for name, (sql, columns) in bodies.items()
    }


def _long_form(name: str, sql: str, columns: list[str]) -> str:
    """A row for each number of a result that is not NULL."""
    names = [c.lstrip("~") for part in columns for c in part.split(", ")]
    seq = "seq" if "seq" in names else "NULL::INTEGER"
    phase = "phase" if "phase" in names else "NULL::VARCHAR"
    return " UNION ALL ".join(
        f"SELECT '{name}' AS output, run_id, {seq} AS seq, {phase} AS label, '{c}' AS measure,"
        f" CAST({c} AS DOUBLE) AS reading FROM ({sql}) WHERE {c} IS NOT NULL"
        for c in names
        if c not in ("run_id", "timestamp_utc", "seq", "phase")
    )


def _wide(sql: str) -> str:
    return sql.replace("10 PRECEDING", "600 PRECEDING")


def _final(column: str) -> str:
    if not column.startswith("~"):
        return column
    name = column[1:]
    return f"round({name} * 1e6) / 1e6 + 0.0::DOUBLE AS {name}"
