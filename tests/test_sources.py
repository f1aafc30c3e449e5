"""Reading, converting, splitting and publishing samples."""

from __future__ import annotations

import json
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from frames import START, battery, depth, samples
from pyspark.sql import functions as F

import soundings as s
from soundings.schema import SENSOR_SCHEMA
from soundings.sources.csv import id_columns, read_csv_text
from soundings.sources.split import groups_from_keywords, output_name
from soundings.sources.tables import canonical, run_group

IDS = ["timestamp_utc", "seq", "run_id"]

LOG = """\
timestamp_utc,seq,run_id,battery_voltage_v,depth_m,note,level,ok,mixed
2026-02-05T16:21:00.100Z,0,007,16.0,,a,1,true,1

2026-02-05 16:21:00.2,1,007,NA,1.5,b,2,False,x
not a time,2,007,NaN,n/a,,,,
2026-02-05T18:21:00.300+02:00,3,007,junk,2,NULL,4,true,2.5
1770308460400000000,4,007,,,,,,
,5,007,-1.25e1,,,,,
"""


@pytest.fixture
def log(tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(LOG)
    return str(path)


def _by_seq(df):
    return sorted(df.collect(), key=lambda r: r.seq)


def test_csv_values(spark, log, tmp_path):
    out = s.ingest_csv(spark, log, str(tmp_path / "out"))
    df = spark.read.parquet(out)
    assert df.columns == LOG.splitlines()[0].split(",")
    assert dict(df.dtypes) == {
        "timestamp_utc": "timestamp",
        "seq": "int",
        "run_id": "string",
        "battery_voltage_v": "double",
        "depth_m": "double",
        "note": "string",
        "level": "bigint",
        "ok": "boolean",
        "mixed": "string",
    }
    rows = _by_seq(df)
    assert [r.seq for r in rows] == [0, 1, 2, 3, 4, 5]
    start = START.replace(tzinfo=None)
    passed = [r.timestamp_utc and (r.timestamp_utc - start).total_seconds() for r in rows]
    assert passed == [0.1, 0.2, None, 0.3, 0.4, None]
    assert {r.run_id for r in rows} == {"007"}
    assert [r.battery_voltage_v for r in rows] == [16.0, None, None, None, None, -12.5]
    assert [r.depth_m for r in rows] == [None, 1.5, None, 2.0, None, None]
    assert [r.note for r in rows] == ["a", "b", None, None, None, None]
    assert [r.level for r in rows] == [1, 2, None, 4, None, None]


def test_times_do_not_depend_on_the_session_zone(spark, log):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        micros = s.read_sensor_csv(spark, log).selectExpr("seq", "unix_micros(timestamp_utc) t")
        times = [r.t for r in _by_seq(micros)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = 1_770_308_460_000_000
    assert times == [base + 100_000, base + 200_000, None, base + 300_000, base + 400_000, None]


def test_empty_rows_are_dropped_on_request_only(spark, log, tmp_path):
    kept = s.ingest_csv(spark, log, str(tmp_path / "a"), drop_all_null_rows=True)
    assert [r.seq for r in _by_seq(spark.read.parquet(kept))] == [0, 1, 3, 5]
    ids_only = spark.read.parquet(kept).select(*IDS)
    assert s.drop_all_null_rows(ids_only, IDS).count() == 4


def test_raw_conversion_keeps_times_as_text(spark, log, tmp_path):
    df = spark.read.parquet(s.convert_csv_raw(spark, log, str(tmp_path / "out")))
    assert [r.timestamp_utc for r in _by_seq(df)][2] == "not a time"


def test_directory_of_logs_with_different_headers_is_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("seq,run_id,depth_m\n1,a,2.0\n")
    (tmp_path / "b.csv").write_text("seq,depth_m,run_id\n1,2.0,a\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_text(spark, str(tmp_path)).collect()


def test_partitioned_ingest_prunes_runs(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text("seq,run_id,depth_m\n1,007,1.0\n2,7,2.0\n")
    out = s.ingest_csv(spark, str(path), str(tmp_path / "out"), partition_by_run=True)
    df = s.read_sensor_data(spark, out)
    assert [r.depth_m for r in s.filter_run(df, "007").collect()] == [1.0]
    plan = s.filter_run(df, "007")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_identifier_columns_keep_the_preferred_order():
    assert id_columns(["depth_m", "run_id", "seq"]) == ["seq", "run_id"]
    assert id_columns(["depth_m"]) == []


def _pandas_like_file(path, unit, counter, **extra):
    n = 3
    times = [1_770_308_460_000 + 100 * i for i in range(n)]
    scale = {"ms": 1, "us": 10**3, "ns": 10**6}[unit]
    stamp = pa.array([t * scale for t in times], pa.timestamp(unit, extra.get("tz")))
    pq.write_table(
        pa.table(
            {
                "imu_az_mps2": pa.array([9.8] * n),
                "run_id": pa.array(["r"] * n),
                "seq": pa.array(range(n), counter),
                "timestamp_utc": stamp,
                "depth_m": pa.array([1.0, None, 3.0]),
            }
        ),
        path,
    )


@pytest.mark.parametrize("unit, tz", [("ms", "UTC"), ("us", None), ("us", "UTC"), ("ns", "UTC"), ("ns", None)])
@pytest.mark.parametrize("counter", [pa.int32(), pa.int64()])
def test_run_files_of_other_writers(spark, tmp_path, unit, tz, counter):
    _pandas_like_file(tmp_path / "r.parquet", unit, counter, tz=tz)
    df = s.read_sensor_data(spark, str(tmp_path))
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in SENSOR_SCHEMA]
    rows = _by_seq(df)
    assert [r.timestamp_utc for r in rows] == [
        datetime(2026, 2, 5, 16, 21, 0, 100_000 * i) for i in range(3)
    ]
    assert [r.depth_m for r in rows] == [1.0, None, 3.0]
    assert rows[0].humidity_pct is None and rows[0].imu_az_mps2 == 9.8


def test_many_run_files_form_one_table(spark, tmp_path):
    _pandas_like_file(tmp_path / "a.parquet", "us", pa.int32())
    _pandas_like_file(tmp_path / "b.parquet", "us", pa.int64())
    assert s.read_sensor_data(spark, str(tmp_path)).count() == 6


def test_source_column_is_carried(spark):
    df = samples(spark, A=[depth(0, 1.0)]).selectExpr("*", "'logger' AS source", "1 AS extra")
    assert canonical(df).columns == [f.name for f in SENSOR_SCHEMA] + ["source"]


@pytest.mark.parametrize(
    "name, expected",
    [(" A/B  c ", "a_b_c"), ("__x__", "x"), ("a.b-c_9", "a.b-c_9"), ("///", "out"), ("", "out")],
)
def test_output_names(name, expected):
    assert output_name(name) == expected


def test_keyword_groups():
    columns = [*IDS, "Battery_V", "battery_current_a", "depth_m", "run_depth"]
    groups = groups_from_keywords(
        columns, {"b": ["BATTERY_"], "d": ["depth", "_v"], "none": ["sonar"], "ids": ["seq"]}, IDS
    )
    assert groups == {
        "b": ["Battery_V", "battery_current_a"],
        "d": ["Battery_V", "depth_m", "run_depth"],
    }


@pytest.fixture
def sparse(spark):
    return samples(spark, A=[battery(0, 1.0, None), depth(1, 2.0), battery(2, None, 3.0)])


def test_split_by_column(spark, sparse, tmp_path):
    paths = s.split_by_column(sparse.select(*IDS, "depth_m", "battery_voltage_v"), str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["depth_m", "battery_voltage_v"]
    (row,) = spark.read.parquet(paths[0]).collect()
    assert (row.seq, row.depth_m) == (1, 2.0)


def test_split_by_groups(spark, sparse, tmp_path):
    groups = {" A/B  c ": ["battery_voltage_v", "battery_current_a", "seq", "nope"], "no": ["nope"]}
    (path,) = s.split_by_groups(sparse, str(tmp_path), groups)
    df = spark.read.parquet(path)
    assert path.endswith("/a_b_c")
    assert df.columns == [*IDS, "battery_voltage_v", "battery_current_a"]
    assert [r.seq for r in _by_seq(df)] == [0, 2]


def test_split_refuses_colliding_names_and_missing_ids(spark, sparse, tmp_path):
    with pytest.raises(ValueError, match="share"):
        s.split_by_groups(sparse, str(tmp_path), {"a b": ["depth_m"], "A_B": ["depth_m"]})
    with pytest.raises(ValueError, match="identifier"):
        s.split_by_column(sparse.select("depth_m"), str(tmp_path))


def test_no_number_is_cut_and_other_times_stay_text(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text("seq,source,log_time,timestamp_utc\n3000000000,007,2026-01-01 00:00:00,x\n7.0,8\n")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        found = s.read_sensor_csv(spark, str(path), id_cols=["source", "seq"])
        rows = [tuple(r) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert rows[0][:2] == (3000000000, "007") and rows[0][3] == "x"
    assert rows[1] == (7, "8", None, None)
    path.write_text("seq,run_id\n3.7,a\njunk,b\n5,c\n")
    assert [r.seq for r in s.read_sensor_csv(spark, str(path)).collect()] == [3.7, None, 5.0]
    named = s.read_sensor_csv(spark, str(path), types={"seq": "string"})
    assert [r.seq for r in named.collect()] == ["3.7", "junk", "5"]


def test_surplus_fields_are_refused(spark, tmp_path):
    path = tmp_path / "wide.csv"
    path.write_text('seq,run_id,note\n1,a,"x,y"\n2,b\n')
    assert read_csv_text(spark, str(path)).count() == 2
    path.write_text('seq,run_id,note\n1,a,"x,y",EXTRA\n')
    with pytest.raises(Exception, match="more fields"):
        read_csv_text(spark, str(path)).collect()


def test_split_csv(spark, log, tmp_path):
    config = tmp_path / "groups.json"
    config.write_text(json.dumps({"electric": ["battery_voltage_v"]}))
    (by_group,) = s.split_csv(
        spark, log, str(tmp_path / "g"), mode="group", groups=str(config), keywords={"d": ["depth"]}
    )
    assert by_group.endswith("/electric")
    (by_word,) = s.split_csv(spark, log, str(tmp_path / "k"), mode="group", keywords={"d": ["DEPTH"]})
    assert [r.depth_m for r in _by_seq(spark.read.parquet(by_word))] == [1.5, 2.0]
    assert len(s.split_csv(spark, log, str(tmp_path / "c"))) == 6
    with pytest.raises(ValueError, match="mode"):
        s.split_csv(spark, log, str(tmp_path / "x"), mode="row")
    with pytest.raises(ValueError, match="members or keywords"):
        s.split_csv(spark, log, str(tmp_path / "x"), mode="group")


def test_views_are_replaced_and_lazy(spark):
    first = samples(spark, A=[battery(0, 10.0, 1.0), battery(1, 10.0, 1.0)])
    second = samples(spark, B=[battery(0, 10.0, 1.0), battery(1, 10.0, 1.0)])
    assert len(s.register_views(spark, first)) == 7
    s.register_views(spark, second)
    assert [r.run_id for r in spark.table("energy_per_run").collect()] == ["B"]
    assert spark.table("motion_anomalies").columns[-1] == "z_score"


def test_external_table(spark, tmp_path):
    path = s.write_sensor_data(samples(spark, A=[depth(0, 1.0)]), str(tmp_path / "t"))
    table = s.create_sensor_table(spark, path, "sensor_files")
    again = s.create_sensor_table(spark, path, "sensor_files")
    assert table.schema == again.schema == SENSOR_SCHEMA
    assert [r.depth_m for r in again.collect()] == [1.0]
    spark.sql("DROP TABLE sensor_files")


def test_preview_and_count(spark):
    df = samples(spark, B=[depth(t, 1.0) for t in range(9)], A=[depth(t, 1.0) for t in range(9)])
    assert [r.run_id for r in s.preview(df).collect()] == ["A"] * 9 + ["B"]
    assert s.row_count(df).first().row_count == 18


@pytest.mark.parametrize("select", [["seq"], ["run_id", "note"], ["note"]])
def test_surplus_fields_are_refused_under_any_selection(spark, tmp_path, select):
    path = tmp_path / "wide.csv"
    path.write_text("seq,run_id,note\n1,a,x\n2,b,y,EXTRA\n")
    text = read_csv_text(spark, str(path))
    for look in (lambda: text.select(*select).collect(), text.count):
        with pytest.raises(Exception, match="more fields"):
            look()


def _csv_scans(spark, action):
    """Queries that scan CSV by a schema, as the session's own record of executions has them."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    action()
    plans = [store.executionsList().apply(i).physicalPlanDescription() for i in range(before, store.executionsCount())]
    return sum("Scan csv" in plan for plan in plans)


def test_csv_is_parsed_once(spark, tmp_path):
    path, out = tmp_path / "run.csv", str(tmp_path / "out")
    path.write_text("seq,run_id,depth_m,extra\n1,a,1.5,yes\n2,a,NA,7\n")
    assert _csv_scans(spark, lambda: s.ingest_csv(spark, str(path), out)) == 1
    assert spark.read.parquet(out).dtypes[-1] == ("extra", "string")
    types = {"seq": "int", "extra": "string"}
    assert _csv_scans(spark, lambda: s.ingest_csv(spark, str(path), out, types=types)) == 1
    assert [r.seq for r in spark.read.parquet(out).collect()] == [1, 2]
    paths = s.split_csv(spark, str(path), str(tmp_path / "split"), types={"extra": "string"})
    assert len(paths) == 2
    shared = tmp_path / "empty.csv"
    shared.write_text("seq,run_id,other\n")
    s.ingest_csv(spark, str(shared), out)
    assert spark.read.parquet(out).count() == 0


def test_published_views_are_seen_by_any_session(spark, tmp_path):
    runs = {f"r{n}": [battery(t, 16.0, 1.0) | depth(t, float(t)) for t in range(4)] for n in range(3)}
    df = samples(spark, **runs)
    place = str(tmp_path / "by_run")
    s.write_sensor_data(df.where("run_id <> 'r2'"), place, partition_by_run=True)
    names = s.publish_sensor_data(spark, place, "fleet", by_run=True)
    other = spark.newSession()
    assert len(names) == 8 and other.table("fleet").schema == SENSOR_SCHEMA
    assert other.table("fleet").count() == 8
    late = df.where("run_id = 'r2'").withColumn("seq", F.col("seq").cast("bigint")).drop("run_id")
    late.write.parquet(f"{place}/run_id=r2")
    s.publish_sensor_data(spark, place, "fleet", by_run=True)
    assert spark.newSession().table("fleet").count() == 12
    for name in names[2:]:
        operator = getattr(s, name.removeprefix("fleet_"))
        expected = sorted(map(tuple, operator(df).collect()), key=repr)
        assert sorted(map(tuple, spark.newSession().table(name).collect()), key=repr) == expected
    one = spark.table("fleet").where("run_id = 'r2'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_many_runs_share_few_directories(spark, tmp_path):
    runs = {f"r{n}": [battery(t, 16.0, 1.0) | depth(t, float(t)) for t in range(2)] for n in range(60)}
    df = samples(spark, **runs, lost=[battery(0, 15.0, 1.0) | {"run_id": None}])
    place = tmp_path / "grouped"
    for half in (0, 1):
        own = df.where(run_group(4) % 2 == half)
        s.write_sensor_data(own, str(place), run_groups=4, mode="append")
        names = s.publish_sensor_data(spark, str(place), "crowd", by_run=True, run_groups=4)
    assert len([d for d in place.iterdir() if d.is_dir()]) == 4
    table = spark.newSession().table("crowd")
    assert table.schema == SENSOR_SCHEMA
    assert sorted(map(tuple, table.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    for name in names[2:]:
        operator = getattr(s, name.removeprefix("crowd_"))
        expected = sorted(map(tuple, operator(df).collect()), key=repr)
        assert sorted(map(tuple, spark.newSession().table(name).collect()), key=repr) == expected
    one = table.where("run_id = 'r7'")
    assert one.count() == 2
    (group,) = {row[0] for row in df.where("run_id = 'r7'").select(run_group(4)).collect()}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_group" in plan and f" = {group})]" in plan
    with pytest.raises(ValueError, match="not in its group of 5"):
        s.publish_sensor_data(spark, str(place), "crowd", by_run=True, run_groups=5)


def test_nanoseconds_leave_the_session_alone(spark, tmp_path):
    times = pa.array([START.timestamp() * 1e9 // 1 + 1500 * n for n in range(2)]).cast(pa.int64())
    table = pa.table({
        "timestamp_utc": times.cast(pa.timestamp("ns", tz="UTC")),
        "seq": pa.array([1, 2], pa.int64()),
        "run_id": ["a", "a"],
        "depth_m": [1.0, 2.0],
    })
    pq.write_table(table, str(tmp_path / "nanos.parquet"), version="2.6")
    setting = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(setting)
    df = s.read_sensor_data(spark, str(tmp_path))
    assert df.sparkSession is spark and spark.conf.get(setting) == before == "false"
    rows = df.orderBy("seq").collect()
    assert [r.depth_m for r in rows] == [1.0, 2.0]
    micros = df.selectExpr("unix_micros(timestamp_utc) % 1000000 AS m").orderBy("m").collect()
    assert [r.m for r in micros] == [0, 1]
    s.register_views(spark, df)
    assert spark.table("sensor_data").count() == 2
