"""Publishing the table of samples and the results by name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from soundings.operators.depth import depth_run_summary, run_phase_segments
from soundings.operators.electrical import energy_per_run, voltage_sag_events
from soundings.operators.motion import motion_anomalies, motion_zscore_summary
from soundings.plans.cells import DEFAULT_SIZE, CellSize
from soundings.schema import RUN, SENSOR_SCHEMA
from soundings.sources import views
from soundings.sources.tables import GROUP, run_group

VIEWS = {
    "energy_per_run": energy_per_run,
    "depth_run_summary": depth_run_summary,
    "run_phase_segments": run_phase_segments,
    "voltage_sag_events": voltage_sag_events,
    "motion_anomalies": motion_anomalies,
    "motion_zscore_summary": motion_zscore_summary,
}


def register_views(
    spark: SparkSession, df: DataFrame, size: CellSize = DEFAULT_SIZE
) -> list[str]:
    """Publish ``df`` as ``sensor_data`` and the six results as views, replacing earlier ones.

    Nothing is computed here; a view is evaluated whenever it is queried.
    """
    df.createOrReplaceTempView("sensor_data")
    for name, operator in VIEWS.items():
        operator(df, size=size).createOrReplaceTempView(name)
    return ["sensor_data", *VIEWS]


def create_sensor_table(
    spark: SparkSession, location: str, name: str = "sensor_data"
) -> DataFrame:
    """Declare an external table over Parquet files that have the canonical types."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in SENSOR_SCHEMA)
    where = location.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{where}'"
    )
    return spark.table(name)


def publish_sensor_data(
    spark: SparkSession,
    location: str,
    name: str = "sensor_data",
    by_run: bool = False,
    run_groups: int | None = None,
) -> list[str]:
    """Publish the files below ``location`` and the six results for every session of the catalog.

    ``<name>_files`` is an external table over the files as they are stored, whose counters may have 32
    or 64 bits; ``name`` is a view of it with the canonical types, and next to it stand the results as
    ``<name>_energy_per_run`` and so on. With ``by_run`` the files lie in directories ``run_id=...``, of which
    a query for some runs reads theirs only. Call again when directories have been added.

    A directory per run costs a file or more for each, so very many short runs are better written with
    ``write_sensor_data(run_groups=n)`` and published with the same ``n`` next to ``by_run``: then
    ``run_group=...`` has the runs of a group, and ``run_id = '...'`` finds its own. A run in another
    group than its own would be missed, so that such files are refused.

    The views are SQL, and a run's window is one task; for longer runs there are the operators.
    """
    files = f"{name}_files"
    stored = [(f.name, "bigint" if f.name == "seq" else f.dataType.simpleString()) for f in SENSOR_SCHEMA]
    columns = ", ".join(f"`{column}` {kind}" for column, kind in stored)
    if by_run and run_groups:
        columns += f", {GROUP} int"
    layout = f"PARTITIONED BY ({GROUP if run_groups else RUN})" if by_run else ""
    where = location.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {files} ({columns}) USING parquet {layout} LOCATION '{where}'"
    )
    if by_run:
        spark.sql(f"ALTER TABLE {files} RECOVER PARTITIONS")
    spark.catalog.refreshTable(files)
    canonical = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in SENSOR_SCHEMA)
    own = ""
    if by_run and run_groups:
        strays = spark.table(files).where(F.col(GROUP) != run_group(run_groups)).select(RUN).take(1)
        if strays:
            raise ValueError(f"{location}: run {strays[0][0]!r} is not in its group of {run_groups}")
        # True of every row; with a run given, it is a constant, which tells the directory.
        own = f" WHERE {GROUP} = CAST(pmod(xxhash64({RUN}), {run_groups}) AS int)"
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {canonical} FROM {files}{own}")
    made = {f"{name}_{view}": sql for view, sql in views.results(name).items()}
    for view, sql in made.items():
        spark.sql(f"CREATE OR REPLACE VIEW {view} AS {sql}")
    return [files, name, *made]
