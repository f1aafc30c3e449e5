"""Parquet tables of samples."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soundings.functions.columns import instant_from_ntz
from soundings.schema import RUN, SENSOR_SCHEMA

GROUP = "run_group"

_NANOS_AS_LONG = "spark.sql.legacy.parquet.nanosAsLong"


def read_sensor_data(spark: SparkSession, path: str) -> DataFrame:
    """All run files below ``path`` as one table with the canonical columns, matched by name."""
    session = reading_session(spark, path)
    df = canonical(session.read.schema(stored_schema(session, path)).parquet(path))
    if session is spark:
        return df
    # Begun in the caller's session, to which views and writes then belong.
    return spark.createDataFrame([], df.schema).unionByName(df)


def reading_session(spark: SparkSession, path: str) -> SparkSession:
    """The session to read sample files with: the caller's, or one like it for nanosecond times.

    These are readable only as integers, which is a setting of a session. The caller's stays as it is.
    """
    try:
        spark.read.parquet(path)
    except AnalysisException as refused:
        if refused.getCondition() != "PARQUET_TYPE_ILLEGAL":
            raise
    else:
        return spark
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set(_NANOS_AS_LONG, "true")
    return session


def stored_schema(spark: SparkSession, path: str) -> T.StructType:
    """The schema to read sample files with: 64-bit integers fit files of either width, and
    partition values such as "007" stay text."""

    def readable(field: T.StructField) -> T.StructField:
        if field.name == "run_id":
            return T.StructField(field.name, T.StringType())
        if isinstance(field.dataType, T.IntegerType):
            return T.StructField(field.name, T.LongType())
        return field

    return T.StructType([readable(f) for f in spark.read.parquet(path).schema])


def canonical(df: DataFrame) -> DataFrame:
    """The canonical columns in order with their types, plus ``source`` if there is one."""
    types = {f.name: f.dataType for f in df.schema}
    columns = [_as_declared(field, types.get(field.name)) for field in SENSOR_SCHEMA]
    if "source" in types:
        columns.append(F.col("source").cast("string"))
    return df.select(*columns)


def _as_declared(field: T.StructField, found: T.DataType | None) -> Column:
    value = F.col(field.name)
    if found is None:
        return F.lit(None).cast(field.dataType).alias(field.name)
    if found == field.dataType:
        return value
    if isinstance(field.dataType, T.TimestampType):
        if isinstance(found, T.TimestampNTZType):
            return instant_from_ntz(value).alias(field.name)
        if isinstance(found, T.LongType):
            return F.timestamp_micros(F.floor(value / 1000)).alias(field.name)
    return value.cast(field.dataType).alias(field.name)


def run_group(groups: int) -> Column:
    """The number of the group a run belongs to, by its hash."""
    return F.pmod(F.xxhash64(F.col(RUN)), F.lit(groups)).cast("int")


def write_sensor_data(
    df: DataFrame,
    out: str,
    partition_by_run: bool = False,
    run_groups: int | None = None,
    mode: str = "overwrite",
) -> str:
    """Write samples as Parquet, replacing what is at ``out`` unless ``mode`` says otherwise.

    With ``partition_by_run`` a run has a directory of its own. With ``run_groups`` the runs share that many
    directories, whatever their number, and lie sorted in the files of theirs.
    """
    if run_groups:
        # Rows of a group together, large groups by several tasks.
        df = df.withColumn(GROUP, run_group(run_groups)).hint("rebalance", GROUP)
        df = df.sortWithinPartitions(GROUP, RUN)
        df.write.mode(mode).partitionBy(GROUP).parquet(out)
        return out
    writer = df.write.mode(mode)
    if partition_by_run:
        writer = writer.partitionBy("run_id")
    writer.parquet(out)
    return out
