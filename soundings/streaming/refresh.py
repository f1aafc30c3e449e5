"""Keeping stored results up to date as run files arrive.

Samples that arrive are kept by run: each run belongs to one of a fixed number of hash buckets, and
samples and results are stored below ``out_dir`` in a directory per refresh and bucket.

* ``samples/batch=<n>/bucket=<k>``: the samples that arrived with refresh ``n``;
* ``files/batch=<n>``: the files they came from, so that no file is ever taken in twice;
* ``<operator>/batch=<n>/bucket=<k>``: its results for all runs of the buckets refresh ``n`` touched;
* ``refreshed/batch=<n>``: these buckets. Written last, it is what makes the refresh count.

A late file can change every result of its run, so a touched bucket is computed anew from all its
samples, and only the directories of touched buckets are read and written: a refresh costs what its
buckets hold, not what the history holds. The result of a bucket is that of its newest refresh, which
may be that it has no events any more. Nothing stored is overwritten, so readers never see a
refresh half done. A refresh's number follows from what is stored, not from the checkpoint: one that
failed is repeated under the same number, and after a lost checkpoint numbers go on.
:func:`compact_outputs` stores everything as one refresh; older ones are not read again.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import or_

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soundings.schema import RUN
from soundings.sources.catalog import VIEWS
from soundings.sources.tables import canonical, reading_session, stored_schema

BUCKETS = 256

_BATCH = "batch"
_BUCKET = "bucket"
_FILE = "_file"
_SAMPLES = "samples"
_FILES = "files"
_LAYOUT = "layout"
_REFRESHED = "refreshed"
_COMPACTED = "compacted"
_WRITES_AT_ONCE = 3


def refresh_outputs(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    operators: Mapping[str, Callable[[DataFrame], DataFrame]] = VIEWS,
    buckets: int = BUCKETS,
) -> None:
    """Take in the files added to ``in_dir`` since the last call and bring the results up to date.

    ``buckets`` counts for the first refresh into ``out_dir``, which fixes it. A bucket should
    hold no more samples than one wants to read again for a late file.
    """
    spark = reading_session(spark, in_dir)
    schema = stored_schema(spark, in_dir)

    def refresh(arrived: DataFrame, batch_id: int) -> None:
        session = arrived.sparkSession
        number = _newest(session, out_dir, _REFRESHED) + 1
        since = _newest(session, out_dir, _COMPACTED)
        own = _bucket(_layout(session, out_dir, buckets))
        files = _store(arrived.select(_FILE).distinct(), out_dir, _FILES, number)
        new = canonical(_not_seen(arrived, files, out_dir, number))
        new = _store(new.withColumn(_BUCKET, own), out_dir, _SAMPLES, number, by_bucket=True)
        # No more rows than there are buckets.
        touched = [row[_BUCKET] for row in new.select(_BUCKET).distinct().collect()]
        if not touched:
            return
        samples = _samples(session, out_dir, new.drop(_BUCKET).schema, since, number)
        samples = samples.where(F.col(_BUCKET).isin(touched)).drop(_BATCH, _BUCKET)

        def renew(name: str) -> None:
            result = operators[name](samples).withColumn(_BUCKET, own)
            _store(result, out_dir, name, number, by_bucket=True)

        # The operators do not depend on each other, and one alone seldom fills a cluster.
        with ThreadPoolExecutor(_WRITES_AT_ONCE) as pool:
            list(pool.map(inheritable_thread_target(session)(renew), operators))
        counts = session.createDataFrame([(k,) for k in touched], f"{_BUCKET} int")
        _store(counts, out_dir, _REFRESHED, number)

    query = (
        spark.readStream.schema(schema)
        .parquet(in_dir)
        .select("*", F.col("_metadata.file_path").alias(_FILE))
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_output(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """The current result of an operator: for each bucket of runs, the rows of its newest refresh."""
    return _current(spark, out_dir, name, _newest(spark, out_dir, _COMPACTED)).drop(_BATCH, _BUCKET)


def read_samples(spark: SparkSession, out_dir: str, run_id: str | None = None) -> DataFrame:
    """All samples taken in, or those of one run, for which only the directories of its bucket are read."""
    newest = _newest(spark, out_dir, _REFRESHED)
    stored = spark.read.parquet(_path(out_dir, _SAMPLES))
    stored = stored.where(F.col(_BATCH).between(_newest(spark, out_dir, _COMPACTED), newest))
    if run_id is not None:
        buckets = spark.read.parquet(_path(out_dir, _LAYOUT)).first()[0]
        stored = stored.where(F.col(_BUCKET) == _bucket(buckets, F.lit(run_id)))
        stored = stored.where(F.col(RUN) == run_id)
    return stored.drop(_BATCH, _BUCKET)


def compact_outputs(
    spark: SparkSession, out_dir: str, names: Iterable[str] = tuple(VIEWS)
) -> None:
    """Store samples and the current results of ``names`` as one refresh, where reading begins from now on.

    Name all the operators refreshed into ``out_dir``. Not to run beside a refresh.
    """
    since, newest = _newest(spark, out_dir, _COMPACTED), _newest(spark, out_dir, _REFRESHED)
    number = newest + 1
    for name in names:
        result = _current(spark, out_dir, name, since).drop(_BATCH)
        _store(result, out_dir, name, number, by_bucket=True)
    between = F.col(_BATCH).between(since, newest)
    samples = spark.read.parquet(_path(out_dir, _SAMPLES)).where(between).drop(_BATCH)
    _store(samples, out_dir, _SAMPLES, number, by_bucket=True)
    for name in (_FILES, _REFRESHED):
        lists = spark.read.parquet(_path(out_dir, name)).where(between)
        _store(lists.drop(_BATCH).distinct(), out_dir, name, number)
    _store(spark.range(1), out_dir, _COMPACTED, number)


def _bucket(buckets: int, run: Column | None = None) -> Column:
    run = F.col(RUN) if run is None else run
    return F.pmod(F.xxhash64(run), F.lit(buckets)).cast("int")


def _layout(spark: SparkSession, out_dir: str, buckets: int) -> int:
    """The number of buckets ``out_dir`` was begun with."""
    if not _stored(spark, out_dir, _LAYOUT):
        path = _path(out_dir, _LAYOUT)
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(path)
    return spark.read.parquet(_path(out_dir, _LAYOUT)).first()[0]


def _not_seen(arrived: DataFrame, files: DataFrame, out_dir: str, number: int) -> DataFrame:
    """Without the rows of files an earlier refresh took in, as happens after a lost checkpoint."""
    session = arrived.sparkSession
    earlier = session.read.parquet(_path(out_dir, _FILES)).where(F.col(_BATCH) < number)
    again = files.join(earlier.select(_FILE).distinct(), _FILE)
    if again.isEmpty():
        return arrived
    return arrived.join(again, _FILE, "left_anti")


def _samples(
    spark: SparkSession, out_dir: str, schema: T.StructType, since: int, number: int
) -> DataFrame:
    partitions = [T.StructField(c, T.IntegerType()) for c in (_BATCH, _BUCKET)]
    stored = spark.read.schema(T.StructType([*schema, *partitions]))
    return stored.parquet(_path(out_dir, _SAMPLES)).where(F.col(_BATCH).between(since, number))


def _current(spark: SparkSession, out_dir: str, name: str, since: int) -> DataFrame:
    """Rows of the newest refresh of each bucket, told apart by their directories alone."""
    newest = (
        spark.read.parquet(_path(out_dir, _REFRESHED))
        .where(F.col(_BATCH) >= since)
        .groupBy(_BUCKET)
        .agg(F.max(_BATCH).alias(_BATCH))
    )
    by_batch: dict[int, list[int]] = defaultdict(list)
    for row in newest.collect():  # one for each bucket at most
        by_batch[row[_BATCH]].append(row[_BUCKET])
    ours = [(F.col(_BATCH) == n) & F.col(_BUCKET).isin(own) for n, own in by_batch.items()]
    return spark.read.parquet(_path(out_dir, name)).where(reduce(or_, ours, F.lit(False)))


def _stored(spark: SparkSession, out_dir: str, name: str) -> bool:
    try:
        spark.read.parquet(_path(out_dir, name))
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return False
    return True


def _newest(spark: SparkSession, out_dir: str, name: str) -> int:
    """The largest number stored under ``name``; 0 where nothing is."""
    if not _stored(spark, out_dir, name):
        return 0
    return spark.read.parquet(_path(out_dir, name)).agg(F.max(_BATCH)).first()[0] or 0


def _store(
    result: DataFrame, out_dir: str, name: str, number: int, by_bucket: bool = False
) -> DataFrame:
    """Written as one refresh of ``name``; rows of a bucket together, large buckets by several tasks."""
    path = _batch_path(out_dir, name, number)
    if by_bucket:
        result.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(path)
    else:
        result.write.mode("overwrite").parquet(path)
    return result.sparkSession.read.schema(result.schema).parquet(path)


def _batch_path(out_dir: str, name: str, number: int) -> str:
    return f"{_path(out_dir, name)}/{_BATCH}={number}"


def _path(out_dir: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}"
