"""Exact order statistics per run without bringing a run's values together.

A value of given rank is found digit by digit: its double is read as a 64-bit number that sorts as the
double does, and four passes fix 16 bits each. A pass counts, per run and wanted rank, the values with
the digits found so far by their next digit, which Spark does before it shuffles: at most 65,536 counts
per run and rank are ever brought together, however long the run. Everything stays lazy.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from soundings.schema import RUN

_DIGIT = 16
_FRACTION = 52  # bits of a double's fraction
_BIAS = 1023
_LEAST_NORMAL = 2.0**-1022


def sort_key(value: str) -> Column:
    """The bits of a double as a bigint that orders as the double: -0.0 is 0.0, NaN comes last."""
    size = f"abs({value})"
    guess = f"floor(log2({size}))"
    power = f"pow(2D, {guess})"
    # The logarithm is rounded; comparing with powers of two, which are exact, mends it.
    exponent = f"({guess} + CASE WHEN {power} > {size} THEN -1 WHEN {size} / {power} >= 2 THEN 1 ELSE 0 END)"
    fraction = f"bigint(({size} / pow(2D, {exponent}) - 1) * {2.0**_FRACTION!r}D)"
    return F.expr(
        f"CASE WHEN isnan({value}) THEN {(2047 << _FRACTION) + 1}L "
        f"ELSE if({value} < 0, -1L, 1L) * CASE "
        f"WHEN {size} = double('Infinity') THEN {2047 << _FRACTION}L "
        f"WHEN {size} < {_LEAST_NORMAL!r}D THEN bigint({size} * {2.0**537!r}D * {2.0**537!r}D) "
        f"ELSE (bigint({exponent} + {_BIAS}) << {_FRACTION}) + {fraction} END END"
    )


def from_sort_key(key: str) -> Column:
    """Inverse of :func:`sort_key`."""
    exponent = f"(abs({key}) >> {_FRACTION})"
    fraction = f"double(abs({key}) & {2**_FRACTION - 1}L)"
    return F.expr(
        f"if({key} < 0, -1D, 1D) * CASE "
        f"WHEN {exponent} = 2047 AND {fraction} > 0 THEN double('NaN') "
        f"WHEN {exponent} = 0 THEN {fraction} * {2.0**-537!r}D * {2.0**-537!r}D "
        f"ELSE (1 + {fraction} / {2.0**_FRACTION!r}D) * pow(2D, {exponent} - {_BIAS}) END"
    )


def exact_percentiles(df: DataFrame, value: str, shares: Mapping[str, float]) -> DataFrame:
    """(run_id, one column per share): the smallest value that at least the share of a run's values
    do not exceed. NULL values do not count, and runs without others are absent."""
    rows = df.select(RUN, sort_key(value).alias("_key")).where("_key IS NOT NULL")
    known = 64 - _DIGIT
    counts = rows.groupBy(RUN, _prefix(known)).agg(F.count("*").alias("_count"))
    ranks = [
        F.struct(F.lit(name).alias("name"), F.ceil(F.lit(Decimal(str(p))) * F.col("_all")).alias("rank"))
        for name, p in shares.items()
    ]
    counts = (
        counts.withColumn("_all", F.sum("_count").over(Window.partitionBy(RUN)))
        .withColumn("_want", F.explode(F.array(*ranks)))
        .select(RUN, "_want.name", "_want.rank", "_prefix", "_count")
    )
    targets = _reached(counts)
    while known:
        known -= _DIGIT
        wanted = targets.withColumnsRenamed({RUN: "_run", "_prefix": "_found"})
        same = F.expr(f"{RUN} <=> _run AND shiftright(_key, {known + _DIGIT}) = _found")
        counts = (
            rows.join(wanted, same)
            .groupBy(RUN, "name", "rank", _prefix(known))
            .agg(F.count("*").alias("_count"))
        )
        targets = _reached(counts)
    columns = [
        F.max(F.when(F.col("name") == name, from_sort_key("_prefix"))).alias(name)
        for name in shares
    ]
    return targets.groupBy(RUN).agg(*columns)


def _prefix(known: int) -> Column:
    return F.shiftright("_key", known).alias("_prefix") if known else F.col("_key").alias("_prefix")


def _reached(counts: DataFrame) -> DataFrame:
    """The digits with which the rank is reached, and the rank among the values that have them."""
    upto = F.sum("_count").over(Window.partitionBy(RUN, "name").orderBy("_prefix"))
    return (
        counts.withColumn("_upto", upto)
        .where("_upto >= rank AND _upto - _count < rank")
        .select(RUN, "name", F.expr("rank - (_upto - _count)").alias("rank"), "_prefix")
    )
