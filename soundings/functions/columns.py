"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from soundings.schema import ACCEL_AXES


def all_present(*names: str) -> Column:
    """None of the columns is NULL. Unlike ``na.drop`` this reaches the Parquet scan, and keeps NaN."""
    return reduce(and_, [F.col(name).isNotNull() for name in names])


def any_present(*names: str) -> Column:
    """At least one of the columns is not NULL."""
    return reduce(or_, [F.col(name).isNotNull() for name in names])


def seconds_between(later: Column, earlier: Column) -> Column:
    """Elapsed seconds. Whole microseconds are subtracted before the division, so no digit is lost."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def rate_per(change: Column, elapsed: Column) -> Column:
    """``change / elapsed``, NULL where no time has passed."""
    return change / F.nullif(elapsed, F.lit(0.0))


def round_scaled(value: Column, digits: int) -> Column:
    """Round the scaled double, as SQL engines with binary rounding do.

    Spark's own ``round(x, n)`` rounds the decimal spelling, which turns 1.005 into 1.01.
    """
    factor = F.lit(10.0**digits)
    return F.round(value * factor) / factor


def accel_magnitude() -> Column:
    x, y, z = (F.col(axis) for axis in ACCEL_AXES)
    return F.sqrt(x * x + y * y + z * z)


_BITS = 20
_MASK = 2**_BITS - 1
_UNITS = 2.0 ** (3 * _BITS)
# Beyond this a double has no fraction, and sums of its whole part could leave 64 bits.
_WHOLE_LIMIT = 2.0**53


def exact_sum(value: str) -> Column:
    """The sum of a group's doubles whatever their order, so that partitions do not show in it.

    A value is cut into its whole part and a number of units of 2^-60, these into three chunks of 20
    bits, and whole numbers are added. That is exact for values of 2^-7 and more, and for any that
    are multiples of 2^-60; smaller ones are rounded there, each on its own. The total is rounded at
    the end, to a double or to 2^-53. Values beyond 2^53, and infinite or undefined ones, are added as
    doubles. Groups may have up to 2^43 rows. ``value`` is SQL, which reaches Spark in one piece.
    """
    return F.expr(exact_sum_sql(value))


def exact_avg(value: str) -> Column:
    """:func:`exact_sum` over the number of values; NULL if there are none."""
    return F.expr(exact_avg_sql(value))


def exact_avg_sql(value: str) -> str:
    return f"{exact_sum_sql(value)} / nullif(count({value}), 0)"


def exact_sum_sql(value: str) -> str:
    fits = f"abs({value}) <= {_WHOLE_LIMIT!r}D"
    whole = f"bigint(if({fits}, {value}, NULL))"
    units = f"bigint(rint(({value} - {whole}) * {_UNITS!r}D))"
    lower = f"sum({units} & {_MASK})"
    # Carried upwards, so that equal totals have equal parts.
    middle = f"(sum({units} >> {_BITS} & {_MASK}) + ({lower} >> {_BITS}))"
    upper = f"(sum({units} >> {2 * _BITS}) + ({middle} >> {_BITS}))"
    fraction = f"({upper} & {_MASK}) * {_UNITS / 2**_BITS!r}D + (({middle} & {_MASK}) << {_BITS}) + ({lower} & {_MASK})"
    total = f"(sum({whole}) + ({upper} >> {_BITS})) + ({fraction}) / {_UNITS!r}D"
    odd = f"sum(if({fits}, NULL, {value}))"
    return f"coalesce({total} + coalesce({odd}, 0D), {odd})"


def ntz_from_instant(instant: Column) -> Column:
    """Wall-clock UTC value of an instant, whatever the session time zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), _ntz_epoch())


def instant_from_ntz(wall_clock: Column) -> Column:
    """Inverse of :func:`ntz_from_instant`: read a zone-less value as UTC."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _ntz_epoch(), wall_clock))


def _ntz_epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
