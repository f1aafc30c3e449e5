"""Wide CSV logs to Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from soundings.functions.columns import any_present, instant_from_ntz
from soundings.schema import DEFAULT_ID_COLUMNS, RUN, SENSOR_SCHEMA
from soundings.sources.workspace import remove_dir, shared_dir

# Spellings of a missing value in CSV files, as pandas reads them by default.
MISSING_SPELLINGS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

_BROKEN = "_broken_line"
_CANONICAL_TYPES = {f.name: f.dataType.simpleString() for f in SENSOR_SCHEMA}
_INTEGERS = [n for n, t in _CANONICAL_TYPES.items() if t == "int"]
_CANDIDATES = ("int", "bigint", "double", "boolean")


def id_columns(
    columns: Sequence[str], preferred: Sequence[str] = DEFAULT_ID_COLUMNS
) -> list[str]:
    """The preferred identifier columns that exist, in preferred order."""
    return [name for name in preferred if name in columns]


def signal_columns(columns: Sequence[str], ids: Sequence[str]) -> list[str]:
    return [name for name in columns if name not in ids]


def is_time_column(name: str) -> bool:
    return "time" in name.lower()


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file, or a directory of files with one header, as text with missing values as NULL.

    Files whose header differs are refused rather than read by position, and so is, when it is
    met, a line with more fields than the header, whichever columns are asked for: every line is
    parsed whole. A line with fewer has NULL in the rest.
    """
    names = spark.read.csv(path, header=True).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in (*names, _BROKEN)])
    reader = spark.read.option("columnPruning", False)
    text = reader.csv(
        path, schema, header=True, enforceSchema=False, columnNameOfCorruptRecord=_BROKEN
    )
    unquoted = F.regexp_replace(_BROKEN, r'"(?:[^"\\]|\\.|"")*"', "")
    surplus = F.length(unquoted) - F.length(F.replace(unquoted, F.lit(","))) >= len(names)
    # Spark reads a broken line only beside a field of it.
    first = F.coalesce(F.col(f"`{names[0]}`"), F.lit(""))
    told = F.concat_ws(" ", F.lit("more fields than the header has, from"), first, _BROKEN)
    sound = F.when(surplus, F.raise_error(told).cast("boolean")).otherwise(True)
    return text.where(sound).select(*[_missing_to_null(name).alias(name) for name in names])


def _missing_to_null(name: str) -> Column:
    value = F.col(f"`{name}`")
    return F.when(~value.isin(*MISSING_SPELLINGS), value)


def parse_time(text: Column) -> Column:
    """Text to an instant. No zone means UTC, whole numbers are epoch nanoseconds, junk is NULL."""
    value = F.trim(text)
    number = value.rlike(r"^[+-]?\d+$")
    zoned = value.rlike(r"(?i)\d\s*(z|utc|gmt|[+-]\d{1,2}(:?\d{2})?)$") & value.contains(":")
    return (
        F.when(number, F.timestamp_micros(F.floor(value.try_cast("bigint") / 1000)))
        .when(zoned, value.try_cast("timestamp"))
        .otherwise(instant_from_ntz(value.try_cast("timestamp_ntz")))
    )


def parse_time_columns(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Parse the text identifier columns that have "time" in their name; rows are kept regardless."""
    text = dict(df.dtypes)
    times = [c for c in ids if is_time_column(c) and text[c] == "string"]
    return df.withColumns({c: parse_time(F.col(c)) for c in times})


def type_signals(
    df: DataFrame, ids: Sequence[str], types: Mapping[str, str] | None = None
) -> DataFrame:
    """Give text columns their type.

    Canonical columns get theirs, a canonical integer a wider one if a value needs it: bigint, or
    double for fractions, which rounds whole numbers beyond 2^53. Identifiers without a canonical type
    and canonical times stay text, and other columns get the narrowest type that all values fit.
    ``types`` fixes the types of the columns it names; if it names all that the values would decide,
    they are not read for it.
    """
    fixed, undecided = _fixed_types(df.columns, ids, types)
    votes = _votes(undecided)
    found = df.agg(*votes).first().asDict() if votes else {}
    return _typed(df, fixed | _narrowest_types(found, undecided))


def _fixed_types(
    columns: Sequence[str], ids: Sequence[str], types: Mapping[str, str] | None
) -> tuple[dict[str, str], list[str]]:
    """Types known without a look at the values, and the columns without one."""
    fixed = {n: t for n, t in _CANONICAL_TYPES.items() if n not in _INTEGERS}
    fixed |= {n: "string" for n in ids if n not in _INTEGERS} | dict(types or {})
    fixed |= {n: "string" for n in _CANONICAL_TYPES if is_time_column(n)}
    return fixed, [c for c in columns if c not in fixed]


def _typed(df: DataFrame, chosen: Mapping[str, str]) -> DataFrame:
    text = dict(df.dtypes)

    def typed(name: str) -> Column:
        value = F.col(f"`{name}`")
        wanted = chosen[name]
        if text[name] != "string" or wanted == "string":
            return value
        if wanted in ("int", "bigint"):
            return _whole(value).try_cast(wanted).alias(name)
        if wanted == "double":
            number = value.try_cast("double")
            return F.when(~F.isnan(number), number).alias(name)
        return value.try_cast(wanted).alias(name)

    return df.select(*[typed(name) for name in df.columns])


def _whole(value: Column) -> Column:
    """A whole number, which pandas may have written as 3.0; NULL for all else."""
    number = value.try_cast("double")
    floats = F.when(number == F.floor(number), value.try_cast("decimal(38,6)").try_cast("bigint"))
    return F.coalesce(value.try_cast("bigint"), floats)


def _votes(names: Sequence[str]) -> list[Column]:
    """Aggregates that say of each named column and type whether a value does not fit.

    In canonical integers values that are no numbers do not count.
    """

    def misfits(name: str, wanted: str) -> Column:
        value = F.col(f"`{name}`")
        counts = value.isNotNull()
        if name in _INTEGERS:
            counts = value.try_cast("double").isNotNull()
            fits = _whole(value).try_cast(wanted) if wanted != "double" else value.try_cast(wanted)
        else:
            fits = value.try_cast(wanted)
        return F.coalesce(F.bool_or(counts & fits.isNull()), F.lit(False)).alias(f"{wanted}:{name}")

    seen = [F.bool_or(F.col(f"`{n}`").isNotNull()).alias(f"seen:{n}") for n in names]
    return [misfits(n, t) for n in names for t in _CANDIDATES] + seen


def _narrowest_types(found: Mapping[str, bool], names: Sequence[str]) -> dict[str, str]:
    """The first type that fits, from what :func:`_votes` found."""

    def narrowest(name: str) -> str:
        if not found[f"seen:{name}"]:
            return "int" if name in _INTEGERS else "double"
        allowed = _CANDIDATES if name in _INTEGERS else _CANDIDATES[1:]
        return next((t for t in allowed if not found[f"{t}:{name}"]), "string")

    return {name: narrowest(name) for name in names}


def drop_all_null_rows(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """Drop rows without any signal; a frame without signal columns is left as it is."""
    signals = signal_columns(df.columns, ids)
    return df.where(any_present(*signals)) if signals else df


def read_sensor_csv(
    spark: SparkSession,
    path: str,
    id_cols: Sequence[str] = DEFAULT_ID_COLUMNS,
    parse_times: bool = True,
    drop_empty_rows: bool = False,
    types: Mapping[str, str] | None = None,
) -> DataFrame:
    """A wide CSV log with its column order kept and every column typed.

    The CSV is parsed once. Where values decide about types, they are looked at while the text is
    stored as Parquet in the shared folder, and the result reads that copy.
    """
    return _read(spark, path, id_cols, parse_times, drop_empty_rows, types)[0]


def _read(
    spark: SparkSession,
    path: str,
    id_cols: Sequence[str],
    parse_times: bool,
    drop_empty_rows: bool,
    types: Mapping[str, str] | None,
) -> tuple[DataFrame, str | None]:
    """The typed log, and the folder of the copy it reads if there is one."""
    df, copy = read_csv_text(spark, path), None
    ids = id_columns(df.columns, id_cols)
    chosen, undecided = _fixed_types(df.columns, ids, types)
    if undecided:
        copy, votes = shared_dir(spark, "csv"), Observation()
        schema = df.schema
        df.observe(votes, *_votes(undecided)).write.parquet(copy)
        df = spark.read.schema(schema).parquet(copy)
        chosen |= _narrowest_types(votes.get, undecided)
    df = _typed(df, chosen)
    if parse_times:
        df = parse_time_columns(df, ids)
    return drop_all_null_rows(df, ids) if drop_empty_rows else df, copy


def ingest_csv(
    spark: SparkSession,
    path: str,
    out: str,
    id_cols: Sequence[str] = DEFAULT_ID_COLUMNS,
    parse_times: bool = True,
    drop_all_null_rows: bool = False,
    partition_by_run: bool = False,
    types: Mapping[str, str] | None = None,
) -> str:
    """Convert a CSV log to a directory of Parquet files and return the directory.

    ``types`` fixes column types, as for :func:`type_signals`; with all of them known no copy is made.

    With ``partition_by_run`` rows of a run share a directory, which :func:`filter_run` and the
    refresh job read alone. Each writing task then keeps one open file per run it meets.
    """
    df, copy = _read(spark, path, id_cols, parse_times, drop_all_null_rows, types)
    writer = df.write.mode("overwrite")
    if partition_by_run:
        writer = writer.partitionBy(RUN)
    writer.parquet(out)
    if copy:
        remove_dir(spark, copy)
    return out


def convert_csv_raw(
    spark: SparkSession, path: str, out: str, types: Mapping[str, str] | None = None
) -> str:
    """Convert a CSV log without reading its times or dropping rows."""
    return ingest_csv(spark, path, out, parse_times=False, types=types)
