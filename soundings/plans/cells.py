"""Windows over runs that stay bounded when one run holds a large share of all rows.

``Window.partitionBy("run_id")`` puts a whole run into one task. Here a run with more than
``hot_rows`` rows is cut into *cells*: consecutive stretches, in time order, of about
``cell_rows`` rows. Windows are partitioned by ``(run_id, cell)``, so no task ever holds a run.

* Where the cuts are. Rows whose hash falls into a fixed residue class are the *marks* of a run,
  ``marks_per_cell`` to a cell; every ``marks_per_cell``-th mark opens a cell.
  Marks follow the data, however unevenly it lies in time, and depend on nothing but row content,
  so a retried task or a second scan finds the same ones.
* How marks are numbered. By a second hash one of ``marks_per_segment`` marks opens a *segment*. Marks
  are numbered inside their segment and counted per segment, and the counts of earlier segments are
  added: no task sees all marks of a run. A row is told its segment first, among the few that its
  run has, then its cell, among the few that its segment has.
* What a cell needs from earlier ones. Frames reach ``lookback`` rows back. A mark is a row, so
  the rows from the ``lookback``-th last mark of a cell onwards include its last ``lookback``
  rows. They are sent to the following cell too, feed the frames there and are dropped again.
  Wide frames get more marks, ``marks_per_lookback`` for each row they reach back, and longer cells
  where a cell has no room for these marks: at any width about a tenth more rows are sent.
* What is broadcast. A row per long run, of which there are at most ``rows / hot_rows``, with a key
  per segment, some 130 million rows (1 MB for 10^12 rows in one run). The cells of segments, two keys
  each, are joined as Spark sees fit by their size; a segment shared by many rows is split like
  any other skewed key.
* What is not split: rows that agree in every column the operator uses.

Everything is lazy. When no run is long there are no cuts, and adaptive execution drops the joins
and the branch for long runs: one scan, one exchange, one sort and one window remain, after a
count of the run column.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from soundings.schema import RUN, SEQ, TIME

CELL = "_cell"
LONG = "_long"
_KEY = "_key"
_SEGMENT = "_segment"
_OPENS = "_opens"
_OPENERS = "_openers"
_CUTS = "_cuts"
_TAILS = "_tails"
_EARLIER = "_earlier"
_LONG_RUN = "_long_run"

BY_TIME = (TIME, SEQ)
BY_SEQ = (SEQ, TIME)


@dataclass(frozen=True)
class CellSize:
    """Row counts that steer the cutting of long runs; results do not depend on them."""

    hot_rows: int = 4_000_000
    cell_rows: int = 2_000_000
    marks_per_cell: int = 64
    marks_per_lookback: int = 10
    marks_per_segment: int = 4096

    def for_frames(self, lookback: int) -> CellSize:
        """With marks enough that the tail of a cell stays a small share of it."""
        marks = max(self.marks_per_cell, self.marks_per_lookback * lookback)
        return replace(self, marks_per_cell=marks, cell_rows=max(self.cell_rows, marks))


DEFAULT_SIZE = CellSize()


class RunCells:
    """Cuts for the rows of ``df`` in the order ``order``, for frames up to ``lookback`` rows back.

    ``df`` holds exactly the rows the windows will see. ``counted`` may name a wider frame with the
    same runs (the unfiltered table), whose ``run_id`` column alone is then read to find long runs.
    """

    def __init__(
        self,
        df: DataFrame,
        counted: DataFrame | None = None,
        lookback: int = 0,
        order: Sequence[str] = BY_TIME,
        size: CellSize = DEFAULT_SIZE,
    ):
        self.df = df
        self.lookback = lookback
        self.order = tuple(order)
        # Rows that agree in time and counter are told apart by their readings.
        self.ties = [c for c in df.columns if c not in (RUN, *order)]
        self.size = size.for_frames(lookback)
        marks = self._find_marks(df if counted is None else counted)
        self.long_runs = self._find_segments(marks)
        self.cuts = self._find_cuts(marks)

    def all_rows(self) -> DataFrame:
        """Every row with its cell; cell 0 throughout for runs that are not long."""
        return self.short_rows().unionByName(self.long_rows())

    def short_rows(self) -> DataFrame:
        """Rows of runs that are not long, each run being one cell."""
        return self.df.join(
            F.broadcast(self.long_runs), _same_run(), "left_anti"
        ).selectExpr("*", f"false AS {LONG}", f"0 AS {CELL}")

    def long_rows(self) -> DataFrame:
        """Rows of long runs only; an empty frame, known early, when there are none."""
        return self._placed().select(*self.df.columns, LONG, CELL)

    def whole_cell(self) -> WindowSpec:
        """All rows of a cell; all rows of the run unless the run is long."""
        return Window.partitionBy(RUN, CELL)

    def window(self) -> WindowSpec:
        """Time order inside a cell, ties settled by the readings."""
        names = (*self.order, *self.ties)
        return self.whole_cell().orderBy(*[F.col(n).asc_nulls_last() for n in names])

    def with_columns(
        self, columns: Callable[[WindowSpec], dict[str, Column]], runs: str = "all"
    ) -> DataFrame:
        """Add window columns whose frames reach at most ``lookback`` rows back.

        ``columns`` gets the window and returns the columns to add. The result has one row per
        input row of the "all", "short" or "long" runs, with ``_cell`` and ``_long`` kept.
        """
        sent = {
            "short": self._short_sent,
            "long": self._long_sent,
            "all": lambda: self._short_sent().unionByName(self._long_sent()),
        }[runs]()
        added = columns(self.window())
        return sent.withColumns(added).where("_copy = 0").drop("_copy")

    def _short_sent(self) -> DataFrame:
        return self.short_rows().selectExpr("*", "0 AS _copy")

    def _long_sent(self) -> DataFrame:
        """Rows of long runs with the cells to go to, their own first.

        A complete cell has more marks, and so more rows, than a frame reaches back: no row is
        needed beyond the following cell.
        """
        in_tail = f"{self.lookback} > 0 AND {_TAILS} > {CELL}"
        receivers = f"sequence({CELL}, {CELL} + if({in_tail}, 1, 0))"
        return self._placed().selectExpr(
            *self.df.columns, LONG, f"posexplode({receivers}) AS (_copy, {CELL})"
        )

    def _find_marks(self, counted: DataFrame) -> DataFrame:
        """(run, key, whether it opens a segment) of the marks of long runs."""
        size = self.size
        long_runs = (
            counted.groupBy(RUN)
            .count()
            .where(f"count > {size.hot_rows}")
            .selectExpr(f"{RUN} AS {_LONG_RUN}")
        )
        spacing = max(size.cell_rows // size.marks_per_cell, 1)
        row = ", ".join((RUN, *self.order, *self.ties))
        return (
            self.df.where(f"pmod(xxhash64({row}), {spacing}) = 0")
            .join(F.broadcast(long_runs), _same_run())
            .selectExpr(
                _LONG_RUN, self._key(), f"pmod(hash({row}), {size.marks_per_segment}) = 0 AS {_OPENS}"
            )
            .distinct()
        )

    def _find_segments(self, marks: DataFrame) -> DataFrame:
        """Every long run with the keys at which its segments open, but for the first."""
        return marks.groupBy(_LONG_RUN).agg(_sorted_keys(_OPENS).alias(_OPENERS))

    def _find_cuts(self, marks: DataFrame) -> DataFrame:
        """Every segment with the keys at which cells, and tails of cells, start in it, and the number
        of marks in earlier segments."""
        runs = self.long_runs.withColumnRenamed(_LONG_RUN, "_run")
        marks = marks.join(F.broadcast(runs), F.expr(f"{_LONG_RUN} <=> _run")).selectExpr(
            _LONG_RUN, _KEY, f"{_passed(_OPENERS)} AS {_SEGMENT}"
        )
        counts = marks.groupBy(_LONG_RUN, _SEGMENT).agg(F.count("*").alias("_count"))
        before = Window.partitionBy(_LONG_RUN).orderBy(_SEGMENT)
        offsets = counts.select(
            F.col(_LONG_RUN).alias("_run"),
            F.col(_SEGMENT).alias("_at"),
            (F.sum("_count").over(before) - F.col("_count")).alias(_EARLIER),
        )
        inside = f"PARTITION BY {_LONG_RUN}, {_SEGMENT} ORDER BY {_KEY}"
        numbered = marks.selectExpr("*", f"row_number() OVER ({inside}) - 1 AS _number").join(
            offsets, F.expr(f"{_LONG_RUN} <=> _run AND {_SEGMENT} = _at")
        )
        every, place = self.size.marks_per_cell, f"{_EARLIER} + _number"
        # The first cell starts with the run, not with its first mark.
        starts = f"{place} > 0 AND ({place}) % {every} = 0"
        return numbered.groupBy(_LONG_RUN, _SEGMENT, _EARLIER).agg(
            _sorted_keys(starts).alias(_CUTS),
            _sorted_keys(f"({place}) % {every} = {self._tail_place()}").alias(_TAILS),
        )

    def _tail_place(self) -> int:
        return max(self.size.marks_per_cell - self.lookback, 0)

    def _key(self) -> str:
        """Sort key of a row as a struct that compares as the window's order does, NULLs last."""
        fields = [
            f"coalesce({f'unix_micros({c})' if c == TIME else f'bigint({c})'}, {2**63 - 1}) AS {c}"
            for c in self.order
        ]
        fields += [f"{c} IS NULL AS {c}_missing, {c}" for c in self.ties]
        return f"struct({', '.join(fields)}) AS {_KEY}"

    def _placed(self) -> DataFrame:
        """Rows of long runs with their cell, and in ``_tails`` the number of tails begun by then."""
        every, tail = self.size.marks_per_cell, self._tail_place()
        cuts = self.cuts.withColumnsRenamed({_LONG_RUN: "_run", _SEGMENT: "_at"})
        return (
            self.df.join(F.broadcast(self.long_runs), _same_run())
            .selectExpr("*", self._key(), f"true AS {LONG}")
            .withColumn(_SEGMENT, F.expr(_passed(_OPENERS)))
            # Before the first mark of a run there may be none in its segment.
            .join(cuts, F.expr(f"{RUN} <=> _run AND {_SEGMENT} = _at"), "left")
            .selectExpr(
                *self.df.columns,
                LONG,
                f"int(if({_EARLIER} > 0, ({_EARLIER} - 1) DIV {every}, 0)"
                f" + coalesce({_passed(_CUTS)}, 0)) AS {CELL}",
                f"if({_EARLIER} > {tail}, ({_EARLIER} - 1 - {tail}) DIV {every} + 1, 0)"
                f" + coalesce({_passed(_TAILS)}, 0) AS {_TAILS}",
            )
        )


def _same_run() -> Column:
    return F.expr(f"{RUN} <=> {_LONG_RUN}")


def _sorted_keys(condition: str) -> Column:
    return F.expr(f"sort_array(collect_list(if({condition}, {_KEY}, NULL)))")


def _passed(keys: str) -> str:
    """How many of the sorted ``keys`` a row's key has reached: a binary search by powers of two."""
    exponents = f"sequence(int(floor(log2(greatest(size({keys}), 1)))), 0, -1)"
    stride = "int(pow(2, e))"
    return (
        f"aggregate({exponents}, 0, (passed, e) -> "
        f"if(get({keys}, passed + {stride} - 1) <= {_KEY}, passed + {stride}, passed))"
    )
