"""How the rows of many series are spread over tasks for positional (lag, rolling, carry) features.

``short``  one window partition per series, without a look at its length: for series that are short by
           construction, as after summing by period, where a series has at most one row per period.
``blocks`` all rows are range-sorted by (series, order), written once, numbered, and cut into blocks of
           ``block_rows``. Each block also gets copies of the ``reach`` rows before it, so every row
           frame up to ``reach`` rows back is exact inside a block, and a series holding any share of
           the table is spread over many tasks.
``whole``  one window partition per series, as long as none has more than ``WHOLE_SERIES_ROWS`` rows (counted,
           combined before the shuffle). One task sorts a whole series with all its columns, so rows of longer
           series are laid out in ``blocks``, with the same results.
``auto``   the same.

A pass over blocks has as many tasks as it has ``TASK_ROWS`` rows: what a task holds while it sorts does not grow with the
table. Left to itself, Spark joins partitions by the bytes of the rows before a pass, which makes them several times wider.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalars import all_present, named
from ..session import materialize

WHOLE_SERIES_ROWS = 100_000
BLOCK_ROWS = 50_000
TASK_ROWS = 100_000

_POS, _BLOCK, _OWN, _CARRY, _TIE = "__pos", "__block", "__own", "__carry", "__tie"
_START = "__start"
_ROW_BITS = 33  # monotonically_increasing_id: partition number above, row number in the low 33 bits


def asc_order(cols: Sequence[str]) -> list[Column]:
    return [named(c).asc_nulls_last() for c in cols]


def row_hash(df: DataFrame) -> Column:
    """Orders rows that are equal in their order columns, the same way in every layout."""
    return F.xxhash64(*[named(f.name) for f in df.schema if "map" not in f.dataType.simpleString()])


def number_rows(df: DataFrame, order_by: Sequence[str], out: str = _POS) -> DataFrame:
    """Dense 0-based position of every row in the order of ``order_by``, without a one-task window.

    Rows equal in ``order_by`` are ordered by a hash of the row, so that a hot value is split over tasks
    and the numbering does not depend on how rows arrived. Offsets are one row per sorted partition,
    which bounds what is broadcast.
    """
    ranked = df.orderBy(*asc_order(order_by), row_hash(df)).withColumn("__id", F.monotonically_increasing_id())
    ranked = materialize(ranked, "sorted")
    part = F.shiftright("__id", _ROW_BITS)
    sizes = ranked.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    in_part = F.col("__id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        ranked.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(out, F.col("__offset") + in_part)
        .drop("__id", "__part", "__offset")
    )


@dataclass(frozen=True)
class SeriesRows:
    """Rows of many series with operations on their order. Every operation returns a new object."""

    rows: DataFrame
    groups: tuple[str, ...]
    order_by: tuple[str, ...]
    block_rows: int | None = None  # None: one window partition per series
    n_rows: int = 0  # in blocks: of the whole table

    @property
    def has_key(self) -> Column:
        return all_present(self.groups)

    def _keys(self) -> list[Column]:
        return [named(g) for g in self.groups]

    def _window(self) -> WindowSpec:
        if self.block_rows is None:
            keys = [named(g) for g in self.groups] or [F.lit(0)]
            return Window.partitionBy(*keys).orderBy(*asc_order(self.order_by), _TIE)
        return Window.partitionBy(_BLOCK, *self._keys()).orderBy(_POS)

    def with_columns(self, reach: int, *steps: Callable[[WindowSpec], dict[str, Column]]) -> SeriesRows:
        """Add window columns whose row frames go back at most ``reach`` rows (and not forward).

        Later steps may use the columns of earlier ones; ``reach`` then covers them together.
        """
        rows = self.rows if self.block_rows is None else self._with_reach(max(self.block_rows, reach), reach)
        for build in steps:
            rows = rows.withColumns(build(self._window()))
        if self.block_rows is not None:
            rows = rows.where(_OWN).drop(_BLOCK, _OWN)
        return self.on(rows)

    def _with_reach(self, size: int, reach: int) -> DataFrame:
        home = F.floor(F.col(_POS) / size)
        near_end = F.col(_POS) % size >= size - reach
        blocks = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
        copies = self.rows.withColumn(_BLOCK, F.explode(blocks)).withColumn(_OWN, F.col(_BLOCK) == home)
        return self._dealt(copies, self.n_rows * (1 + reach / size))

    def _dealt(self, rows: DataFrame, n_rows: float) -> DataFrame:
        """One shuffle serves all windows of the pass, also those nested inside a block's series."""
        return rows.repartition(max(1, math.ceil(n_rows / TASK_ROWS)), _BLOCK, *self._keys())

    def carries_locally(self, value: str) -> bool:
        """Whether a value never has to be carried from further back than a window partition reaches."""
        return self.block_rows is None or self.rows.where(named(value).isNull()).isEmpty()

    def with_last_known(self, names: dict[str, str]) -> SeriesRows:
        """For each (value, out): the latest non-missing value of the series up to and including the row."""
        w = self._window().rowsBetween(Window.unboundedPreceding, 0)
        here = {out: F.last(named(value), ignorenulls=True).over(w) for value, out in names.items()}
        if self.block_rows is None:
            return self.on(self.rows.withColumns(here))
        # One row per block and series; a value is carried only into the first series of a block.
        carry = {out: f"{_CARRY}_{i}" for i, out in enumerate(here)}
        last = {carry[out]: F.max_by(named(v), F.when(named(v).isNotNull(), F.col(_POS))) for v, out in names.items()}
        before = Window.partitionBy(*self._keys()).orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        carried = self._per_block(last).withColumns({c: F.last(c, ignorenulls=True).over(before) for c in last})
        carried = carried.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in last]))
        rows = self._join_per_block(carried)
        rows = rows.withColumns({out: F.coalesce(c, carry[out]) for out, c in here.items()})
        return self.on(rows.drop(_BLOCK, *last))

    def with_carried(self, names: Sequence[str], sums: Callable) -> SeriesRows:
        """For decaying sums inside blocks: add what the blocks before have left, and where the block's series starts.

        ``sums(names, keys, place)`` gives the steps that turn the blocks' own sums into those with all blocks before.
        One row per block and series; a series' blocks are numbered without gaps.
        """
        closing = {f"{n}_own": F.max_by(n, _POS) for n in names}
        table = self._per_block(closing | {_START: F.min(_POS)})
        series = Window.partitionBy(*self._keys()).orderBy(_BLOCK)
        total = {f"{n}_total": f"{n}_own" for n in names}
        for step in sums(total, list(self.groups), _BLOCK):
            table = table.withColumns(step(series))
        table = table.withColumns({self.carried(n): F.lag(f"{n}_total", 1).over(series) for n in names})
        table = table.select(_BLOCK, *self._keys(), _START, *[self.carried(n) for n in names])
        return self.on(self._join_per_block(table).drop(_BLOCK))

    def carried(self, name: str) -> str:
        return f"{name}_carried"

    def carry_columns(self, names: Sequence[str]) -> list[str]:
        return [_START, *map(self.carried, names)]

    def since_block_start(self) -> Column:
        """1 at the first row of a series in a block, after ``with_carried``."""
        return F.col(_POS) - F.col(_START) + 1

    def _home_block(self) -> DataFrame:
        return self.rows.withColumn(_BLOCK, F.floor(F.col(_POS) / self.block_rows))

    def _per_block(self, measures: dict[str, Column]) -> DataFrame:
        """Aggregates per block and series: one row per block and one more per series."""
        return self._home_block().groupBy(_BLOCK, *self._keys()).agg(*[c.alias(n) for n, c in measures.items()])

    def _join_per_block(self, table: DataFrame) -> DataFrame:
        """Join on (block, series): no key has more rows than a block, and the windows of a block need no
        further shuffle. Rows with a missing group key find nothing; their features are NULL anyway."""
        return self._dealt(self._home_block(), self.n_rows).join(table, [_BLOCK, *self.groups], "left")

    def with_position(self, out: str) -> SeriesRows:
        """A number that grows by one from row to row of a series; where it starts is not defined."""
        if self.block_rows is None:
            return self.on(self.rows.withColumn(out, F.row_number().over(self._window()).cast("long")))
        return self.on(self.rows.withColumn(out, F.col(_POS)))

    def with_row_number(self, out: str, from_end: bool = False) -> SeriesRows:
        """1, 2, ... along the series, or counted from its last row."""
        series = Window.partitionBy(*self._keys())
        if self.block_rows is None:
            if not from_end:
                return self.with_position(out)
            keys = [named(g) for g in self.groups] or [F.lit(0)]
            size = F.count(F.lit(1)).over(Window.partitionBy(*keys))
            return self.on(self.with_position(out).rows.withColumn(out, size - F.col(out) + 1))
        end = F.max if from_end else F.min
        ends = self._per_block({_CARRY: end(_POS)}).withColumn(_CARRY, end(_CARRY).over(series))
        rows = self._join_per_block(ends).withColumn(out, F.abs(F.col(_POS) - F.col(_CARRY)) + 1)
        return self.on(rows.drop(_BLOCK, _CARRY))

    def on(self, rows: DataFrame) -> SeriesRows:
        """The same layout over ``rows``: this frame with other columns."""
        return replace(self, rows=rows)

    def partition_keys(self) -> list[str]:
        """Columns of the current window partitions, for windows nested inside them."""
        return list(self.groups) if self.block_rows is None else [_BLOCK, *self.groups]

    def to_frame(self) -> DataFrame:
        return self.rows.drop(_POS, _TIE)


def lay_out(
    df: DataFrame,
    group_cols: Sequence[str] | None,
    order_by: Sequence[str],
    layout: str = "auto",
    block_rows: int = BLOCK_ROWS,
) -> SeriesRows:
    """Rows that ``order_by`` leaves equal are ordered by a hash of their columns: Spark keeps no input order."""
    groups, order = tuple(group_cols or ()), tuple(order_by)
    if not order:
        raise ValueError("order_by needs at least one column")
    if layout in ("whole", "auto"):
        longest = df.groupBy(*map(named, groups)).count().agg(F.max("count")).first()[0] or 0
        layout = "short" if longest <= WHOLE_SERIES_ROWS else "blocks"
    if layout == "short":
        return SeriesRows(df.withColumn(_TIE, row_hash(df)), groups, order)
    if layout != "blocks":
        raise ValueError(f"layout {layout!r} is not one of auto, whole, short, blocks")
    rows = number_rows(df, [*groups, *order])
    return SeriesRows(rows, groups, order, block_rows, rows.count())
