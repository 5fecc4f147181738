"""Ordered per-call computations that hold up when one call owns a large share of the rows.

A plain window sends every row of a call to one task. That is the best plan while calls are
small: all later steps on the same call reuse its partitioning. `ordered` checks the largest
call first. Beyond the limit the rows are split into (call, block) partitions, each block is
summarised to one row, the carry over preceding blocks is taken on those summaries alone, and
joined back. Both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parley.session import cut

# Rows of one call that a single task may sort; a few hundred MB at most, and it can spill.
MAX_GROUP_ROWS = 2_000_000
# Rows of one block, as far as positions are dense.
BLOCK_ROWS = 65_536
BLOCK = "_block"


def is_hot(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> bool:
    """True if some key holds more than `max_rows` rows (reads the key columns only)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return not counts.filter(F.col("_rows") > max_rows).isEmpty()


@dataclass(frozen=True)
class Ordered:
    """Rows with an order inside each key; see `ordered`."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    hot: bool

    @property
    def _window(self):
        keys = [*self.keys, BLOCK] if self.hot else self.keys
        return Window.partitionBy(*keys).orderBy(*self.order)

    @property
    def _position(self) -> Column:
        return F.struct(*self.order)

    def _upto(self, window):
        return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def _with_carry(self, rows: DataFrame, summary: dict[str, Column], carry) -> DataFrame:
        """Join `carry` (a function of the block window) of each block's summary row to its rows."""
        window = Window.partitionBy(*self.keys).orderBy(BLOCK)
        blocks = rows.groupBy(*self.keys, BLOCK).agg(*[c.alias(f"_s_{n}") for n, c in summary.items()])
        blocks = blocks.select(*self.keys, BLOCK,
                               *[carry(F.col(f"_s_{n}"), window).alias(f"_c_{n}") for n in summary])
        # Keys and blocks may be null: rows without a key belong together, rows without a position come first.
        same = [*self.keys, BLOCK]
        blocks = blocks.withColumnsRenamed({k: f"_k_{k}" for k in same})
        matched = reduce(and_, (rows[k].eqNullSafe(blocks[f"_k_{k}"]) for k in same))
        return rows.join(blocks, matched).drop(*(f"_k_{k}" for k in same))

    def _finish(self, df: DataFrame, names) -> Ordered:
        drop = [f"{p}{n}" for n in names for p in ("_c_", "_l_")]
        return replace(self, df=df.drop(*drop, "_edge"))

    def running_sum(self, **values: Column) -> Ordered:
        """Inclusive running sums."""
        window = self._upto(self._window)
        if not self.hot:
            return replace(self, df=self.df.withColumns({n: F.sum(v).over(window) for n, v in values.items()}))
        rows = self._with_carry(
            cut(self.df), {n: F.sum(v) for n, v in values.items()},
            lambda c, w: F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)))
        rows = rows.withColumns({f"_l_{n}": F.sum(v).over(window) for n, v in values.items()})
        # A sum is null until the first value; a null addend changes nothing.
        rows = rows.withColumns({n: F.when(F.col(f"_l_{n}").isNull(), F.col(f"_c_{n}")).otherwise(
            F.col(f"_l_{n}") + F.coalesce(f"_c_{n}", F.lit(0))) for n in values})
        return self._finish(rows, values)

    def number(self, name: str) -> Ordered:
        """Row number from 1."""
        if not self.hot:
            return replace(self, df=self.df.withColumn(name, F.row_number().over(self._window).cast("long")))
        return self.running_sum(**{name: F.lit(1).cast("long")})

    def previous(self, **values: Column) -> Ordered:
        """Values of the row before; null on the first row."""
        if not self.hot:
            return replace(self, df=self.df.withColumns({n: F.lag(v).over(self._window) for n, v in values.items()}))
        rows = self._with_carry(
            cut(self.df), {n: F.max_by(v, self._position) for n, v in values.items()},
            lambda c, w: F.lag(c).over(w))
        return self._neighbour(rows, values, F.lag, F.row_number().over(self._window) == 1)

    def second_previous(self, **values: Column) -> Ordered:
        """Values of the row before the last; null on the first two rows."""
        if not self.hot:
            return replace(self, df=self.df.withColumns({n: F.lag(v, 2).over(self._window) for n, v in values.items()}))
        line = self.previous(**{f"_p_{n}": v for n, v in values.items()}).previous(**{n: F.col(f"_p_{n}") for n in values})
        return replace(line, df=line.df.drop(*(f"_p_{n}" for n in values)))

    def following(self, **values: Column) -> Ordered:
        """Values of the row after; null on the last row."""
        if not self.hot:
            return replace(self, df=self.df.withColumns({n: F.lead(v).over(self._window) for n, v in values.items()}))
        rows = self._with_carry(
            cut(self.df), {n: F.min_by(v, self._position) for n, v in values.items()},
            lambda c, w: F.lead(c).over(w))
        return self._neighbour(rows, values, F.lead, F.lead(F.lit(1)).over(self._window).isNull())

    def _neighbour(self, rows, values, step, edge) -> Ordered:
        rows = rows.withColumns({"_edge": edge, **{f"_l_{n}": step(v).over(self._window) for n, v in values.items()}})
        rows = rows.withColumns(
            {n: F.when(F.col("_edge"), F.col(f"_c_{n}")).otherwise(F.col(f"_l_{n}")) for n in values})
        return self._finish(rows, values)

    def last_seen(self, **values: Column) -> Ordered:
        """Latest non-null value at or before the row."""
        window = self._upto(self._window)
        if not self.hot:
            return replace(self, df=self.df.withColumns(
                {n: F.last(v, ignorenulls=True).over(window) for n, v in values.items()}))
        rows = self._with_carry(
            cut(self.df),
            {n: F.max_by(v, F.when(v.isNotNull(), self._position)) for n, v in values.items()},
            lambda c, w: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
        rows = rows.withColumns({f"_l_{n}": F.last(v, ignorenulls=True).over(window) for n, v in values.items()})
        rows = rows.withColumns({n: F.coalesce(f"_l_{n}", f"_c_{n}") for n in values})
        return self._finish(rows, values)

    def with_columns(self, **values: Column) -> Ordered:
        return replace(self, df=self.df.withColumns(values))

    def filter(self, condition: Column) -> Ordered:
        return replace(self, df=self.df.filter(condition))

    def rows(self) -> DataFrame:
        return self.df.drop(BLOCK)


def ordered(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column,
            hot: bool | None = None) -> Ordered:
    """Rows of `df` in `order` within `keys`.

    `block` must not decrease along the order, and one block must stay small enough for a task.
    `hot=None` checks the largest key; pass the answer on to skip repeated checks.
    Rows with a null key belong together; a null position comes first.
    """
    hot = is_hot(df, keys) if hot is None else hot
    return Ordered(df.withColumn(BLOCK, block) if hot else df, tuple(keys), tuple(order), hot)


def position_block(column: str, size: int | None = None) -> Column:
    """Block of a whole-number position."""
    return F.floor(F.col(column) / (size or BLOCK_ROWS)).cast("long")
