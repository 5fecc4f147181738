"""Building blocks for array columns."""

from __future__ import annotations

from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import Column
from pyspark.sql import functions as F

SCAN_BLOCK = 64
RUN_BLOCK = 8


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` evaluated once, also where `body` uses it in a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    def add(done: Column, x: Column) -> Column:
        return F.concat(done, F.array(F.when(F.size(done) == 0, x).otherwise(join(F.element_at(done, -1), x))))

    # An empty array has no last element, so the branch above guards the look-up.
    return F.aggregate(values, F.array().cast("array<int>"), add)


def running(values: Column, join: Callable[[Column, Column], Column], levels: int = 3) -> Column:
    """Inclusive running result of an associative `join` over an `array<int>`.

    Appending copies the array built so far, so the values are joined in short blocks that are written out, and the
    blocks' results carried over in the same way, `levels` times: linear work for long arrays.
    """
    def block(a: Column, start: Column) -> Column:
        upto = accumulate((F.get(a, start + k) for k in range(RUN_BLOCK)), join)
        return F.slice(F.array(*upto), F.lit(1), F.least(F.lit(RUN_BLOCK), F.size(a) - start))

    def carried(ends: Column) -> Column:
        return running(ends, join, levels - 1) if levels > 1 else _scan(ends, join)

    def over(a: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(a) - 1, F.lit(RUN_BLOCK))
        return bind(F.transform(starts, lambda s: block(a, s)), lambda blocks: bind(
            carried(F.transform(blocks, lambda x: F.element_at(x, -1))),
            lambda ends: F.flatten(F.transform(blocks, lambda x, i: F.when(i == 0, x).otherwise(
                bind(F.get(ends, i - 1), lambda before: F.transform(x, lambda y: join(before, y))))))))

    return bind(values, lambda a: F.when(F.size(a) > 0, over(a)).otherwise(a))


def running_sums(values: Column) -> Column:
    return running(values, lambda a, b: a + b)


def running_max(values: Column) -> Column:
    return running(values, lambda a, b: F.greatest(a, b))
