"""Hooks for models: the model is loaded once per task, not once per row."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame


def score_batches(df: DataFrame, loader: Callable[[], Any], fn: Callable[[Any, pd.DataFrame], pd.DataFrame],
                  schema: str) -> DataFrame:
    """Apply `fn(model, batch)` to Arrow batches; `loader()` runs once per task."""
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loader()
        for batch in batches:
            yield fn(model, batch)

    return df.mapInPandas(score, schema)


def score_files(files: DataFrame, loader: Callable[[], Any], fn: Callable[[Any, pd.DataFrame], pd.DataFrame],
                schema: str, partitions: int) -> DataFrame:
    """Apply a model to files, spread over `partitions` tasks whatever their sizes."""
    return score_batches(files.repartition(partitions, "path"), loader, fn, schema)


def score_groups(df: DataFrame, keys: list[str], order: list[str],
                 fn: Callable[[tuple, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """Sequential logic per key: `fn(key, batches)` sees the rows in `order`, one batch at a time.

    Batches are bounded, so a long group is streamed through its task and never held whole.
    """
    rows = df.repartition(*keys).sortWithinPartitions(*keys, *order)

    def run(key: tuple, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from fn(key, batches)

    return rows.groupBy(*keys).applyInPandas(run, schema)
