"""Results of stages, kept per call so that a rerun computes only what is new."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.operators.lookup import same_keys


def _content(columns: Sequence[str]) -> Column:
    """Number of rows and sums of both halves of their 128-bit digests: merges in any order, so no key is one task."""
    seen = F.md5(F.to_json(F.struct(*columns)))
    halves = [F.sum(F.conv(F.substring(seen, at, 16), 16, 10).cast("decimal(20,0)")).cast("string") for at in (1, 17)]
    return F.concat_ws("-", F.count(F.lit(1)).cast("string"), *halves)


def content_digests(rows: DataFrame, call: str, columns: Sequence[str]) -> DataFrame:
    """`(call, digest)`: what the rows of each call hold in `columns`, whatever their order. Rows without a call are
    one call; repeated rows count."""
    return rows.groupBy(call).agg(_content(columns).alias("digest"))


def table_digest(rows: DataFrame, columns: Sequence[str]) -> str:
    """What a whole table holds in `columns`."""
    return rows.agg(_content(columns).alias("digest")).first()["digest"]


class StageStore:
    """A folder with the rows that each stage gave for each call, under the digest of what it was given.

    A stage writes its rows first and then marks its calls as finished, both with the number of the run. Rows without
    a mark are ignored, so a run that broke off is repeated without doubling anything; of two runs that did the same
    call at the same time the first number counts. A call without rows is marked too and not tried again.
    """

    def __init__(self, spark: SparkSession, folder: str, call: str = "call_id"):
        self.spark, self.folder, self.call = spark, folder, call

    def _stored(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def run(self, name: str, digests: DataFrame, compute: Callable[[DataFrame], DataFrame], *settings: object) -> DataFrame:
        """Rows of a stage for the calls of `digests` (call, digest; one row each, materialised).

        `compute` takes the calls that have no result yet and returns rows with their call. `settings` are all that
        the stage depends on besides the calls; other settings are another stage.
        """
        path = f"{self.folder}/{name}-{hashlib.sha256(repr(settings).encode()).hexdigest()[:16]}"
        keys = [self.call, "digest"]
        finished = self._stored(f"{path}/finished")
        todo = digests.select(*keys)
        if finished is not None:
            todo = same_keys(todo, finished.select(*keys), keys, "left_anti")
        if finished is None or not todo.isEmpty():
            run = F.lit(uuid4().hex).alias("run")
            done = same_keys(compute(todo.select(self.call)), todo, [self.call])
            done.select("*", run).write.mode("append").parquet(f"{path}/rows")
            todo.select("*", run).write.mode("append").parquet(f"{path}/finished")
        marks = same_keys(self._stored(f"{path}/finished"), digests, keys, "left_semi").groupBy(*keys).agg(F.min("run").alias("run"))
        return same_keys(self._stored(f"{path}/rows"), marks, [*keys, "run"], "left_semi").drop("digest", "run")
