"""Session settings and lineage cuts shared by all operators."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Results depend on the time zone; skew handling relies on adaptive execution.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.replaceHashWithSortAgg": "true",  # rows that are sorted by their groups are folded in one pass
}
# Before an array is exploded, Spark would filter out rows where it is empty. The filter repeats all that the array is made
# of and is moved below `spread`, so that costly row work runs twice, once in the few splits of the reader.
EXCLUDED_RULES = "spark.sql.optimizer.excludedRules"
EMPTY_ARRAYS_FIRST = "org.apache.spark.sql.catalyst.optimizer.InferFiltersFromGenerate"

# Bytes of text that make a part of `spread_by`, some 25 times as many once words are rows, and its parts at most.
PART_BYTES = 4 << 20
MAX_PARTS = 8192


def tune(spark: SparkSession) -> SparkSession:
    """Set the SQL settings the operators rely on."""
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    excluded = [r for r in (spark.conf.get(EXCLUDED_RULES, None) or "").split(",") if r]
    if EMPTY_ARRAYS_FIRST not in excluded:
        spark.conf.set(EXCLUDED_RULES, ",".join([*excluded, EMPTY_ARRAYS_FIRST]))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for cut lineage: the cluster's `spark.checkpoint.dir`.

    Only a local session may fall back to a folder of its own; on a cluster a machine-local
    folder would vanish with its executor, so a missing setting is an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return configured or current.get()
    if configured is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="parley-")
    sc.setCheckpointDir(configured)
    return configured


def spread(df: DataFrame) -> DataFrame:
    """Deal out rows that the reader leaves in fewer splits than there are cores.

    For costly work per row on a small input, such as one file of one row group, which no
    setting of the reader can split. The planned splits are counted, not files, and no file is
    listed here; an input with a split for every core is left as it is and not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def spread_by(df: DataFrame, keys: Sequence[str], size: int, part_bytes: int = PART_BYTES) -> DataFrame:
    """Deal out rows of `size` bytes by key before they are turned into many more, which then lie by key already.

    Rows of one key are together, as for any grouping by it. A part is small enough that a task sorts in memory what it
    makes of it; the parts are counted here, so that they are not joined to larger ones.
    """
    parts = min(max(-(-size // part_bytes), df.sparkSession.sparkContext.defaultParallelism), MAX_PARTS)
    return df.repartition(parts, *keys)


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` reliably, so several later passes do not recompute it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
