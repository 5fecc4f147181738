"""A log of stages, kept as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from parley import schemas


def observed(df: DataFrame, stage: str, failed: Column | None = None) -> tuple[DataFrame, Observation]:
    """`df` that counts its rows and failures while it is written, without another pass."""
    observation = Observation(stage)
    failures = F.lit(False) if failed is None else failed
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), F.count_if(failures).alias("errors")), observation


def write_run_log(spark: SparkSession, path: str, stage: str, metrics: dict, errors: list[str] = ()) -> None:
    """Append one row for the stage's metrics and one for each error."""
    summary = ", ".join(f"{k}={v}" for k, v in sorted(metrics.items()))
    rows = [(stage, "INFO", summary), *[(stage, "ERROR", e) for e in errors]]
    entries = spark.createDataFrame(rows, "stage string, level string, message string")
    log = entries.withColumn("logged_at", F.current_timestamp()).select(schemas.RUN_LOG.fieldNames())
    log.write.mode("append").parquet(path)
