"""Choosing among transcription candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_hypothesis(df: DataFrame, keys: list[str], compression: float | None = 2.4,
                      logprob: float | None = -1.0, no_speech: float | None = 0.6) -> DataFrame:
    """First acceptable candidate by temperature, else the likeliest one.

    A candidate fails if it is too repetitive or too unlikely, unless it is silence. When all
    fail, the likeliest of those not too repetitive (or of all) wins and reports the last
    temperature tried. One aggregation, combined before the shuffle.
    """
    off = F.lit(False)
    repetitive = off if compression is None else F.col("compression_ratio") > compression
    unlikely = off if logprob is None else F.col("avg_logprob") < logprob
    silent = off if None in (no_speech, logprob) else (F.col("no_speech_prob") > no_speech) & unlikely
    accepted = ~(repetitive | unlikely) | silent
    usable = off if compression is None else ~repetitive
    row = F.struct(*[c for c in df.columns if c not in keys])
    likeliest = F.struct("avg_logprob", -F.col("temperature"))
    picked = df.groupBy(*keys).agg(
        F.min_by(row, F.when(accepted, F.col("temperature"))).alias("_accepted"),
        F.max_by(row, F.when(usable, likeliest)).alias("_usable"),
        F.max_by(row, likeliest).alias("_any"),
        F.max("temperature").alias("_last"))
    best = picked.withColumn("_best", F.coalesce("_accepted", "_usable", "_any"))
    return best.select(
        *keys, *[F.col(f"_best.{c}") for c in df.columns if c not in (*keys, "temperature")],
        F.when(F.col("_accepted").isNotNull(), F.col("_best.temperature")).otherwise(F.col("_last")).alias("temperature"),
        F.col("_accepted").isNotNull().alias("accepted"))
