"""Recordings as files, and inventories of folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parley.functions.audio import wav_samples


def read_audio_files(spark: SparkSession, path: str, pattern: str = "*.wav") -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)


def read_wav(spark: SparkSession, path: str, pattern: str = "*.wav") -> DataFrame:
    """Rate, channels and samples of WAV files; nulls for a file that cannot be read."""
    files = read_audio_files(spark, path, pattern)
    return files.withColumn("_wav", wav_samples("content")).select("path", "_wav.*")


def _scan(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Base name, size and time of the files below `path`; their bytes are not read.

    An empty file has no row.
    """
    return _scan(spark, path).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length", "modificationTime")


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Number of files (empty ones too), their bytes, and the latest change of those not empty."""
    n_files = len(_scan(spark, path).inputFiles())
    return list_files(spark, path).agg(
        F.lit(n_files).cast("long").alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
        F.max("modificationTime").alias("latest"))
