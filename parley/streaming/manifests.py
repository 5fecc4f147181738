"""Recording manifests as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parley import schemas
from parley.sources.manifests import recordings


def stream_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Recordings of each new manifest file; the batch filters apply unchanged."""
    return recordings(spark.readStream.schema(schemas.MANIFEST).json(path, multiLine=True))
