"""Landed recording manifests and topic taxonomies."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley import schemas

LEGACY_SEGMENT = T.StructType([*schemas.SEGMENT.fields, T.StructField("sentiment", T.StringType())])


def recordings(pages: DataFrame) -> DataFrame:
    """One row per recording of manifest pages."""
    return pages.select(F.explode("recordings").alias("r")).select("r.*")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All pages of a manifest: JSON objects with an array `recordings`."""
    return recordings(spark.read.schema(schemas.MANIFEST).json(path, multiLine=True))


def load_taxonomy(df: DataFrame, taxonomy: str = "taxonomy") -> DataFrame:
    """Rows `(keys, topic, phrase_no, phrase)` of JSON maps from topic to phrases."""
    keys = [c for c in df.columns if c != taxonomy]
    parsed = F.from_json(F.col(taxonomy), "map<string,array<string>>")
    topics = df.select(*keys, F.explode(parsed).alias("topic", "_phrases"))
    return topics.select(*keys, "topic", F.posexplode("_phrases").alias("phrase_no", "phrase"))


def legacy_segments(column: str = "segmented_transcription") -> Column:
    """Segments stored as the text of a Python list of dicts; null where that cannot be read."""
    return _parse_segments(F.col(column))


@F.pandas_udf(T.ArrayType(LEGACY_SEGMENT))
def _parse_segments(text: pd.Series) -> pd.Series:
    import ast

    names = LEGACY_SEGMENT.fieldNames()

    def parse(value):
        try:
            return [{n: segment.get(n) for n in names} for segment in ast.literal_eval(value)]
        except (ValueError, SyntaxError, TypeError, AttributeError, MemoryError, RecursionError):
            return None

    return text.map(parse)
