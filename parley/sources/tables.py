"""Reading and writing tables as feather (default), CSV or Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from parley.sources.feather import FeatherDataSource

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def read_table(spark: SparkSession, path: str, format: str = "feather", schema: T.StructType | None = None) -> DataFrame:
    """Any format name but `feather` and `csv` means Parquet. Give CSV a schema: nothing is inferred."""
    if format == "feather":
        spark.dataSource.register(FeatherDataSource)
        reader = spark.read.format("feather")
    elif format == "csv":
        reader = spark.read.format("csv").options(**CSV_OPTIONS)
    else:
        reader = spark.read.format("parquet")
    return (reader if schema is None else reader.schema(schema)).load(path)


def write_table(df: DataFrame, path: str, format: str = "feather", mode: str = "overwrite") -> None:
    if format == "feather":
        df.sparkSession.dataSource.register(FeatherDataSource)
        df.write.format("feather").mode(mode).save(path)
    elif format == "csv":
        df.write.format("csv").options(header="true", quote='"', escape='"').mode(mode).save(path)
    else:
        df.write.format("parquet").mode(mode).save(path)
