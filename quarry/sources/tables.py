"""Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, data_dir: str, name: str, schema: StructType | None = None) -> DataFrame:
    """``{data_dir}/{name}.parquet`` (column pruning and filters reach the scan).
    The schema comes from the files unless the caller knows it."""
    path = f"{data_dir.rstrip('/')}/{name}.parquet"
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
