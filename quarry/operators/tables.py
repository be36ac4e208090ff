"""Catalog sinks: save a query result as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.session import scratch_path


def save_table(
    df: DataFrame, name: str, mode: str = "errorifexists", path: str | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Create catalog table ``name`` from ``df`` (CREATE TABLE ... AS SELECT).

    Fails if the table exists unless ``mode`` says otherwise.  The files go
    to ``path``, by default a fresh folder under the shared folder.
    Materialises: writes when called; returns the table.
    """
    spark: SparkSession = df.sparkSession
    location = path or scratch_path(spark, "tables")
    df.write.format(fmt).mode(mode).option("path", location).saveAsTable(name)
    return spark.table(name)


def create_table_as(
    spark: SparkSession, name: str, select_sql: str, path: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """SQL form: ``CREATE TABLE name USING fmt LOCATION path AS <select_sql>``.

    Fails with TABLE_OR_VIEW_ALREADY_EXISTS when the table exists.  The
    files go to ``path``, by default a fresh folder under the shared folder.
    """
    location = path or scratch_path(spark, "tables")
    spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{location}' AS {select_sql}")
    return spark.table(name)


def save_bucketed_table(
    df: DataFrame, name: str, key: str, buckets: int, mode: str = "errorifexists",
    path: str | None = None, fmt: str = "parquet",
) -> DataFrame:
    """Save ``df`` hash-bucketed by ``key`` into ``buckets`` buckets, sorted by
    ``key`` inside each (one file per bucket and write task).  Tables
    bucketed alike on the same key type are
    co-located: aggregating or joining them on ``key`` needs no shuffle,
    which is what a hash-partitioned pair join does once per run, written
    down once for every later run."""
    spark: SparkSession = df.sparkSession
    location = path or scratch_path(spark, "tables")
    (
        df.write.format(fmt).mode(mode).option("path", location)
        .bucketBy(buckets, key).sortBy(key)
        .saveAsTable(name)
    )
    return spark.table(name)
