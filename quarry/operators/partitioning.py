"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a plain scan: round-robin the rows over at least ``min_partitions`` tasks (default:
    the cluster's default parallelism) when the input has fewer partitions,
    e.g. a few large files or row groups feeding CPU-heavy per-row work.
    When the input is already wide enough (the normal case at scale) the
    frame is returned unchanged and no shuffle is added.  A frame that
    already has a shuffle (its partition count is known only once it has run)
    is returned unchanged too, and so is one of a Spark Connect session.
    Planning only, no job runs."""
    if not hasattr(df, "_jdf") or "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if df.rdd.getNumPartitions() < want else df
