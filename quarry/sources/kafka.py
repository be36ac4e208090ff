"""Kafka topics as streams or batches (needs the spark-sql-kafka package on
the classpath; the options are built and checked without it)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_source_options(
    brokers: str,
    topic: str,
    starting_offsets: str = "latest",
    group_id: str | None = None,
) -> dict[str, str]:
    """Reader options for one topic.  Offsets are tracked in the query's
    checkpoint, which replaces consumer-side commits."""
    opts = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if group_id:
        opts["kafka.group.id"] = group_id
    return opts


def kafka_sink_options(brokers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic}


def read_kafka_stream(
    spark: SparkSession, brokers: str, topic: str, starting_offsets: str = "latest",
    group_id: str | None = None, with_offsets: bool = False,
) -> DataFrame:
    """Streaming ``(key, value)`` strings of a topic (plus ``offset`` on request)."""
    raw = (
        spark.readStream.format("kafka")
        .options(**kafka_source_options(brokers, topic, starting_offsets, group_id))
        .load()
    )
    cols = [F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")]
    if with_offsets:
        cols.append(F.col("offset"))
    return raw.select(*cols)


def write_kafka(df: DataFrame, brokers: str, topic: str) -> None:
    """Batch write of ``(key, value)`` rows to a topic."""
    df.select("key", "value").write.format("kafka").options(**kafka_sink_options(brokers, topic)).save()
