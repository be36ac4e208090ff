"""Jobs on topics (:mod:`quarry.sources.topic`): keyed writes, reads by offset,
streams that begin at a position of their own and go on where they stopped, and
totals per key that follow a stream."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.sources.topic import TopicLog, TopicSource, filesystem

PARTITIONS = 8


def register_topics(spark: SparkSession) -> None:
    spark.dataSource.register(TopicSource)


def partition_of(key: Column, partitions: int) -> Column:
    """The partition of a key, by its hash (null keys share one)."""
    return F.pmod(F.hash(key), F.lit(partitions)).cast("int")


def message_columns(partitions: int = PARTITIONS, partition: Column | None = None) -> list[Column]:
    """``partition, key, value`` from ``key`` and ``value``; ``partition`` overrides the
    key's hash and must depend on the key alone for the key's order to hold."""
    place = partition_of(F.col("key"), partitions) if partition is None else partition.cast("int")
    return [place.alias("partition"), F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value")]


def write_topic(df: DataFrame, path: str, order_by: list[str], partitions: int = PARTITIONS,
                partition: Column | None = None) -> None:
    """Appends ``df`` (key, value, ...) to a topic, each partition in the order of
    ``order_by`` (without ties).

    Rows are range-partitioned by (partition, order), so a partition that a hot key
    fills is written by many tasks; the commit joins their segments in that order.
    """
    register_topics(df.sparkSession)
    order = {f"_q_order{k}": F.col(c) for k, c in enumerate(order_by)}
    rows = df.select(*message_columns(partitions, partition), *[c.alias(name) for name, c in order.items()])
    rows = rows.repartitionByRange("partition", *order).sortWithinPartitions("partition", *order).drop(*order)
    rows.write.format("topic").option("path", path).mode("append").save()


def read_topic(spark: SparkSession, path: str, start: str | dict = "earliest", end: str | dict = "latest") -> DataFrame:
    """``partition, offset, key, value`` of the messages from ``start`` to before
    ``end`` (``earliest``, ``latest`` or ``{partition: offset}``); only segments, and
    in them only row groups, with such offsets are read."""
    register_topics(spark)
    return spark.read.format("topic").options(
        path=path, startingOffsets=_text(start), endingOffsets=_text(end)).load()


def _text(offsets: str | dict) -> str:
    return offsets if isinstance(offsets, str) else json.dumps({str(p): n for p, n in offsets.items()})


def end_offsets(path: str) -> dict[str, int]:
    """The offset after the last message of each partition, now."""
    return TopicLog(path).ends()


def read_topic_stream(spark: SparkSession, path: str, start: str | dict = "latest") -> DataFrame:
    """A stream of ``partition, offset, key, value``, planned anew for each
    micro-batch as ranges of segments that executors read apart."""
    register_topics(spark)
    return spark.readStream.format("topic").options(path=path, startingOffsets=_text(start)).load()


def group_start(path: str, checkpoint: str, start: str | dict = "latest") -> dict[str, int]:
    """Where a group of runs with one checkpoint begins.

    ``start`` is settled by the first run, before it reads, and kept beside the
    checkpoint: a run that fails in its first batch begins there again, not at what
    is latest then.  From the first batch on the checkpoint itself tells the place.
    """
    fs, inner = filesystem(f"{checkpoint.rstrip('/')}.start.json")
    from pyarrow import fs as afs

    if fs.get_file_info(inner).type == afs.FileType.NotFound:
        settled = {} if start == "earliest" else TopicLog(path).ends() if start == "latest" else {str(p): n for p, n in start.items()}
        fs.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        with fs.open_output_stream(f"{inner}.draft") as f:
            f.write(json.dumps(settled).encode())
        fs.move(f"{inner}.draft", inner)
    with fs.open_input_stream(inner) as f:
        return json.loads(f.read())


def start_group(spark: SparkSession, path: str, checkpoint: str, start: str | dict = "latest") -> DataFrame:
    """:func:`read_topic_stream` from :func:`group_start`."""
    return read_topic_stream(spark, path, group_start(path, checkpoint, start))


def start_to_topic(messages: DataFrame, path: str, checkpoint: str, writer: str, partitions: int = PARTITIONS,
                   processing_time: str | None = None) -> StreamingQuery:
    """Writes a streaming ``(key, value)`` frame to a topic, each batch once.

    Rows of a key meet in one task and keep their order there.  ``writer`` names
    the query towards the topic: of its batches every one is committed once, also
    if a run stopped between the commit and Spark's own note of it.
    """
    register_topics(messages.sparkSession)
    rows = messages.select(*message_columns(partitions)).repartition(partitions, "partition")
    query = rows.writeStream.format("topic").option("path", path).option("writer", writer).option(
        "checkpointLocation", checkpoint).outputMode("append")
    return (query.trigger(processingTime=processing_time) if processing_time else query.trigger(availableNow=True)).start()


# Totals per key ---------------------------------------------------------------

def key_totals(messages: DataFrame) -> DataFrame:
    """``key, n, total`` of parsed messages (key, n): running in a stream, where
    Spark's state store holds one row per key."""
    return messages.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("total"))


def latest_totals(told: DataFrame) -> DataFrame:
    """``key, n, total`` as last told of each key, from rows with ``epoch``."""
    return told.groupBy("key").agg(F.max_by("n", "epoch").alias("n"), F.max_by("total", "epoch").alias("total"))
