"""Keyed messages ``millis,n,host,ip`` (key = ip): format, parse, and run the
parse as a Structured Streaming query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Fixed values of the message producer: host field and field delimiter.
MESSAGE_HOST = "www.example.com"
MESSAGE_DELIMITER = ","

MESSAGE_SCHEMA = StructType(
    [StructField("key", StringType(), True), StructField("value", StringType(), True)]
)
PARSED_MESSAGE_SCHEMA = StructType(
    [
        StructField("key", StringType(), True),
        StructField("millis", LongType(), True),
        StructField("n", LongType(), True),
        StructField("host", StringType(), True),
        StructField("ip", StringType(), True),
    ]
)


def format_messages(df: DataFrame, millis: str, n: str, ip: str, host: str = MESSAGE_HOST) -> DataFrame:
    """``(key, value)`` with key = ip and value = ``millis,n,host,ip``.

    A null part, or text with the delimiter in it, could not be read back and
    fails the job.
    """
    def part(c: Column) -> Column:
        bad = c.isNull() | F.contains(c, F.lit(MESSAGE_DELIMITER))
        return F.when(bad, F.raise_error(F.concat(F.lit("bad message part: "), F.coalesce(c, F.lit("null"))))).otherwise(c)

    parts = [F.col(millis).cast("string"), F.col(n).cast("string"), F.lit(host), F.col(ip)]
    value = F.concat_ws(MESSAGE_DELIMITER, *[part(c) for c in parts])
    return df.select(F.col(ip).alias("key"), value.alias("value"))


def parse_messages(df: DataFrame, strict: bool = True) -> DataFrame:
    """``(key, value)`` -> ``key, millis, n, host, ip`` (works on batch and
    streaming frames alike).

    A message without exactly four parts, or with a bad number, fails the
    job; with ``strict=False`` its fields are null and ``reject`` holds its
    text (null for good messages).
    """
    parts: Column = F.split("value", MESSAGE_DELIMITER)
    millis, n = F.get(parts, 0).try_cast("long"), F.get(parts, 1).try_cast("long")
    good = F.coalesce((F.size(parts) == 4) & millis.isNotNull() & n.isNotNull(), F.lit(False))
    fields = {"millis": millis, "n": n, "host": F.get(parts, 2), "ip": F.get(parts, 3)}
    if strict:
        failed = F.raise_error(F.concat(F.lit("bad message: "), F.coalesce("value", F.lit("null"))))
        return df.select("key", *[F.when(good, c).otherwise(failed).alias(name) for name, c in fields.items()])
    return df.select("key", *[F.when(good, c).alias(name) for name, c in fields.items()],
                     F.when(~good, F.coalesce("value", F.lit(""))).alias("reject"))


def start_message_stream(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str | None,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str = "1 second",
    max_files_per_trigger: int | None = None,
    sink_format: str = "parquet",
    query_name: str | None = None,
) -> StreamingQuery:
    """Stream message files (parquet ``key, value``) from ``source_dir``,
    parse them and append them to a sink: ``parquet`` files under
    ``sink_dir`` (exactly once, with the sink's own log), ``console``
    (prints each micro-batch) or ``memory`` (table ``query_name``).
    Progress lives in ``checkpoint_dir``.  ``available_now`` processes what
    is there and stops; otherwise micro-batches run every
    ``processing_time``."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return start_stream(parse_messages(reader.parquet(source_dir)), sink_dir, checkpoint_dir, available_now,
                        processing_time, sink_format, query_name)


def start_stream(
    stream: DataFrame,
    sink_dir: str | None,
    checkpoint_dir: str,
    available_now: bool = True,
    processing_time: str = "1 second",
    sink_format: str = "parquet",
    query_name: str | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Run any streaming frame (from files, a Kafka topic, ...) into a sink in
    append mode, with the trigger and sinks of :func:`start_message_stream`;
    ``options`` go to the sink."""
    writer = (
        stream.writeStream.format(sink_format)
        .option("checkpointLocation", checkpoint_dir)
        .options(**(options or {}))
        .outputMode("append")
    )
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start(sink_dir) if sink_format == "parquet" else writer.start()


def kafka_messages(
    spark: SparkSession, brokers: str, topic: str, starting_offsets: str = "latest",
    group_id: str | None = None,
) -> DataFrame:
    """Parsed messages of a Kafka topic as a streaming frame (needs the Kafka
    connector on the classpath)."""
    from quarry.sources.kafka import read_kafka_stream

    return parse_messages(read_kafka_stream(spark, brokers, topic, starting_offsets, group_id))


def start_topic_stream(
    messages: DataFrame, brokers: str, topic: str, checkpoint_dir: str, available_now: bool = True,
    processing_time: str = "1 second",
) -> StreamingQuery:
    """Write a streaming ``(key, value)`` frame to a topic (needs the Kafka
    connector on the classpath)."""
    from quarry.sources.kafka import kafka_sink_options

    return start_stream(messages.select("key", "value"), None, checkpoint_dir, available_now, processing_time,
                        "kafka", options=kafka_sink_options(brokers, topic))
