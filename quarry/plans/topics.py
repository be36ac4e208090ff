"""Message jobs over topics: written by key, read by offset, streamed, restarted.

The messages are those of the events table, as they might arrive: in thirds, the
earlier events first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.keyed import observed_totals, write_with_metrics
from quarry.plans import standins as S
from quarry.session import scratch_path
from quarry.sources.tables import read_table
from quarry.sources.topic import filesystem
from quarry.streaming.effects import read_effects, start_effects
from quarry.streaming.messages import PARSED_MESSAGE_SCHEMA, format_messages, parse_messages, start_stream
from quarry.streaming import topics as T

PARTS = 3


def _arrivals(spark: SparkSession, d: str) -> list[DataFrame]:
    """(key, value, n) of the events in ``PARTS`` parts by event id."""
    rows = S.message_rows_from_events(read_table(spark, d, "events"))
    total = (rows.agg(F.max("n")).first()[0] or 0) + 1
    messages = format_messages(rows, "millis", "n", "ip")
    messages = messages.withColumn("n", F.split("value", ",")[1].cast("long"))
    part = F.floor(F.col("n") * PARTS / F.lit(total))
    return [messages.where(part == k) for k in range(PARTS)]


def _partition() -> Column:
    """The partition of an address: its last number's remainder."""
    return F.substring_index("key", ".", -1).cast("int") % T.PARTITIONS


def _append(part: DataFrame, topic: str) -> None:
    T.write_topic(part, topic, ["n"], partition=_partition())


def _topic(spark: SparkSession, d: str) -> str:
    topic = scratch_path(spark, "topic")
    for part in _arrivals(spark, d):
        _append(part, topic)
    return topic


def _ended(query: StreamingQuery) -> StreamingQuery:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def _forget_last_batch(checkpoint: str) -> None:
    """Leaves a checkpoint as a run does that dies after its last batch has reached
    the sink and before Spark has noted that: the next run repeats the batch."""
    from pyarrow import fs

    files, root = filesystem(f"{checkpoint}/commits")
    names = [f.base_name for f in files.get_file_info(fs.FileSelector(root))]
    last = max(int(n) for n in names if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if name in names:
            files.delete_file(f"{root}/{name}")


def topic_messages(spark: SparkSession, d: str) -> DataFrame:
    """A keyed write in several commits, read back with partition and offset."""
    return T.read_topic(spark, _topic(spark, d))


def topic_offset_range(spark: SparkSession, d: str) -> DataFrame:
    """The middle third of the offsets of every partition, and only that, is read."""
    topic = _topic(spark, d)
    ends = T.end_offsets(topic)
    return T.read_topic(spark, topic, {p: n // 3 for p, n in ends.items()}, {p: 2 * n // 3 for p, n in ends.items()})


def topic_stream(spark: SparkSession, d: str) -> DataFrame:
    """A subscription from the earliest offset, parsed into files, read back."""
    topic = _topic(spark, d)
    sink, checkpoint = (scratch_path(spark, k) for k in ("stream-sink", "stream-checkpoint"))
    _ended(start_stream(parse_messages(T.read_topic_stream(spark, topic, "earliest")), sink, checkpoint))
    return spark.read.schema(PARSED_MESSAGE_SCHEMA).parquet(sink)


def topic_stream_restart(spark: SparkSession, d: str) -> DataFrame:
    """How often a stream that starts at the latest offset has seen each message of
    its topic: never what was there before, once all that came while it ran, and
    once what came after it was stopped and before it was started again."""
    parts = _arrivals(spark, d)
    topic, sink, checkpoint = (scratch_path(spark, k) for k in ("topic", "stream-sink", "stream-checkpoint"))
    _append(parts[0], topic)

    def started() -> StreamingQuery:
        messages = T.start_group(spark, topic, checkpoint, "latest")
        return start_stream(parse_messages(messages), sink, checkpoint, available_now=False, processing_time="0 seconds")

    query = started()
    try:
        query.processAllAvailable()
        _append(parts[1], topic)
        query.processAllAvailable()
    finally:
        query.stop()
    _append(parts[2], topic)
    query = started()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    seen = spark.read.schema(PARSED_MESSAGE_SCHEMA).parquet(sink).groupBy("n").agg(F.count(F.lit(1)).alias("_seen"))
    told = parse_messages(T.read_topic(spark, topic)).select("key", "n")
    return told.join(seen, "n", "full").select("key", "n", F.coalesce("_seen", F.lit(0)).cast("long").alias("seen"))


def topic_copy(spark: SparkSession, d: str) -> DataFrame:
    """A topic written by a stream, a commit for each batch, of which one is repeated
    after a run has died, read back."""
    topic, copy, checkpoint = (scratch_path(spark, k) for k in ("topic", "topic-copy", "stream-checkpoint"))

    def run() -> None:
        messages = T.read_topic_stream(spark, topic, "earliest").select("key", "value")
        _ended(T.start_to_topic(messages, copy, checkpoint, "copy"))

    for part in _arrivals(spark, d):
        _append(part, topic)
        run()
    _forget_last_batch(checkpoint)
    run()
    return T.read_topic(spark, copy).select("key", "value")


def topic_key_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals per key that a stream keeps up over several batches: the last that it
    has told of each key."""
    topic, told, checkpoint = (scratch_path(spark, k) for k in ("topic", "topic-totals", "stream-checkpoint"))
    for part in _arrivals(spark, d):
        _append(part, topic)
        running = T.key_totals(parse_messages(T.read_topic_stream(spark, topic, "earliest")))
        _ended(start_effects(running, told, checkpoint, output_mode="update"))
    return T.latest_totals(read_effects(spark, told, checkpoint, "key string, n long, total long"))


def topic_effects(spark: SparkSession, d: str) -> DataFrame:
    """A line for every record of a topic, written as a side effect of a stream that
    repeats a batch after a run has died."""
    topic, told, checkpoint = (scratch_path(spark, k) for k in ("topic", "topic-lines", "stream-checkpoint"))
    line = F.concat(F.lit("record.key: "), "key", F.lit(" record.value: "), "value").alias("line")

    def run() -> None:
        _ended(start_effects(T.read_topic_stream(spark, topic, "earliest").select(line), told, checkpoint))

    for part in _arrivals(spark, d):
        _append(part, topic)
        run()
    _forget_last_batch(checkpoint)
    run()
    return read_effects(spark, told, checkpoint, "line string").select("line")


def observed_write(spark: SparkSession, d: str) -> DataFrame:
    """Count, sum and average of a column, observed while the rows are written."""
    found = write_with_metrics(read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber"), "l_linenumber",
                               scratch_path(spark, "observed"))
    return spark.createDataFrame([(found["n"], found["total"], found["mean"])], "n long, total long, mean double")


def observed_stream(spark: SparkSession, d: str) -> DataFrame:
    """Count and sum of a column over all batches of a stream, observed while it
    writes, one row per run of several."""
    parts = _arrivals(spark, d)
    topic, sink, checkpoint = (scratch_path(spark, k) for k in ("topic", "stream-sink", "stream-checkpoint"))
    rows = []
    for k, part in enumerate(parts):
        _append(part, topic)
        messages = parse_messages(T.read_topic_stream(spark, topic, "earliest"))
        watched = messages.observe("quarry_stream", F.count("n").alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"))
        found = observed_totals(_ended(start_stream(watched, sink, checkpoint)), "quarry_stream")
        rows.append((k, found.get("n", 0), found.get("total", 0)))
    return spark.createDataFrame(rows, "part long, n long, total long")


TOPIC_QUERIES = {f.__name__: f for f in (
    topic_messages, topic_offset_range, topic_stream, topic_stream_restart, topic_copy, topic_key_totals, topic_effects, observed_write,
    observed_stream)}
