from quarry.session import scratch_path
from quarry.streaming.messages import format_messages, parse_messages, start_message_stream

ROWS = [(1549000000000 + i, i, f"192.168.2.{i * 37 % 255}") for i in range(10)]


def test_format_then_parse(spark):
    df = spark.createDataFrame(ROWS, "millis long, n long, ip string")
    msgs = format_messages(df, "millis", "n", "ip")
    first = msgs.first()
    assert first.key == "192.168.2.0" and first.value == "1549000000000,0,www.example.com,192.168.2.0"
    back = sorted(tuple(r) for r in parse_messages(msgs).collect())
    assert back == sorted((ip, m, n, "www.example.com", ip) for m, n, ip in ROWS)


def test_stream_equals_batch(spark):
    df = spark.createDataFrame(ROWS, "millis long, n long, ip string")
    msgs = format_messages(df, "millis", "n", "ip")
    src, sink, ckpt = (scratch_path(spark, k) for k in ("t-src", "t-sink", "t-ckpt"))
    msgs.repartition(3).write.parquet(src)
    q = start_message_stream(spark, src, sink, ckpt, available_now=True, max_files_per_trigger=1)
    q.awaitTermination()
    assert q.exception() is None
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    assert streamed == sorted(tuple(r) for r in parse_messages(msgs).collect())
    # a second run with the same checkpoint finds nothing new (exactly once)
    q2 = start_message_stream(spark, src, sink, ckpt, available_now=True)
    q2.awaitTermination()
    assert spark.read.parquet(sink).count() == len(ROWS)


def test_processing_time_trigger_memory_sink(spark):
    df = spark.createDataFrame(ROWS, "millis long, n long, ip string")
    src, ckpt = scratch_path(spark, "t-src2"), scratch_path(spark, "t-ckpt2")
    format_messages(df, "millis", "n", "ip").write.parquet(src)
    q = start_message_stream(spark, src, None, ckpt, available_now=False, processing_time="1 second",
                             sink_format="memory", query_name="messages_mem_test")
    try:
        q.processAllAvailable()
        got = sorted(tuple(r) for r in spark.table("messages_mem_test").collect())
    finally:
        q.stop()
    assert got == sorted((ip, m, n, "www.example.com", ip) for m, n, ip in ROWS)


def test_message_times_do_not_depend_on_session_time_zone(spark):
    from __spark_entry__ import queries

    sf = "/root/testdata/sf0.001"
    utc = sorted(tuple(r) for r in queries()["message_parse"](spark, sf).collect())
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        la = sorted(tuple(r) for r in queries()["message_parse"](spark, sf).collect())
        trades = queries()["delimited_events"](spark, sf).select("timestamp").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert la == utc
    assert trades[0].timestamp.startswith("2024-")
