"""Topics: offsets, ranges, commits, restarts and side effects."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quarry.operators.keyed import observed_totals
from quarry.plans.topics import _forget_last_batch
from quarry.session import scratch_path
from quarry.sources import topic as source
from quarry.sources.topic import TopicLog
from quarry.streaming import topics as T
from quarry.streaming.effects import read_effects, start_effects
from quarry.streaming.messages import start_stream


def rows(n, first=0, keys=5):
    return [(f"k{i % keys}", f"v{i}", i) for i in range(first, first + n)]


def frame(spark, data):
    return spark.createDataFrame(data, "key string, value string, n long")


def read(spark, path, *offsets):
    return sorted(tuple(r) for r in T.read_topic(spark, path, *offsets).collect())


@pytest.fixture
def topic(spark):
    return scratch_path(spark, "t-topic")


def test_offsets_have_no_gaps_and_keys_keep_their_order(spark, topic):
    said = {}
    for k in range(3):
        data = rows(200, 200 * k)
        T.write_topic(frame(spark, data).repartition(7), topic, ["n"], partitions=3)
        for key, value, _ in data:
            said.setdefault(key, []).append(value)
    found = read(spark, topic)
    for p in {r[0] for r in found}:
        assert [r[1] for r in found if r[0] == p] == list(range(sum(r[0] == p for r in found)))
    for key, values in said.items():
        assert [r[3] for r in found if r[2] == key] == values
        assert len({r[0] for r in found if r[2] == key}) == 1
    assert T.end_offsets(topic) == {str(p): sum(r[0] == p for r in found) for p in {r[0] for r in found}}


def test_a_hot_key_is_written_by_many_tasks(spark, topic):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")  # at this size one task would do
    try:
        T.write_topic(frame(spark, [("hot", f"v{i}", i) for i in range(20_000)]).repartition(4), topic, ["n"])
    finally:
        spark.conf.set(name, before)
    assert len(list(Path(topic, "segments").iterdir())) > 1
    assert [r[3] for r in read(spark, topic)] == [f"v{i}" for i in range(20_000)]


def test_a_range_plans_only_its_segments(spark, topic, monkeypatch):
    for k in range(4):
        T.write_topic(frame(spark, [("a", f"v{i}", i) for i in range(100 * k, 100 * k + 100)]).coalesce(1), topic, ["n"], partitions=1)
    log = TopicLog(topic)
    commits = []
    read_commit = TopicLog.commit
    monkeypatch.setattr(TopicLog, "commit", lambda self, name: commits.append(name) or read_commit(self, name))
    planned = source._plan(log, {"0": 250}, {"0": 320})
    assert {(p.start // 100, (p.end - 1) // 100) for p in planned} <= {(2, 2), (3, 3)}
    assert min(p.start for p in planned) == 250 and max(p.end for p in planned) == 320
    assert len(commits) == 2  # older commits are not even looked at
    assert [r[3] for r in read(spark, topic, {0: 250}, {0: 320})] == [f"v{i}" for i in range(250, 320)]
    assert read(spark, topic, {0: 400}) == [] and read(spark, topic, "latest") == []
    assert len(read(spark, topic, {0: 390}, {0: 10_000})) == 10


def test_large_segments_are_split_and_row_groups_skipped(spark, topic, monkeypatch):
    data = spark.range(200_000).select(F.lit("a").alias("key"), F.col("id").cast("string").alias("value"), F.col("id").alias("n"))
    T.write_topic(data.coalesce(1), topic, ["n"], partitions=1)
    monkeypatch.setattr(source, "SPLIT", 30_000)
    ends = T.end_offsets(topic)
    planned = source._plan(TopicLog(topic), {}, ends)
    assert len(planned) >= 6 and all(p.end - p.start <= 30_000 for p in planned)
    got = [v for p in planned for b in source._read(p) for v in zip(*(b.column(k).to_pylist() for k in (1, 3)))]
    assert got == [(i, str(i)) for i in range(200_000)]


def test_a_failed_write_leaves_nothing(spark, topic):
    T.write_topic(frame(spark, rows(10)), topic, ["n"])
    before = read(spark, topic)
    bad = F.when(F.col("n") == 37, F.raise_error(F.lit("broken"))).otherwise(F.col("value"))
    with pytest.raises(Exception, match="broken"):
        T.write_topic(frame(spark, rows(50)).repartition(3).withColumn("value", bad), topic, ["n"])
    assert read(spark, topic) == before


def test_overwriting_is_refused(spark, topic):
    T.register_topics(spark)
    with pytest.raises(Exception, match="only appended"):
        frame(spark, rows(1)).select(F.lit(0).alias("partition"), "key", "value").write.format("topic").option(
            "path", topic).mode("overwrite").save()


def test_empty_topics(spark, topic):
    assert read(spark, topic) == [] and T.end_offsets(topic) == {}
    T.write_topic(frame(spark, []), topic, ["n"])
    assert read(spark, topic) == []


def test_null_keys_and_values(spark, topic):
    T.write_topic(frame(spark, [(None, "v", 0), ("a", None, 1), (None, None, 2)]), topic, ["n"], partitions=2)
    found = T.read_topic(spark, topic).collect()
    assert sorted(((r.key, r.value) for r in found), key=str) == sorted([(None, "v"), ("a", None), (None, None)], key=str)


def run(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def test_latest_is_settled_once(spark, topic):
    """A run that dies before its first batch has a start all the same."""
    checkpoint = scratch_path(spark, "t-ckpt")
    T.write_topic(frame(spark, rows(10)), topic, ["n"], partitions=2)
    assert T.group_start(topic, checkpoint) == T.end_offsets(topic)
    T.write_topic(frame(spark, rows(10, 10)), topic, ["n"], partitions=2)
    sink = scratch_path(spark, "t-sink")
    run(start_stream(T.start_group(spark, topic, checkpoint), sink, checkpoint))
    assert sorted(r.value for r in spark.read.parquet(sink).collect()) == sorted(f"v{i}" for i in range(10, 20))


def test_restarts_lose_and_repeat_nothing(spark, topic):
    checkpoint, sink = scratch_path(spark, "t-ckpt"), scratch_path(spark, "t-sink")
    rng, first = random.Random(4), 0
    T.write_topic(frame(spark, rows(5)), topic, ["n"], partitions=2)
    for _ in range(3):
        query = start_stream(T.start_group(spark, topic, checkpoint), sink, checkpoint, available_now=False,
                             processing_time="0 seconds")
        for _ in range(2):
            size = rng.randint(1, 30)
            T.write_topic(frame(spark, rows(size, 5 + first, keys=3)), topic, ["n"], partitions=2)
            first += size
            query.processAllAvailable()
        query.stop()
        T.write_topic(frame(spark, rows(3, 5 + first)), topic, ["n"], partitions=4)  # while none runs; new partitions too
        first += 3
    run(start_stream(T.start_group(spark, topic, checkpoint), sink, checkpoint))
    assert sorted(int(r.value[1:]) for r in spark.read.parquet(sink).collect()) == list(range(5, 5 + first))


def test_a_repeated_batch_is_committed_once(spark, topic):
    copy, checkpoint = scratch_path(spark, "t-copy"), scratch_path(spark, "t-ckpt")
    for k in range(2):
        T.write_topic(frame(spark, rows(20, 20 * k)), topic, ["n"], partitions=2)
        run(T.start_to_topic(T.read_topic_stream(spark, topic, "earliest").select("key", "value"), copy, checkpoint, "w"))
    commits = TopicLog(copy).names()
    _forget_last_batch(checkpoint)
    again = run(T.start_to_topic(T.read_topic_stream(spark, topic, "earliest").select("key", "value"), copy, checkpoint, "w"))
    assert sum(p.numInputRows for p in again.recentProgress) == 20  # the batch did run again
    assert TopicLog(copy).names() == commits
    assert sorted(r[3] for r in read(spark, copy)) == sorted(f"v{i}" for i in range(40))
    segments = {s[3] for c in TopicLog(copy).last_first() for s in c["segments"]}
    assert {p.name for p in Path(copy, "segments").iterdir()} == segments  # and left no files behind


def test_streams_under_two_names(spark, topic):
    copy = scratch_path(spark, "t-copy")
    T.write_topic(frame(spark, rows(8)), topic, ["n"])
    for name in ("one", "two"):
        run(T.start_to_topic(T.read_topic_stream(spark, topic, "earliest").select("key", "value"), copy, scratch_path(spark, "t-ckpt"), name))
    assert len(read(spark, copy)) == 16
    assert TopicLog(copy).batch_of("one") == TopicLog(copy).batch_of("two") == 0 and TopicLog(copy).batch_of("three") == -1


def test_effects_once(spark, topic):
    """A batch that fails in the middle, is run again and, after another death, again."""
    told, checkpoint = scratch_path(spark, "t-told"), scratch_path(spark, "t-ckpt")
    T.write_topic(frame(spark, rows(30)), topic, ["n"], partitions=3)
    stream = T.read_topic_stream(spark, topic, "earliest")
    broken = F.when(F.col("value") == "v29", F.raise_error(F.lit("broken"))).otherwise(F.col("value"))
    query = start_effects(stream.select("key", broken.alias("value")), told, checkpoint)
    with pytest.raises(Exception, match="broken"):
        query.awaitTermination()
    assert list(Path(told).glob("*.json")), "the failed run has left files"
    assert read_effects(spark, told, checkpoint, "value string").collect() == []
    for _ in range(2):
        run(start_effects(stream.select("key", F.lit(None).cast("string").alias("x"), "offset", "value"), told, checkpoint))
        found = read_effects(spark, told, checkpoint, "key string, x string, offset long, value string").collect()
        assert sorted(r.value for r in found) == sorted(f"v{i}" for i in range(30))
        assert {r.x for r in found} == {None} and {r.epoch for r in found} == {0}
        _forget_last_batch(checkpoint)


@pytest.mark.parametrize("cuts", [[], [1], [40, 41, 80]])
def test_totals_do_not_depend_on_the_batches(spark, topic, cuts):
    data = [(f"k{i % 4}", i) for i in range(100)]
    told, checkpoint = scratch_path(spark, "t-told"), scratch_path(spark, "t-ckpt")
    for a, b in zip([0, *cuts], [*cuts, 100]):
        T.write_topic(spark.createDataFrame([(k, str(n), n) for k, n in data[a:b]], "key string, value string, n long"), topic, ["n"])
        parsed = T.read_topic_stream(spark, topic, "earliest").select("key", F.col("value").cast("long").alias("n"))
        run(start_effects(T.key_totals(parsed), told, checkpoint, output_mode="update"))
    found = sorted(tuple(r) for r in T.latest_totals(read_effects(spark, told, checkpoint, "key string, n long, total long")).collect())
    assert found == [(f"k{j}", 25, sum(range(j, 100, 4))) for j in range(4)]


def test_observed_totals_of_several_batches(spark, topic):
    sink, checkpoint = scratch_path(spark, "t-sink"), scratch_path(spark, "t-ckpt")
    T.write_topic(frame(spark, rows(10)), topic, ["n"])
    watched = T.read_topic_stream(spark, topic, "earliest").observe("seen", F.count("value").alias("n"), F.sum("offset").alias("s"))
    query = start_stream(watched, sink, checkpoint, available_now=False, processing_time="0 seconds")
    query.processAllAvailable()
    T.write_topic(frame(spark, rows(7, 10)), topic, ["n"])
    query.processAllAvailable()
    query.stop()
    want = T.read_topic(spark, topic).agg(F.count("value"), F.sum("offset")).first()
    assert observed_totals(query, "seen") == {"n": want[0], "s": want[1]} and want[0] == 17
