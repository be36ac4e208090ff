from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators.keyed import (
    char_distribution,
    char_occurrence_counts,
    char_occurrence_lists,
    char_totals,
    lookup_penalty,
    lookup_with_default,
    running_metrics,
    sum_by_key,
    sum_by_key_gathered,
    write_with_metrics,
)
from quarry.operators.ordering import top_k_by_key
from quarry.session import scratch_path

PAIRS = [(chr(48 + (i * 7) % 77), (i * 5) % 11) for i in range(100)]


def test_sum_by_key_equals_gathered_sum(spark):
    df = spark.createDataFrame(PAIRS, "key string, value int")
    combined = {r.key: r.total for r in sum_by_key(df, "key", "value").collect()}
    gathered = {
        r.key: r.s
        for r in df.groupBy("key").agg(
            F.aggregate(F.collect_list("value"), F.lit(0).cast("long"), lambda a, x: a + x).alias("s")
        ).collect()
    }
    expected = Counter()
    for k, v in PAIRS:
        expected[k] += v
    assert combined == gathered == dict(expected)
    split_lists = {r.key: r.total for r in sum_by_key_gathered(df.repartition(5), "key", "value").collect()}
    assert split_lists == dict(expected)
    small_blocks = {r.key: r.total for r in sum_by_key_gathered(df.repartition(3), "key", "value", block=7).collect()}
    assert small_blocks == dict(expected)
    halves = df.selectExpr("key", "value / 2 AS value")
    doubles = {r.key: r.total for r in sum_by_key_gathered(halves, "key", "value").collect()}
    assert doubles == {k: v / 2 for k, v in expected.items()}
    top = [tuple(r) for r in top_k_by_key(sum_by_key(df, "key", "value"), "key", 10).collect()]
    assert top == sorted(expected.items())[:10]


def test_char_distribution_and_totals(spark):
    texts = ["hello, world", "", None, "aé\U0001D11E\n"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.ch: r.n for r in char_distribution(df, "text").collect()}
    expected = Counter("".join(t for t in texts if t))
    assert got == dict(expected)
    with_ids = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    lists = char_occurrence_lists(with_ids, "text", "doc_id").collect()
    assert all(set(r.ones) == {1} and len(r.ones) == texts[r.doc_id].count(r.ch) for r in lists)
    assert {r.ch: r.n for r in char_occurrence_counts(char_occurrence_lists(with_ids, "text", "doc_id")).collect()} \
        == dict(expected)
    tot = char_totals(df, "text").first()
    assert tot.total_chars == tot.total_chars_ones == sum(expected.values())


def test_lookup_with_default(spark):
    df = spark.createDataFrame([(i,) for i in [0, 1, 2, 11, 12, 3, 3]], "i int")
    lookup = spark.createDataFrame([(k, (k * 7) % 11) for k in range(12)], "k int, v int")
    got = sorted(tuple(r) for r in lookup_with_default(df, "i", lookup, "k", "v", 0, "m").collect())
    assert got == sorted((i, (i * 7) % 11 if i < 12 else 0) for i in [0, 1, 2, 11, 12, 3, 3])
    dup = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    import pytest

    for hint in (None, "broadcast", "merge"):  # the same error and the same rows by any join
        with pytest.raises(Exception, match="not unique"):
            lookup_with_default(df, "i", dup, "k", "v", join_hint=hint).collect()
        again = lookup_with_default(df, "i", lookup, "k", "v", 0, "m", join_hint=hint)
        assert sorted(tuple(r) for r in again.collect()) == got
    nulls = spark.createDataFrame([(None, 2), (None, 3), (1, 9)], "k int, v int")
    assert dict(tuple(r) for r in lookup_with_default(df.distinct(), "i", nulls, "k", "v").collect())[1] == 9


def test_lookup_penalty_is_long_arithmetic(spark):
    df = spark.createDataFrame([(100_000,), (100_000,)], "i int")
    lookup = spark.createDataFrame([(100_000, 200_000)], "k int, v int")
    assert lookup_penalty(df, "i", lookup, "k", "v").first().total == 2 * -100_000 * 200_000


def test_lookup_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lookup-build", "x")
    df = spark.range(10).selectExpr("cast(id as int) i")
    lookup_penalty(df, "i", df.selectExpr("i k", "i v"), "k", "v")
    assert list(tracker.getJobIdsForGroup("lookup-build")) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 14), min_size=1, max_size=40),
       st.dictionaries(st.integers(0, 11), st.integers(0, 10), min_size=1))
def test_lookup_penalty_brute_force(spark, values, mapping):
    df = spark.createDataFrame([(v,) for v in values], "i int")
    lookup = spark.createDataFrame(list(mapping.items()), "k int, v int")
    got = {r.i: r.total for r in lookup_penalty(df, "i", lookup, "k", "v").collect()}
    expected = Counter()
    for i in values:
        m = mapping.get(i, 0)
        if i > 2 and (i - m) * m < 0:
            expected[i] += (i - m) * m
    assert got == dict(expected)


def test_running_metrics_and_observed_write(spark):
    df = spark.createDataFrame([(v % 11,) for v in range(1000)], "v int")
    r = running_metrics(df, "v").first()
    expected_sum = sum(v % 11 for v in range(1000))
    assert (r.n, r.total, r.mean) == (1000, expected_sum, expected_sum / 1000)
    m = write_with_metrics(df, "v", scratch_path(spark, "test-observe"))
    assert (m["n"], m["total"], m["mean"]) == (1000, expected_sum, expected_sum / 1000)
