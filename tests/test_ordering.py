from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators.ordering import with_row_index
from quarry.session import scratch_path


def test_row_index_contiguous_across_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k")).repartition(7)
    rows = with_row_index(df, ["k"], "idx").collect()
    pairs = sorted((r.idx, r.k) for r in rows)
    assert [p[0] for p in pairs] == list(range(5000))
    assert [p[1] for p in pairs] == sorted(p[1] for p in pairs)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-50, 50), unique=True, max_size=60), st.integers(1, 5))
def test_row_index_is_rank(spark, keys, parts):
    if not keys:
        return
    df = spark.createDataFrame([(k,) for k in keys], "k int").repartition(parts)
    got = {r.k: r.idx for r in with_row_index(df, ["k"], "idx").collect()}
    assert got == {k: i for i, k in enumerate(sorted(keys))}


def test_row_index_splits_a_hot_tied_key(spark):
    df = spark.range(0, 6000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"))
    path = scratch_path(spark, "test-row-index")
    # keep AQE from merging the (tiny) sorted partitions back into one
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = with_row_index(df.repartition(6), ["k"], "idx", path=path)
        rows = out.collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.idx for r in rows) == list(range(6000))
    assert all(r.idx < 4000 for r in rows if r.k == -1)
    stored = spark.read.parquet(path).where(F.col("k") == -1)
    sort_parts = stored.select(F.shiftright("_q_mid", 33).alias("p")).distinct().count()
    assert sort_parts > 1


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 10**6)), max_size=80, unique_by=lambda t: t[1]),
       st.integers(1, 5))
def test_position_in_group_is_rank_within_group(spark, rows, parts):
    from quarry.operators.ordering import position_in_group

    if not rows:
        return
    df = spark.createDataFrame(rows, "g string, v long").repartition(parts)
    got = {(r.g, r.v): r.pos for r in position_in_group(df, "g", ["v"]).collect()}
    exp = {}
    for g in "abc":
        for i, v in enumerate(sorted(v for gg, v in rows if gg == g)):
            exp[(g, v)] = i
    assert got == exp


def test_position_in_group_keeps_null_group(spark):
    from quarry.operators.ordering import position_in_group

    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g string, v long")
    got = sorted((r.g or "", r.v, r.pos) for r in position_in_group(df, "g", ["v"]).collect())
    assert got == [("", 1, 0), ("", 3, 1), ("a", 2, 0)]


def test_row_index_in_current_order(spark):
    df = spark.range(0, 1000, numPartitions=5).select((F.col("id") * 7 % 1000).alias("v"))
    expected = [r.v for r in df.collect()]  # partition by partition
    got = sorted((r.idx, r.v) for r in with_row_index(df, None, "idx").collect())
    assert [i for i, _ in got] == list(range(1000))
    assert [v for _, v in got] == expected
