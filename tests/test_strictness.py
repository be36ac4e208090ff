"""Bad input is found or kept apart, at every size and in every file."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators.aggregate import grouped_averages, grouped_averages_custom
from quarry.operators.delimited import parse_delimited_events
from quarry.operators.partitioning import spread
from quarry.plans import jobs
from quarry.plans import time_usage as TU
from quarry.session import scratch_path
from quarry.sources.csv import read_headed_csv, read_lines
from quarry.sources.kafka import kafka_sink_options
from quarry.sources.records import parse_accounts, parse_persons
from quarry.sources.tables import read_table
from quarry.streaming.messages import MESSAGE_SCHEMA, format_messages, parse_messages, start_stream


def folder(tmp_path, *files):
    for k, text in enumerate(files):
        (tmp_path / f"{k}.csv").write_text(text)
    return str(tmp_path)


HEAD = "tucaseid,telfs,teage\n"


def read(spark, path, **options):
    return read_headed_csv(spark, path, where=TU.in_labour_force(), where_cols=["telfs"], **options)[1]


@pytest.mark.parametrize("check_dropped", [False, True])
def test_an_empty_filter_column_fails(spark, tmp_path, check_dropped):
    path = folder(tmp_path, HEAD + "a,1,20\nb,,30\nc,5,40\n")
    with pytest.raises(Exception, match="null in non-null column telfs"):
        read(spark, path, check_dropped=check_dropped).collect()


def test_a_bad_number_in_a_dropped_row(spark, tmp_path):
    path = folder(tmp_path, HEAD + "a,1,20\nc,5,x\n")
    assert [r.tucaseid for r in read(spark, path).collect()] == ["a"]
    with pytest.raises(Exception, match="(?i)malformed|cannot"):
        read(spark, path, check_dropped=True).collect()


def test_files_with_different_headers_fail(spark, tmp_path):
    path = folder(tmp_path, HEAD + "a,1,20\n", "tucaseid,teage,telfs\nb,30,2\n")
    with pytest.raises(Exception):
        read(spark, path).collect()
    with pytest.raises(Exception):
        read(spark, path).select("teage").collect()


def test_mark_at_a_file_start_is_dropped_and_no_other(spark, tmp_path):
    (tmp_path / "a.txt").write_text("\ufeffx\n\ufeffy\n", encoding="utf-8")
    assert [r.value for r in read_lines(spark, str(tmp_path)).collect()] == ["x", "\ufeffy"]


def test_a_rewritten_table_is_read_anew(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(3).toDF("a").write.parquet(path)
    assert read_table(spark, str(tmp_path), "t").columns == ["a"]
    spark.range(2).toDF("b").write.mode("overwrite").parquet(path)
    assert sorted(r.b for r in read_table(spark, str(tmp_path), "t").collect()) == [0, 1]


def test_spread_runs_nothing_on_a_shuffled_frame(spark):
    context = spark.sparkContext
    shuffled = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    context.setJobGroup("spread", "x")
    out = spread(shuffled, 64)
    assert list(context.statusTracker().getJobIdsForGroup("spread")) == []
    context.setLocalProperty("spark.jobGroup.id", None)
    assert out is shuffled
    assert spread(spark.range(0, 10, 1, 1), 4).rdd.getNumPartitions() == 4


NUMBERS = st.one_of(st.none(), st.just(float("nan")), st.floats(-1e6, 1e6).map(lambda x: round(x, 3)))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), NUMBERS, NUMBERS), min_size=1, max_size=25))
def test_custom_average_equals_avg(spark, rows):
    df = spark.createDataFrame(rows, "k string, x double, y double")
    custom = grouped_averages_custom(df, ["k"], ["x", "y"]).collect()
    built_in = grouped_averages(df, ["k"], ["x", "y"], name_format="{}").collect()

    def plain(rs):
        return [tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rs]

    for a, b in zip(plain(custom), plain(built_in), strict=True):
        assert a[0] == b[0]
        assert all(x == y or x not in ("nan", None) and y not in ("nan", None) and abs(x - y) <= 0.11 for x, y in zip(a[1:], b[1:]))


PARTS = st.tuples(st.none() | st.integers(0, 2**50), st.none() | st.integers(-5, 5), st.none() | st.text("0123.,ab", max_size=6))


@settings(max_examples=15, deadline=None)
@given(PARTS)
def test_messages_come_back_or_fail(spark, row):
    df = spark.createDataFrame([row], "millis long, n long, ip string")
    if None in row or "," in row[2]:
        with pytest.raises(Exception, match="bad message part"):
            format_messages(df, "millis", "n", "ip").collect()
    else:
        got = parse_messages(format_messages(df, "millis", "n", "ip")).first()
        assert (got.millis, got.n, got.ip) == row


def test_bad_messages_are_kept_apart(spark):
    values = ["1,2,h,i", "1,2,h", "1,2,h,i,j", "x,2,h,i", "", None]
    df = spark.createDataFrame([("k", v) for v in values], MESSAGE_SCHEMA)
    with pytest.raises(Exception, match="bad message"):
        parse_messages(df).collect()
    got = parse_messages(df, strict=False).collect()
    assert [r.reject for r in got] == [None, "1,2,h", "1,2,h,i,j", "x,2,h,i", "", ""]
    assert [r.n for r in got] == [2, None, None, None, None, None]


def test_lenient_records(spark):
    lines = spark.createDataFrame([("1, a ,30,5",), ("2,b,x,5",), ("3,c",), ("",), (None,)], "value string")
    got = parse_persons(lines, strict=False).collect()
    assert [tuple(r) for r in got] == [("1", "a", 30, 5, None), ("2", "b", None, 5, "2,b,x,5"), ("3", "c", None, None, "3,c"),
                                       ("", None, None, None, ""), (None, None, None, None, "")]
    accounts = spark.createDataFrame([("1,p,SAVINGS,5",), ("2,p,GIFT,5",), ("z,p,CREDIT,",)], "value string")
    assert [r.reject for r in parse_accounts(accounts, strict=False).collect()] == [None, "2,p,GIFT,5", "z,p,CREDIT,"]
    events = spark.createDataFrame([(0, "A,t,1.5| B,t| C,t,x")], "line_no long, line string")
    got = parse_delimited_events(events, "line", "line_no", with_id=False, strict=False).collect()
    assert [(r.product_id, r.amount, r.reject) for r in got] == [("A", 1.5, None), ("B", None, " B,t"), ("C", None, " C,t,x")]


def test_any_stream_runs_into_any_sink(spark, tmp_path):
    source = str(tmp_path / "in")
    spark.createDataFrame([("i", "1,2,h,i")], MESSAGE_SCHEMA).write.parquet(source)
    stream = parse_messages(spark.readStream.schema(MESSAGE_SCHEMA).parquet(source)).withColumn("twice", F.col("n") * 2)
    query = start_stream(stream, None, str(tmp_path / "check"), sink_format="memory", query_name="any_stream")
    query.awaitTermination()
    assert spark.table("any_stream").first().twice == 4
    assert kafka_sink_options("b:1", "t") == {"kafka.bootstrap.servers": "b:1", "topic": "t"}


def test_reports_without_ids_neither_sort_nor_write(spark):
    from quarry.plans.registry import QUERIES

    plan = QUERIES["amount_by_type"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "_q_" not in plan and "Join" not in plan


def test_a_job_releases_what_it_made(spark, tmp_path):
    import os

    lines = spark.createDataFrame([(0, "A,t,1.5|B,t,2.5")], "line_no long, line string")
    result = jobs.trade_job(spark, lines)
    assert result.outputs["event_count"].first()[0] == 2
    kept = scratch_path(spark, "test-later")
    spark.range(1).write.parquet(kept)
    views = [t.name for t in spark.catalog.listTables() if t.isTemporary]
    result.release()
    assert not os.path.exists(kept)
    assert set(views) - {t.name for t in spark.catalog.listTables() if t.isTemporary} == set(result.views)
