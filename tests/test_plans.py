"""Physical-plan properties of the registered queries (the scale design)."""

import pytest

from quarry.operators.keyed import lookup_with_default
from quarry.plans.registry import QUERIES
from quarry.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(q(spark, SF)) for name, q in QUERIES.items()}


def test_no_row_at_a_time_python(plans):
    for name, p in plans.items():
        assert "BatchEvalPython" not in p, name
        assert "ArrowEvalPython" not in p, name
        if name not in ("time_usage_grouped_custom", "sum_by_key_gathered"):
            assert "MapInPandas" not in p and "MapInArrow" not in p and "PythonUDF" not in p, name
    assert "MapInArrow" in plans["time_usage_grouped_custom"] and "MapInArrow" in plans["sum_by_key_gathered"]


def test_survey_filter_and_pruning_reach_the_scan(plans):
    p = plans["time_usage_summary"]
    assert "LessThanOrEqual(l_linenumber,4)" in p
    read_schema = p.split("ReadSchema: ")[1].split("\n")[0]
    assert "l_extendedprice" not in read_schema and "l_returnflag" not in read_schema


@pytest.mark.parametrize("name", [
    "time_usage_grouped", "person_accounts", "sum_by_key_combined", "char_distribution",
    "amount_by_type", "has_account_semi", "lookup_penalty", "running_metrics",
])
def test_aggregates_are_partial_before_the_shuffle(plans, name):
    p = plans[name]
    assert "partial_" in p or "HashAggregate(keys=[person_id" in p or "HashAggregate(keys=[i" in p, name
    # the first aggregate below each exchange is a partial one
    assert p.count("HashAggregate") >= 2, name


def test_semi_join_side_is_deduplicated_before_shuffle(plans):
    p = plans["has_account_semi"]
    assert "LeftSemi" in p
    assert p.count("HashAggregate(keys=[person_id") >= 2


def test_char_explode_and_partial_count_share_a_stage(plans):
    p = plans["char_distribution"]
    assert "Generate explode" in p and "partial_count" in p


def test_lookup_join_follows_the_size_threshold(spark):
    li = read_table(spark, SF, "lineitem").selectExpr("CAST(l_quantity AS INT) AS i")
    nation = read_table(spark, SF, "nation")
    small = plan(lookup_with_default(li, "i", nation, "n_nationkey", "n_regionkey"))
    assert "BroadcastHashJoin" in small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = plan(lookup_with_default(li, "i", nation, "n_nationkey", "n_regionkey"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in big and "SortMergeJoin" in big


def test_penalty_joins_distinct_keys_only(plans):
    p = plans["lookup_penalty"]
    join_at = p.index("Join")
    # the lineitem side is aggregated per key below the join
    assert "HashAggregate(keys=[i" in p[join_at:]


def test_csv_survey_filter_pushed_and_columns_pruned(plans, spark):
    from quarry.sources.csv import read_headed_csv

    assert "LessThanOrEqual(telfs,4.0)" in plans["time_usage_csv_grouped"]
    _, df = read_headed_csv(spark, str(__import__("pathlib").Path(__file__).parent / "fixtures" / "survey_sample.csv"))
    p = plan(df.select("tucaseid", "teage"))
    assert "ReadSchema: struct<tucaseid:string,teage:double>" in p


def test_no_sort_based_aggregation(plans):
    for name, p in plans.items():
        assert "SortAggregate" not in p, name


def test_bucketed_join_has_no_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(QUERIES["bucketed_person_accounts"](spark, SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in p and "Exchange" not in p
    assert p.count("Bucketed: true") == 2


def test_total_characters_make_no_rows(plans):
    assert "Generate" not in plans["char_totals"] and "partial_sum" in plans["char_totals"]


def test_topic_reads_are_arrow_batches(plans):
    assert "BatchScan" in plans["topic_messages"] and "BatchScan" in plans["topic_offset_range"]
