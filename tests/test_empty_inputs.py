"""Operators on empty inputs return empty (or zero) results, not errors."""

from quarry.operators import accounts as A
from quarry.operators.keyed import (
    char_distribution,
    char_totals,
    lookup_penalty,
    lookup_with_default,
    running_metrics,
    sum_by_key_gathered,
)
from quarry.operators.ordering import position_in_group, with_row_index
from quarry.plans import time_usage as TU
from quarry.plans.trades import trade_events


def test_row_index_and_positions_on_empty(spark):
    df = spark.createDataFrame([], "k long, g string")
    assert with_row_index(df, ["k"], "idx").count() == 0
    assert position_in_group(df, "g", ["k"]).count() == 0


def test_trade_events_on_empty(spark):
    lines = spark.createDataFrame([], "line_no long, line string")
    assert trade_events(lines).count() == 0


def test_accounts_on_empty(spark):
    persons = spark.createDataFrame([], "id string, name string, age int, earnings int")
    accounts = spark.createDataFrame([], "id long, person_id string, type string, balance int")
    assert A.person_accounts(persons, accounts).count() == 0
    assert A.account_positions(accounts).count() == 0
    assert A.accounts_by_person(accounts).count() == 0


def test_keyed_on_empty(spark):
    texts = spark.createDataFrame([], "text string")
    assert char_distribution(texts, "text").count() == 0
    t = char_totals(texts, "text").first()
    assert t.total_chars == 0 and t.total_chars_ones == 0
    pairs = spark.createDataFrame([], "key string, value int")
    assert sum_by_key_gathered(pairs, "key", "value").count() == 0
    values = spark.createDataFrame([(1,)], "i int")
    empty_map = spark.createDataFrame([], "k int, v int")
    assert [tuple(r) for r in lookup_with_default(values, "i", empty_map, "k", "v").collect()] == [(1, 0)]
    assert lookup_penalty(values, "i", empty_map, "k", "v").count() == 0
    m = running_metrics(spark.createDataFrame([], "v int"), "v").first()
    assert (m.n, m.total, m.mean) == (0, None, None)


def test_survey_on_empty(spark):
    df = spark.createDataFrame([], "tucaseid string, teage double, telfs double, tesex double, t010101 double")
    assert TU.time_usage_grouped(TU.time_usage_summary(df)).count() == 0
