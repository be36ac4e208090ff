import pytest
from pyspark.sql import functions as F

from quarry.plans import time_usage as TU

# A small survey: id, codes and minutes in every prefix group, including the
# overlapping t18 prefixes and an unmatched t50 column.
COLS = ["tucaseid", "teage", "telfs", "tesex", "t010101", "t180101", "t050101",
        "t180501", "t020101", "t180201", "t500101"]
ROWS = [
    ("1", 20.0, 1.0, 1.0, 600.0, 60.0, 0.0, 0.0, 120.0, 60.0, 999.0),
    ("2", 30.0, 2.0, 2.0, 480.0, 0.0, 480.0, 60.0, 60.0, 0.0, 999.0),
    ("3", 60.0, 4.0, 2.0, 540.0, 30.0, 0.0, 0.0, 300.0, 30.0, 999.0),
    ("4", 30.0, 2.0, 2.0, 420.0, 60.0, 420.0, 0.0, 120.0, 0.0, 999.0),
    ("5", 40.0, 5.0, 1.0, 700.0, 0.0, 0.0, 0.0, 500.0, 0.0, 999.0),  # telfs 5: dropped
    ("6", 14.0, 3.0, 1.0, 720.0, 0.0, 0.0, 0.0, 360.0, 0.0, 999.0),
]


@pytest.fixture()
def survey(spark):
    schema = ", ".join(f"{c} {'string' if c == 'tucaseid' else 'double'}" for c in COLS)
    return spark.createDataFrame(ROWS, schema)


def test_summary(survey):
    got = sorted(tuple(r) for r in TU.time_usage_summary(survey).collect())
    assert got == sorted([
        ("working", "male", "young", 11.0, 0.0, 3.0),
        ("working", "female", "active", 8.0, 9.0, 1.0),
        ("not working", "female", "elder", 9.5, 0.0, 5.5),
        ("working", "female", "active", 8.0, 7.0, 2.0),
        ("not working", "male", "elder", 12.0, 0.0, 6.0),
    ])


def test_filter_reaches_scan(spark, survey, tmp_path):
    path = str(tmp_path / "s")
    survey.write.parquet(path)
    plan = TU.time_usage_summary(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(telfs,4.0)" in plan
    assert "t500101" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_empty_group_sums_to_zero(spark, survey):
    no_work = survey.drop("t050101", "t180501")
    got = [r.work for r in TU.time_usage_summary(no_work).collect()]
    assert got == [0.0] * 5


def test_grouped_forms_agree(spark, survey):
    s = TU.time_usage_summary(survey)
    df_form = TU.time_usage_grouped(s)
    assert df_form.columns == ["working", "sex", "age", "avg(primaryNeeds)", "avg(work)", "avg(other)"]
    rows = [tuple(r) for r in df_form.collect()]
    assert rows == [
        ("not working", "female", "elder", 9.5, 0.0, 5.5),
        ("not working", "male", "elder", 12.0, 0.0, 6.0),
        ("working", "female", "active", 8.0, 8.0, 1.5),
        ("working", "male", "young", 11.0, 0.0, 3.0),
    ]
    sql_form = TU.time_usage_grouped_sql(spark, s, view="summed_test")
    typed = TU.time_usage_grouped_typed(s)
    custom = TU.time_usage_grouped_custom(s)
    assert [tuple(r) for r in sql_form.collect()] == rows
    assert typed.columns == ["working", "sex", "age", "primaryNeeds", "work", "other"]
    assert [tuple(r) for r in typed.collect()] == rows
    assert [tuple(r) for r in custom.collect()] == rows
    assert typed.schema == TU.TIME_USAGE_ROW


def test_custom_aggregate_skips_nulls(spark):
    df = spark.createDataFrame(
        [("a", 1.0), ("a", None), ("a", 3.0), ("b", None)], "k string, v double"
    )
    from quarry.operators.aggregate import grouped_averages, grouped_averages_custom

    builtin = [tuple(r) for r in grouped_averages(df, ["k"], ["v"], name_format="{}").collect()]
    custom = [tuple(r) for r in grouped_averages_custom(df, ["k"], ["v"]).collect()]
    assert builtin == custom == [("a", 2.0), ("b", None)]


def test_rounding_is_one_place(spark):
    df = spark.createDataFrame([("k", 1.0), ("k", 1.26)], "g string, v double")
    from quarry.operators.aggregate import grouped_averages

    assert grouped_averages(df, ["g"], ["v"]).first()["avg(v)"] == 1.1
    assert F is not None
