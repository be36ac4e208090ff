"""Time-use survey job: classify activity columns by prefix, sum them into
hours, code respondents into buckets, and average per group (DataFrame,
SQL, typed and custom-aggregate forms)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quarry.functions.columns import bucket, classify_columns, row_sum
from quarry.operators.aggregate import (
    grouped_averages,
    grouped_averages_custom,
    grouped_averages_sql,
    grouped_averages_typed,
)

# Fixed values of the time-usage job.
# Prefix groups, checked in this order (the first match wins):
#   primary needs: t01 t03 t11 t1801 t1803
#   work:          t05 t1805
#   other:         t02 t04 t06 t07 t08 t09 t10 t12 t13 t14 t15 t16 t18
# working = "working" if 1 <= telfs < 3 else "not working"
# sex     = "male" if tesex == 1 else "female"
# age     = "young" if 15 <= teage <= 22, "active" if 23 <= teage <= 55, else "elder"
# respondents with telfs <= 4 are kept (the others are not in the labour force);
# minutes are turned into hours (60 per hour); averages are rounded to 1 place.
ACTIVITY_GROUPS = (
    ("primaryNeeds", ("t01", "t03", "t11", "t1801", "t1803")),
    ("work", ("t05", "t1805")),
    ("other", ("t02", "t04", "t06", "t07", "t08", "t09", "t10", "t12", "t13", "t14", "t15", "t16", "t18")),
)
MINUTES_PER_HOUR = 60
IN_LABOUR_FORCE_MAX_TELFS = 4
KEYS = ("working", "sex", "age")
VALUES = ("primaryNeeds", "work", "other")

WORKING_RULES = [(lambda x: (x >= 1) & (x < 3), "working")]
SEX_RULES = [(lambda x: x == 1, "male")]
AGE_RULES = [
    (lambda x: (x >= 15) & (x <= 22), "young"),
    (lambda x: (x >= 23) & (x <= 55), "active"),
]

TIME_USAGE_ROW = StructType(
    [
        StructField("working", StringType(), True),
        StructField("sex", StringType(), True),
        StructField("age", StringType(), True),
        StructField("primaryNeeds", DoubleType(), True),
        StructField("work", DoubleType(), True),
        StructField("other", DoubleType(), True),
    ]
)


def classified_columns(names) -> dict[str, list[str]]:
    """Activity columns per group (schema only)."""
    return classify_columns(names, ACTIVITY_GROUPS)


def classified_sums(df: DataFrame, scale: float | None = None, suffix: str = "") -> DataFrame:
    """Row-wise sums of each activity group (``scale`` divides them)."""
    groups = classified_columns(df.columns)
    return df.select(
        df.columns[0],
        *[row_sum(cols, scale).alias(f"{g}{suffix}") for g, cols in groups.items()],
    )


def in_labour_force():
    """The respondents the summary keeps (a predicate on the raw ``telfs``)."""
    return F.col("telfs") <= IN_LABOUR_FORCE_MAX_TELFS


def time_usage_summary(df: DataFrame) -> DataFrame:
    """``working, sex, age, primaryNeeds, work, other`` (hours) for respondents
    in the labour force.  The filter is on a source column and reaches the
    scan; the sums and buckets are plain column expressions (compiled by
    whole-stage codegen when the input has at most Spark's 100-field limit
    of columns, evaluated by the JVM interpreter above it)."""
    groups = classified_columns(df.columns)
    kept = df.where(in_labour_force())
    return kept.select(
        bucket("telfs", WORKING_RULES, "not working").alias("working"),
        bucket("tesex", SEX_RULES, "female").alias("sex"),
        bucket("teage", AGE_RULES, "elder").alias("age"),
        *[row_sum(groups[g], MINUTES_PER_HOUR).alias(g) for g, _ in ACTIVITY_GROUPS],
    )


def time_usage_grouped(summary: DataFrame) -> DataFrame:
    """Averages per group, rounded, sorted; columns ``avg(primaryNeeds)`` ..."""
    return grouped_averages(summary, KEYS, VALUES, digits=1)


def time_usage_grouped_sql(spark: SparkSession, summary: DataFrame, view: str = "summed") -> DataFrame:
    """The same averages through SQL text over a temp view."""
    return grouped_averages_sql(spark, summary, KEYS, VALUES, view=view, digits=1)


def time_usage_grouped_typed(summary: DataFrame) -> DataFrame:
    """The same averages as typed rows: names ``primaryNeeds, work, other``
    kept and the result checked against :data:`TIME_USAGE_ROW`."""
    return grouped_averages_typed(summary.to(TIME_USAGE_ROW), KEYS, VALUES, TIME_USAGE_ROW)


def time_usage_grouped_custom(summary: DataFrame) -> DataFrame:
    """The typed averages through the custom (Arrow partial) aggregate."""
    out = grouped_averages_custom(summary, KEYS, VALUES, digits=1)
    return out.to(TIME_USAGE_ROW)
