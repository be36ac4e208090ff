"""Reports over an event view: count, distinct, sum, order, min, max.

Each report is a DataFrame statement over a registered view of
``(product_id, timestamp, amount)``, and ``trade_id`` for the ordered one;
result columns carry the names that Spark derives for them
(``count(1)``, ``sum(amount)`` ...).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_count(events: DataFrame) -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("count(1)"))


def distinct_products(events: DataFrame) -> DataFrame:
    return events.select("product_id").distinct().orderBy("product_id")


def amount_by_product(events: DataFrame) -> DataFrame:
    return events.groupBy("product_id").agg(F.sum("amount")).orderBy("product_id")


def events_ordered(events: DataFrame) -> DataFrame:
    return events.orderBy("timestamp", "trade_id").select("timestamp", "trade_id", "product_id", "amount")


def min_amount_by_product(events: DataFrame) -> DataFrame:
    return events.groupBy("product_id").agg(F.min("amount"))


def max_amount_by_product(events: DataFrame) -> DataFrame:
    return events.groupBy("product_id").agg(F.max("amount"))


REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    f.__name__: f
    for f in (event_count, distinct_products, amount_by_product, events_ordered, min_amount_by_product,
              max_amount_by_product)
}

#: Reports that read ``trade_id``; the others do without numbered lines.
WITH_ID = {"events_ordered"}


#: One statement with the same figures per product, as SQL text over a view.
PRODUCT_SUMMARY = """
SELECT product_id, count(*) AS n, sum(amount) AS total, min(amount) AS least, max(amount) AS most
FROM {view} GROUP BY product_id"""


def product_summary(spark: SparkSession, view: str) -> DataFrame:
    """Run :data:`PRODUCT_SUMMARY` over the registered view ``view``."""
    return spark.sql(PRODUCT_SUMMARY.format(view=view))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Register ``df`` as a session temp view and return it."""
    df.createOrReplaceTempView(name)
    return df


def report(spark: SparkSession, name: str, view: str) -> DataFrame:
    """Run one of :data:`REPORTS` over the registered view ``view``."""
    return REPORTS[name](spark.table(view))
