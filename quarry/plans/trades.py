"""Trade job: delimited trade lines -> event table -> SQL reports -> saved table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from quarry.operators.delimited import TRADE_EVENT_SCHEMA, parse_delimited_events
from quarry.operators.reports import register_view, report
from quarry.operators.tables import save_table
from quarry.session import unique_name


def trade_events(
    lines: DataFrame, line_col: str = "line", order_by: str = "line_no", with_id: bool = True
) -> DataFrame:
    """Parsed events ``trade_id, product_id, timestamp, amount`` (declared
    schema); without ids nothing is sorted or written."""
    events = parse_delimited_events(lines, line_col, order_by, with_id=with_id)
    return events.to(StructType([f for f in TRADE_EVENT_SCHEMA.fields if with_id or f.name != "trade_id"]))


def trade_report(spark: SparkSession, events: DataFrame, name: str, view: str | None = None) -> DataFrame:
    """Register the events under a view and run one report over it."""
    view = view or unique_name("trade_events")
    register_view(events, view)
    return report(spark, name, view)


def save_events_table(events: DataFrame, name: str | None = None) -> DataFrame:
    """CREATE TABLE ... AS SELECT * FROM events; fails if the table exists."""
    return save_table(events, name or unique_name("events_saved"))
