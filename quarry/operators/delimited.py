"""Delimited text lines -> typed event table (split, index, explode, cast)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, LongType, StringType, StructField, StructType

from quarry.functions.text import jvm_trim, split_literal
from quarry.operators.ordering import with_row_index

# Fixed values of the trade job: events are cut by "|", fields by ",".
EVENT_DELIMITER = "|"
FIELD_DELIMITER = ","

# Column names and types of the parsed events.  Fields are declared
# nullable for ``DataFrame.to``; a missing field fails the parse instead.
TRADE_EVENT_SCHEMA = StructType(
    [
        StructField("trade_id", LongType(), True),
        StructField("product_id", StringType(), True),
        StructField("timestamp", StringType(), True),
        StructField("amount", FloatType(), True),
    ]
)


def parse_delimited_events(
    lines: DataFrame,
    line_col: str,
    order_by: str,
    event_delimiter: str = EVENT_DELIMITER,
    field_delimiter: str = FIELD_DELIMITER,
    with_position: bool = False,
    with_id: bool = True,
    strict: bool = True,
) -> DataFrame:
    """Turn lines of delimited events into one typed row per event.

    Each line gets a contiguous 0-based ``trade_id`` in ``order_by`` order;
    ``with_id=False`` leaves the id out, and with it the sort and the write
    that number the lines.  The trimmed line is cut into events, each trimmed event into fields
    ``(product_id, timestamp, amount)``.  The timestamp stays text.  A
    missing field or a bad amount fails the job (ANSI array index and cast),
    as the typed conversion would; with ``strict=False`` such an event keeps
    what can be read, and ``reject`` holds its text (null for good events).
    ``with_position`` adds ``event_pos``,
    the 0-based place of the event on its line.
    """
    ids = ["trade_id"] if with_id else []
    if with_id:
        lines = with_row_index(lines.select(line_col, order_by), [order_by], "trade_id", unique=True)
    events = lines.select(
        *ids,
        F.posexplode(split_literal(jvm_trim(line_col), event_delimiter)).alias("event_pos", "event"),
    )
    fields = events.select(
        *ids, "event_pos", "event",
        split_literal(jvm_trim("event"), field_delimiter).alias("f"),
    )
    f = F.col("f")
    out = fields.select(
        *[F.col("trade_id").cast("long").alias("trade_id")] * with_id,
        *["event_pos"] * with_position,
        *([f[0].alias("product_id"), f[1].alias("timestamp"), f[2].cast("float").alias("amount")] if strict else
          [F.get(f, 0).alias("product_id"), F.get(f, 1).alias("timestamp"), F.get(f, 2).try_cast("float").alias("amount"),
           F.when(F.get(f, 2).try_cast("float").isNull(), F.col("event")).alias("reject")]),
    )
    return out
