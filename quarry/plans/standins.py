"""Stand-in inputs built from the test tables.

Each function only reshapes a given table into rows of the schema a job
expects (survey respondents, trade lines, persons, accounts, key/value
pairs, messages).  None of them does the job's work, and the jobs rely on
nothing about how these rows are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# Fixed value of the message producer: addresses are this prefix plus a number.
MESSAGE_IP_PREFIX = "192.168.2."
TS_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def survey_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Time-use survey rows: one respondent per line item.

    ``tucaseid`` text; ``teage``, ``telfs``, ``tesex`` codes; activity
    columns in whole minutes whose names fall in every prefix group,
    including overlapping ``t18..`` prefixes and an unmatched ``t50..``.
    """
    d = lambda c: F.col(c).cast("double")
    return lineitem.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("tucaseid"),
        d("l_quantity").alias("teage"),
        d("l_linenumber").alias("telfs"),
        (F.col("l_suppkey") % 2 + 1).cast("double").alias("tesex"),
        (F.col("l_quantity") * 10).alias("t010101"),
        (F.col("l_linenumber") * 15).cast("double").alias("t030101"),
        (F.col("l_suppkey") % 60).cast("double").alias("t180101"),
        (F.col("l_partkey") % 480).cast("double").alias("t050101"),
        (F.col("l_orderkey") % 90).cast("double").alias("t180501"),
        (F.col("l_orderkey") % 120).cast("double").alias("t020101"),
        (F.dayofmonth("l_shipdate") * 10).cast("double").alias("t120101"),
        (F.col("l_partkey") % 30).cast("double").alias("t180201"),
        d("l_linenumber").alias("t500101"),
    )


def trade_lines_from_events(events: DataFrame, events_per_line: int = 4) -> DataFrame:
    """Trade lines ``line_no, line``: each line holds the events of one block
    of ``events_per_line`` consecutive event ids, as
    ``type,time text,value`` joined by ``"| "`` (bounded line length)."""
    text = F.concat_ws(
        ",", F.col("event_type"), F.date_format("ts", TS_TEXT_FORMAT), F.col("value").cast("string")
    )
    per_event = events.select(
        F.expr(f"event_id div {int(events_per_line)}").alias("line_no"),
        F.struct(F.col("event_id"), text.alias("text")).alias("e"),
    )
    return per_event.groupBy("line_no").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list("e")), lambda x: x["text"]), "| "
        ).alias("line")
    )


def persons_from_customer(customer: DataFrame) -> DataFrame:
    """Persons ``id, name, age, earnings`` (ages 18..59)."""
    return customer.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_name").alias("name"),
        (F.lit(18) + F.col("c_custkey") % 42).cast("int").alias("age"),
        (F.floor("c_acctbal") * 15).cast("int").alias("earnings"),
    )


ACCOUNT_TYPE_OF_PRIORITY = {
    "1-URGENT": "SAVINGS",
    "2-HIGH": "CHEQUING",
    "3-MEDIUM": "CREDIT",
    "4-NOT SPECIFIED": "BROKER",
    "5-LOW": "CHEQUING",
}


def accounts_from_orders(orders: DataFrame) -> DataFrame:
    """Accounts ``id, person_id, type, balance``; credit balances are <= 0."""
    typ = F.col("o_orderpriority")
    mapped = None
    for prio, t in ACCOUNT_TYPE_OF_PRIORITY.items():
        mapped = (F.when(typ == prio, F.lit(t)) if mapped is None else mapped.when(typ == prio, F.lit(t)))
    amount = F.floor(F.col("o_totalprice") / 5).cast("int")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").cast("string").alias("person_id"),
        mapped.alias("type"),
        F.col("o_orderpriority").alias("_prio"),
        amount.alias("_amount"),
    ).select(
        "id", "person_id", "type",
        F.when(F.col("type") == "CREDIT", -F.col("_amount")).otherwise(F.col("_amount")).alias("balance"),
    )


def person_lines(customer: DataFrame) -> DataFrame:
    """Headless person lines with padded id and name: ``"<id>  , <name> ,age,earnings"``."""
    p = persons_from_customer(customer)
    return p.select(
        F.concat(
            F.col("id"), F.lit("  ,"), F.lit(" "), F.col("name"), F.lit("\t,"),
            F.col("age").cast("string"), F.lit(","), F.col("earnings").cast("string"),
        ).alias("value")
    )


def account_lines(orders: DataFrame) -> DataFrame:
    """Headless account lines with blanks around fields: ``" id, person ,TYPE ,balance"``."""
    a = accounts_from_orders(orders)
    return a.select(
        F.concat(
            F.lit(" "), F.col("id").cast("string"), F.lit(","), F.col("person_id"), F.lit(" ,"),
            F.col("type"), F.lit(" ,"), F.col("balance").cast("string"),
        ).alias("value")
    )


def person_lines_some_bad(customer: DataFrame) -> DataFrame:
    """Person lines of which every eleventh lacks its last field and every
    thirteenth has words for an age."""
    p = persons_from_customer(customer)
    k = p["id"].cast("long")
    age = F.when(k % 13 == 0, F.lit("old")).otherwise(F.col("age").cast("string"))
    line = F.concat(F.col("id"), F.lit(" ,"), F.col("name"), F.lit(","), age)
    return p.select(F.when(k % 11 == 0, line).otherwise(F.concat(line, F.lit(","), F.col("earnings").cast("string"))).alias("value"))


def account_lines_some_bad(orders: DataFrame) -> DataFrame:
    """Account lines of which every eleventh has a type that is none."""
    a = accounts_from_orders(orders)
    kind = F.when(F.col("id") % 11 == 0, F.lit("GIFT")).otherwise(F.col("type"))
    return a.select(F.concat_ws(",", F.col("id").cast("string"), "person_id", kind, F.col("balance").cast("string")).alias("value"))


def trial_from_part(part: DataFrame) -> DataFrame:
    """Rows ``place, placename, amount``."""
    return part.select(
        F.col("p_partkey").alias("place"), F.col("p_name").alias("placename"),
        F.col("p_size").alias("amount"),
    )


def pairs_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Key/value pairs ``key, value``."""
    return lineitem.select(F.col("l_suppkey").alias("key"), F.col("l_linenumber").alias("value"))


def epoch_millis(ts: str) -> F.Column:
    """Milliseconds since 1970 of a TIMESTAMP_NTZ column, floored; no time zone involved."""
    return F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, {ts}) div 1000")


def message_rows_from_events(events: DataFrame) -> DataFrame:
    """Message parts ``millis, n, ip``: event time, event id, an address per user."""
    return events.select(
        epoch_millis("ts").alias("millis"),
        F.col("event_id").alias("n"),
        F.concat(F.lit(MESSAGE_IP_PREFIX), (F.col("user_id") % 255).cast("string")).alias("ip"),
    )
