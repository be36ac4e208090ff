"""Registered queries: ``name -> fn(spark, data_dir) -> DataFrame``.

Every query reads the given tables (or a stand-in Spark derives from them),
so its work grows with the data.  Names follow SURVEY section 7.4.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.columns import bucket, row_sum
from quarry.operators import accounts as A
from quarry.operators.keyed import (
    char_distribution,
    char_occurrence_counts,
    char_occurrence_lists,
    char_totals,
    lookup_penalty,
    lookup_with_default,
    running_metrics,
    sum_by_key,
    sum_by_key_gathered,
)
from quarry.operators.ordering import top_k_by_key, with_row_index
from quarry.operators.reports import WITH_ID, product_summary, register_view
from quarry.operators.tables import save_bucketed_table
from quarry.plans import person_accounts as P
from quarry.plans import standins as S
from quarry.plans import time_usage as TU
from quarry.plans.jobs import SMALL_AMOUNT_LIMIT, person_accounts_job
from quarry.plans.topics import TOPIC_QUERIES
from quarry.plans.trades import save_events_table, trade_events, trade_report
from quarry.session import scratch_path, unique_name
from quarry.sources.csv import read_headed_csv, read_lines
from quarry.sources.records import parse_accounts, parse_persons
from quarry.sources.tables import read_table
from quarry.streaming.messages import (
    PARSED_MESSAGE_SCHEMA,
    format_messages,
    parse_messages,
    start_message_stream,
)

Query = Callable[[SparkSession, str], DataFrame]


# ------------------------------------------------------------------ time usage
def _summary(spark: SparkSession, d: str) -> DataFrame:
    return TU.time_usage_summary(S.survey_from_lineitem(read_table(spark, d, "lineitem")))


def time_usage_summary(spark, d):
    return _summary(spark, d)


def time_usage_grouped(spark, d):
    return TU.time_usage_grouped(_summary(spark, d))


def time_usage_grouped_sql(spark, d):
    return TU.time_usage_grouped_sql(spark, _summary(spark, d), view=unique_name("summed"))


def time_usage_grouped_typed(spark, d):
    return TU.time_usage_grouped_typed(_summary(spark, d))


def time_usage_grouped_custom(spark, d):
    return TU.time_usage_grouped_custom(_summary(spark, d))


def time_usage_csv_grouped(spark, d):
    """The whole survey job from text: the survey is written as a headed CSV,
    read back with the schema built from its header (the labour-force filter
    pushed into the CSV scan), summarised and averaged."""
    path = scratch_path(spark, "csv-survey")
    S.survey_from_lineitem(read_table(spark, d, "lineitem")).write.option("header", True).csv(path)
    _, survey = read_headed_csv(spark, path, where=TU.in_labour_force(), where_cols=["telfs"])
    return TU.time_usage_grouped(TU.time_usage_summary(survey))


def prefix_classified_sums(spark, d):
    return TU.classified_sums(S.survey_from_lineitem(read_table(spark, d, "lineitem")), suffix="_min")


# ----------------------------------------------------------------------- trial


def bucket_size(spark, d):
    t = S.trial_from_part(read_table(spark, d, "part"))
    return t.select(
        (F.col("place") + F.col("amount")).alias("place_plus_amount"),
        bucket("amount", [(lambda x: x < SMALL_AMOUNT_LIMIT, "small")], "big").alias("size"),
    )


def named_column_sum(spark, d):
    t = S.trial_from_part(read_table(spark, d, "part")).select("place", "amount")
    return t.select(
        "place", "amount",
        row_sum(["place", "amount"]).alias("sum_by_name"),
        row_sum([t["place"], t["amount"]]).alias("sum_by_column"),
        F.lit(len(t.schema)).alias("n_columns"),
    )


# ---------------------------------------------------------------------- trades
def _events(spark: SparkSession, d: str, with_id: bool = True) -> DataFrame:
    return trade_events(S.trade_lines_from_events(read_table(spark, d, "events")), with_id=with_id)


def delimited_events(spark, d):
    return _events(spark, d)


def line_index(spark, d):
    return with_row_index(read_table(spark, d, "orders").select("o_orderkey"), ["o_orderkey"], "line_index", unique=True)


def _report(name: str) -> Query:
    def run(spark, d):
        return trade_report(spark, _events(spark, d, name in WITH_ID), name)

    run.__name__ = name
    return run


def product_summary_sql(spark, d):
    """SQL text over the registered event view."""
    view = unique_name("trade_events")
    register_view(_events(spark, d, with_id=False), view)
    return product_summary(spark, view)


def saved_table(spark, d):
    return save_events_table(_events(spark, d))


def float_sum_by_flag(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.groupBy("l_returnflag").agg(
        F.round(F.sum(F.col("l_extendedprice").cast("float")), 2).alias("sum_price")
    )


# -------------------------------------------------------------------- accounts
def _persons(spark, d):
    return S.persons_from_customer(read_table(spark, d, "customer"))


def _accounts(spark, d):
    return S.accounts_from_orders(read_table(spark, d, "orders"))


def _joined(spark, d):
    return A.person_accounts(_persons(spark, d), _accounts(spark, d))


def accounts_by_person_q(spark, d):
    """Each person's accounts gathered into lists sorted by id, and what the
    lists say: size, sum of balances, first and last id, and for CHEQUING
    whether one or all are of that type and the first such balance."""
    lists = A.accounts_by_person(_accounts(spark, d))
    sums = lists.groupBy("person_id").agg(
        F.sum(F.size("accounts")).alias("n"),
        F.sum(F.aggregate("accounts", F.lit(0).cast("long"), lambda acc, a: acc + a["balance"])).alias("total"),
        F.min(F.get("accounts", F.lit(0))["id"]).alias("first_id"),
        F.max(F.element_at("accounts", -1)["id"]).alias("last_id"),
    )
    answers = A.list_answers(lists, "CHEQUING").withColumnsRenamed(
        {"has": "has_chequing", "only": "only_chequing", "first": "first_chequing"})
    return sums.join(answers, "person_id")


def account_positions(spark, d):
    return A.account_positions(_accounts(spark, d))


def person_accounts(spark, d):
    return _joined(spark, d).select(*P.PERSON_COLS, "n_accounts", "total_balance")


def large_savings_high_earners(spark, d):
    return P.large_savings_high_earners(_joined(spark, d))


def broker_candidates(spark, d):
    return P.broker_candidates(_joined(spark, d))


def credit_assistance_candidates(spark, d):
    return P.credit_assistance_candidates(_joined(spark, d))


def has_account_semi(spark, d):
    return A.with_account_type(_persons(spark, d), _accounts(spark, d), "BROKER", present=True)


def has_no_account_anti(spark, d):
    return A.with_account_type(_persons(spark, d), _accounts(spark, d), "BROKER", present=False)


def bucketed_person_accounts(spark, d):
    """Persons and accounts saved in buckets of the person id, joined bucket by
    bucket: neither the profiles nor the join shuffle."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    persons = save_bucketed_table(_persons(spark, d), unique_name("persons"), "id", buckets)
    accounts = save_bucketed_table(_accounts(spark, d), unique_name("accounts"), "person_id", buckets)
    return A.person_accounts(persons, accounts).select("id", "name", "age", "earnings", "n_accounts", "total_balance")


def candidate_selections(spark, d):
    """The three selections of one job over one persisted join, as (selection, id)."""
    job = person_accounts_job(_persons(spark, d), _accounts(spark, d))
    path = scratch_path(spark, "selections")
    for name, rows in job.outputs.items():
        rows.select(F.lit(name).alias("selection"), "id").write.mode("append").parquet(path)
    job.unpersist()
    return spark.read.schema("selection string, id string").parquet(path)


def only_accounts_of_type(spark, d):
    return A.select_candidates(_joined(spark, d), A.only_accounts_of_type("CHEQUING")).select(*P.PERSON_COLS)


def account_type_flags(spark, d):
    """Per joined person and account type: has one (exists) / has only that type (forall)."""
    flags = []
    for t in A.ACCOUNT_TYPES:
        flags.append(A.has_account_type(t).alias(f"has_{t.lower()}"))
        flags.append(A.only_accounts_of_type(t).alias(f"only_{t.lower()}"))
    return _joined(spark, d).select("id", *flags)


COMPARATOR_MEASURE = 20000


def balance_comparators(spark, d):
    m = COMPARATOR_MEASURE
    return _joined(spark, d).select(
        "id",
        A.balance_below(m, "BROKER").alias("lt"),
        A.balance_at_most(m, "BROKER").alias("le"),
        A.balance_above(m, "BROKER").alias("gt"),
        A.balance_at_least(m, "BROKER").alias("ge"),
    )


def age_bounds(spark, d):
    # Fixed values of the unused age predicates: over 40, at least 50, at most 40.
    return _persons(spark, d).select(
        "id",
        A.over_age(40).alias("over_40"),
        A.age_at_least(50).alias("at_least_50"),
        A.age_at_most(40).alias("at_most_40"),
        (A.age_at_least(P.CREDIT_MIN_AGE) & A.age_at_most(P.CREDIT_MAX_AGE)).alias("age_18_to_30"),
    )


# ----------------------------------------------------------------------- keyed
TOP_KEYS = 10  # fixed value of the by-key job: first 10 keys


def sum_by_key_gathered_q(spark, d):
    pairs = S.pairs_from_lineitem(read_table(spark, d, "lineitem"))
    return top_k_by_key(sum_by_key_gathered(pairs, "key", "value", "total"), "key", TOP_KEYS)


def sum_by_key_combined(spark, d):
    pairs = S.pairs_from_lineitem(read_table(spark, d, "lineitem"))
    return top_k_by_key(sum_by_key(pairs, "key", "value", "total"), "key", TOP_KEYS)


def char_distribution_q(spark, d):
    return char_distribution(read_table(spark, d, "documents"), "text", "n")


def char_occurrence_lists_q(spark, d):
    """The occurrence list of every document and character, as text."""
    lists = char_occurrence_lists(read_table(spark, d, "documents"), "text", "doc_id")
    return lists.select("doc_id", "ch", F.array_join(F.transform("ones", lambda x: x.cast("string")), "").alias("ones"))


def char_occurrence_counts_q(spark, d):
    """The total length of the occurrence lists per character."""
    lists = char_occurrence_lists(read_table(spark, d, "documents"), "text", "doc_id")
    return char_occurrence_counts(lists, "n")


def char_totals_q(spark, d):
    return char_totals(read_table(spark, d, "documents"), "text")


def _quantities(spark, d):
    li = read_table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("i"))


def lookup_with_default_q(spark, d):
    return lookup_with_default(
        _quantities(spark, d), "i", read_table(spark, d, "nation"), "n_nationkey", "n_regionkey", 0, "m"
    )


def lookup_penalty_q(spark, d):
    return lookup_penalty(
        _quantities(spark, d).select("i"), "i", read_table(spark, d, "part"), "p_partkey", "p_size", 2, "total"
    )


def running_metrics_q(spark, d):
    return running_metrics(read_table(spark, d, "lineitem"), "l_linenumber")


# ------------------------------------------------------------------------- csv
def csv_headed_roundtrip(spark, d):
    path = scratch_path(spark, "csv-headed")
    cust = read_table(spark, d, "customer").select("c_name", "c_custkey", "c_nationkey", "c_acctbal")
    cust.write.option("header", True).csv(path)
    _, df = read_headed_csv(spark, path)
    return df


def csv_positional_accounts(spark, d):
    path = scratch_path(spark, "csv-accounts")
    S.account_lines(read_table(spark, d, "orders")).write.text(path)
    return parse_accounts(read_lines(spark, path))


def csv_positional_persons(spark, d):
    path = scratch_path(spark, "csv-persons")
    S.person_lines(read_table(spark, d, "customer")).write.text(path)
    return parse_persons(read_lines(spark, path))


def lenient_persons(spark, d):
    """Person lines, some of them bad, with a reject column."""
    path = scratch_path(spark, "csv-persons")
    S.person_lines_some_bad(read_table(spark, d, "customer")).write.text(path)
    return parse_persons(read_lines(spark, path), strict=False)


def lenient_accounts(spark, d):
    """Account lines, some of them bad, with a reject column."""
    path = scratch_path(spark, "csv-accounts")
    S.account_lines_some_bad(read_table(spark, d, "orders")).write.text(path)
    return parse_accounts(read_lines(spark, path), strict=False)


# -------------------------------------------------------------------- messages
def _messages(spark, d):
    rows = S.message_rows_from_events(read_table(spark, d, "events"))
    return format_messages(rows, "millis", "n", "ip")


def message_format(spark, d):
    return _messages(spark, d)


def message_parse(spark, d):
    return parse_messages(_messages(spark, d))


def stream_messages(spark, d):
    """Messages written as files, parsed by a Structured Streaming query
    (available-now trigger, parquet sink with its own checkpoint), read back."""
    src = scratch_path(spark, "stream-source")
    sink = scratch_path(spark, "stream-sink")
    ckpt = scratch_path(spark, "stream-checkpoint")
    _messages(spark, d).write.parquet(src)
    query = start_message_stream(spark, src, sink, ckpt, available_now=True)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return spark.read.schema(PARSED_MESSAGE_SCHEMA).parquet(sink)


QUERIES: dict[str, Query] = {
    "time_usage_summary": time_usage_summary,
    "time_usage_grouped": time_usage_grouped,
    "time_usage_grouped_sql": time_usage_grouped_sql,
    "time_usage_grouped_typed": time_usage_grouped_typed,
    "time_usage_grouped_custom": time_usage_grouped_custom,
    "time_usage_csv_grouped": time_usage_csv_grouped,
    "prefix_classified_sums": prefix_classified_sums,
    "bucket_size": bucket_size,
    "named_column_sum": named_column_sum,
    "delimited_events": delimited_events,
    "line_index": line_index,
    "event_count": _report("event_count"),
    "distinct_event_types": _report("distinct_products"),
    "amount_by_type": _report("amount_by_product"),
    "events_ordered": _report("events_ordered"),
    "min_amount_by_type": _report("min_amount_by_product"),
    "max_amount_by_type": _report("max_amount_by_product"),
    "product_summary_sql": product_summary_sql,
    "saved_table": saved_table,
    "float_sum_by_flag": float_sum_by_flag,
    "accounts_by_person": accounts_by_person_q,
    "account_positions": account_positions,
    "person_accounts": person_accounts,
    "bucketed_person_accounts": bucketed_person_accounts,
    "candidate_selections": candidate_selections,
    "large_savings_high_earners": large_savings_high_earners,
    "broker_candidates": broker_candidates,
    "credit_assistance_candidates": credit_assistance_candidates,
    "has_account_semi": has_account_semi,
    "has_no_account_anti": has_no_account_anti,
    "only_accounts_of_type": only_accounts_of_type,
    "account_type_flags": account_type_flags,
    "balance_comparators": balance_comparators,
    "age_bounds": age_bounds,
    "sum_by_key_gathered": sum_by_key_gathered_q,
    "sum_by_key_combined": sum_by_key_combined,
    "char_distribution": char_distribution_q,
    "char_occurrence_lists": char_occurrence_lists_q,
    "char_occurrence_counts": char_occurrence_counts_q,
    "char_totals": char_totals_q,
    "lookup_with_default": lookup_with_default_q,
    "lookup_penalty": lookup_penalty_q,
    "running_metrics": running_metrics_q,
    "csv_headed_roundtrip": csv_headed_roundtrip,
    "csv_positional_accounts": csv_positional_accounts,
    "csv_positional_persons": csv_positional_persons,
    "lenient_persons": lenient_persons,
    "lenient_accounts": lenient_accounts,
    "message_format": message_format,
    "message_parse": message_parse,
    "stream_messages": stream_messages,
    **TOPIC_QUERIES,
}
