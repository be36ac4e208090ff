"""Persons and their accounts: per-person profiles, joins, predicates and
candidate selection.

The reference model pairs each person with the list of their accounts.
Lists are available in bounded runs (:func:`accounts_by_person`), but jobs use
:func:`account_profile`: one row per person built with partial aggregates
(counts per type, first account of each type by lowest id, total balance).
It answers every list predicate (exists, forall, first-of-type) while a
person who holds a large share of all accounts is combined map-side instead
of being gathered into one row.
"""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordering import position_in_group, sorted_tags

# Fixed values of the accounts job: the account types, in declaration order.
ACCOUNT_TYPES = ("SAVINGS", "CHEQUING", "CREDIT", "BROKER")

#: Accounts in one nested list, at most.
RUN = 100_000


def _t(account_type: str) -> str:
    return account_type.lower()


# ---------------------------------------------------------------- nested lists
def accounts_by_person(accounts: DataFrame) -> DataFrame:
    """``person_id, run, accounts``: each person's accounts as lists of
    ``(id, type, balance)`` structs sorted by account id.

    The accounts are sorted by person and id once; a list is a run, the
    consecutive accounts of a person inside one block of ``RUN`` sorted rows, so
    no row holds more.  Runs 0, 1, ... of a person, one after another, are the
    whole list.  Where a long list is cut depends on the partitioning; most
    persons have one run.
    """
    tagged = sorted_tags(accounts, ["person_id", "id"])
    runs = tagged.groupBy("_q_part", F.floor(F.col("_q_pos") / RUN).alias("_q_block"), "person_id").agg(
        F.array_sort(F.collect_list(F.struct("id", "type", "balance"))).alias("accounts"))
    number = F.row_number().over(Window.partitionBy("person_id").orderBy("_q_part", "_q_block")) - 1
    return runs.select("person_id", number.cast("long").alias("run"), "accounts")


def list_answers(lists: DataFrame, account_type: str) -> DataFrame:
    """Per person, from the runs of its list: ``has`` (some account has the
    type), ``only`` (all have it) and ``first`` (balance of the lowest id of
    that type, or null); the same wherever the list is cut."""
    of_type = F.filter("accounts", lambda a: a["type"] == F.lit(account_type))
    first = F.get(of_type, 0)
    return lists.groupBy("person_id").agg(
        F.bool_or(F.size(of_type) > 0).alias("has"),
        F.bool_and(F.size(of_type) == F.size("accounts")).alias("only"),
        F.min_by(first["balance"], first["id"]).alias("first"),
    )


# --------------------------------------------------------------- profile form
def account_profile(accounts: DataFrame, types: Sequence[str] = ACCOUNT_TYPES) -> DataFrame:
    """One row per ``person_id`` with ``n_accounts``, ``total_balance`` and, per
    type ``t``: ``n_t`` (count) and ``first_t_balance`` (balance of the
    lowest-id account of that type, null if none).  All partial aggregates.
    """
    aggs = [
        F.count(F.lit(1)).alias("n_accounts"),
        F.sum("balance").cast("long").alias("total_balance"),
    ]
    for t in types:
        is_t = F.col("type") == F.lit(t)
        aggs.append(F.count(F.when(is_t, F.lit(1))).alias(f"n_{_t(t)}"))
        # balance at the lowest id of this type (null orderings are skipped);
        # fixed-width buffers keep this in the hash aggregate
        first = F.min_by(F.col("balance"), F.when(is_t, F.col("id")))
        aggs.append(first.alias(f"first_{_t(t)}_balance"))
    return accounts.groupBy("person_id").agg(*aggs)


def person_accounts(persons: DataFrame, accounts: DataFrame) -> DataFrame:
    """Inner join of persons with their account profile (persons without
    accounts drop out).  Both sides hold one row per person, so the join
    has no hot key whatever the account distribution."""
    profile = account_profile(accounts)
    return persons.join(profile, persons["id"] == profile["person_id"], "inner").drop("person_id")


def account_positions(accounts: DataFrame) -> DataFrame:
    """Each account with ``pos``, its 0-based place in its person's list
    ordered by account id (the exploded form of :func:`accounts_by_person`),
    computed without gathering a person's accounts
    (:func:`quarry.operators.ordering.position_in_group`)."""
    return position_in_group(accounts, "person_id", ["id"], "pos").select(
        "person_id", "pos", "id", "type", "balance"
    )


# ------------------------------------------------------------------ predicates
def _first_balance(account_type: str) -> Column:
    return F.col(f"first_{_t(account_type)}_balance")


def balance_qualifies(op, measure: int, account_type: str) -> Column:
    """``op(first balance of type, measure)``; false when there is no such account."""
    return F.coalesce(op(_first_balance(account_type), F.lit(measure)), F.lit(False))


def balance_below(measure: int, account_type: str) -> Column:
    return balance_qualifies(operator.lt, measure, account_type)


def balance_at_most(measure: int, account_type: str) -> Column:
    return balance_qualifies(operator.le, measure, account_type)


def balance_above(measure: int, account_type: str) -> Column:
    return balance_qualifies(operator.gt, measure, account_type)


def balance_at_least(measure: int, account_type: str) -> Column:
    return balance_qualifies(operator.ge, measure, account_type)


def age_at_least(age: int) -> Column:
    return F.col("age") >= F.lit(age)


def age_at_most(age: int) -> Column:
    return F.col("age") <= F.lit(age)


def over_age(age: int) -> Column:
    return F.col("age") > F.lit(age)


def earnings_at_least(measure: int) -> Column:
    return F.col("earnings") >= F.lit(measure)


def earnings_at_most(measure: int) -> Column:
    return F.col("earnings") <= F.lit(measure)


def earnings_above(measure: int) -> Column:
    return F.col("earnings") > F.lit(measure)


def has_account_type(account_type: str) -> Column:
    return F.col(f"n_{_t(account_type)}") > F.lit(0)


def has_not_account_type(account_type: str) -> Column:
    return F.col(f"n_{_t(account_type)}") == F.lit(0)


def only_accounts_of_type(account_type: str) -> Column:
    """Every account of the person has the type (true for no accounts)."""
    return F.col(f"n_{_t(account_type)}") == F.col("n_accounts")


def select_candidates(df: DataFrame, *predicates: Column) -> DataFrame:
    """Rows for which all predicates hold (one conjunctive filter)."""
    return df.where(reduce(operator.and_, predicates)) if predicates else df


# -------------------------------------------------------------- table forms
def with_account_type(
    persons: DataFrame, accounts: DataFrame, account_type: str, present: bool = True
) -> DataFrame:
    """Persons that have (``left_semi``) or lack (``left_anti``) an account of
    ``account_type``.  The accounts side is reduced to distinct person ids
    first (a partial aggregate), so a person with many accounts is one row
    by the time the join shuffles."""
    holders = (
        accounts.where(F.col("type") == F.lit(account_type)).select("person_id").distinct()
    )
    how = "left_semi" if present else "left_anti"
    return persons.join(holders, persons["id"] == holders["person_id"], how)
