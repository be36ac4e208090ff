"""Person-accounts job: accounts per person, join, candidate selection."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quarry.operators import accounts as A

# Fixed values of the person-accounts job (thresholds of its selections).
# large savings: earnings > 50000 and first savings balance > 50000
# broker candidates: earnings >= 50000, 45 <= age <= 55, first savings balance > 10000, no BROKER account
# credit assistance: earnings <= 40000, 18 <= age <= 30, first credit balance <= -10000
LARGE_SAVINGS = 50000
LARGE_EARNINGS = 50000
BROKER_MIN_EARNINGS = 50000
BROKER_MIN_AGE, BROKER_MAX_AGE = 45, 55
BROKER_MIN_SAVINGS = 10000
CREDIT_MAX_EARNINGS = 40000
CREDIT_MIN_AGE, CREDIT_MAX_AGE = 18, 30
CREDIT_MAX_BALANCE = -10000

PERSON_COLS = ("id", "name", "age", "earnings")


def large_savings_high_earners(joined: DataFrame) -> DataFrame:
    return A.select_candidates(
        joined, A.earnings_above(LARGE_EARNINGS), A.balance_above(LARGE_SAVINGS, "SAVINGS")
    ).select(*PERSON_COLS)


def broker_candidates(joined: DataFrame) -> DataFrame:
    """The reference compares the savings balance with ``>`` (its
    "at least" comparator is strict), kept here as :func:`balance_above`."""
    return A.select_candidates(
        joined,
        A.earnings_at_least(BROKER_MIN_EARNINGS),
        A.age_at_least(BROKER_MIN_AGE),
        A.age_at_most(BROKER_MAX_AGE),
        A.balance_above(BROKER_MIN_SAVINGS, "SAVINGS"),
        A.has_not_account_type("BROKER"),
    ).select(*PERSON_COLS)


def credit_assistance_candidates(joined: DataFrame) -> DataFrame:
    return A.select_candidates(
        joined,
        A.earnings_at_most(CREDIT_MAX_EARNINGS),
        A.age_at_least(CREDIT_MIN_AGE),
        A.age_at_most(CREDIT_MAX_AGE),
        A.balance_at_most(CREDIT_MAX_BALANCE, "CREDIT"),
    ).select(*PERSON_COLS)
