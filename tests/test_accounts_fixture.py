"""Persons and accounts on the small CSV fixture (tests/fixtures), against
the expected values listed in FIXTURES.md (F5)."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from quarry.operators import accounts as A
from quarry.plans import person_accounts as P
from quarry.sources.csv import read_lines
from quarry.sources.records import parse_accounts, parse_persons

FIX = Path(__file__).resolve().parent / "fixtures"


@pytest.fixture(scope="module")
def tables(spark):
    persons = parse_persons(read_lines(spark, str(FIX / "person.csv")))
    accounts = parse_accounts(read_lines(spark, str(FIX / "account.csv")))
    return persons, accounts


def ids(df):
    return sorted(int(r.id) for r in df.collect())


def test_shapes(tables):
    persons, accounts = tables
    assert persons.count() == 100 and accounts.count() == 149
    assert accounts.select("person_id").distinct().count() == 61
    assert accounts.agg(F.sum("balance")).first()[0] == 5456925
    per_type = accounts.groupBy("person_id", "type").count().where("count > 1").count()
    assert per_type == 0


def test_join_and_selections(tables):
    persons, accounts = tables
    joined = A.person_accounts(persons, accounts)
    assert joined.count() == 60
    assert ids(P.large_savings_high_earners(joined)) == [18, 27, 28, 41, 48, 52, 53, 57, 75, 95, 100]
    broker = P.broker_candidates(joined).collect()
    assert [(r.id, r.name, r.age, r.earnings) for r in broker] == [("100", "Adam", 54, 126082)]
    assert joined.where("id = '100'").first().first_savings_balance == 60700
    inclusive = A.select_candidates(
        joined, A.earnings_at_least(50000), A.age_at_least(45), A.age_at_most(55),
        A.balance_at_least(10000, "SAVINGS"), A.has_not_account_type("BROKER"))
    assert ids(inclusive) == [100]
    credit = {int(r.id): r.first_credit_balance for r in
              P.credit_assistance_candidates(joined).join(joined.select("id", "first_credit_balance"), "id").collect()}
    assert credit == {35: -23650, 49: -15075, 68: -21725}


def test_untrimmed_ids_join_one_person(spark, tables):
    _, accounts = tables
    raw = read_lines(spark, str(FIX / "person.csv")).select(
        F.split("value", ",")[0].alias("raw_id"))
    assert raw.join(accounts, raw["raw_id"] == accounts["person_id"]).select("raw_id").distinct().count() == 1
