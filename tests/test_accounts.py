import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import accounts as A
from quarry.plans import person_accounts as P

PERSONS = [
    ("1", "Ann", 50, 60000),
    ("2", "Bob", 25, 30000),
    ("3", "Cid", 47, 52000),
    ("4", "Dee", 33, 90000),
    ("5", "Eve", 52, 70000),  # no accounts
]
ACCOUNTS = [
    (10, "1", "SAVINGS", 60000),
    (11, "1", "CREDIT", -500),
    (12, "2", "CREDIT", -15000),
    (13, "2", "SAVINGS", 100),
    (14, "3", "SAVINGS", 10000),   # exactly 10000: ">" excludes, ">=" includes
    (15, "3", "CHEQUING", 10),
    (16, "4", "BROKER", 5),
    (17, "4", "BROKER", 7),
    (18, "1", "SAVINGS", 1),       # second savings account: the first (id 10) counts
]


@pytest.fixture(scope="module")
def tables(spark):
    persons = spark.createDataFrame(PERSONS, "id string, name string, age int, earnings int")
    accounts = spark.createDataFrame(ACCOUNTS, "id long, person_id string, type string, balance int")
    return persons, accounts


def ids(df):
    return sorted(r.id for r in df.collect())


def test_profile_matches_nested_lists(tables):
    persons, accounts = tables
    prof = {r.person_id: r for r in A.account_profile(accounts).collect()}
    nested = A.accounts_by_person(accounts)
    for t in A.ACCOUNT_TYPES:
        for r in A.list_answers(nested, t).collect():
            p = prof[r.person_id]
            assert r.has == (p[f"n_{t.lower()}"] > 0)
            assert r.only == (p[f"n_{t.lower()}"] == p.n_accounts)
            assert r.first == p[f"first_{t.lower()}_balance"]
    assert prof["1"].first_savings_balance == 60000
    assert prof["1"].total_balance == 60000 - 500 + 1


def test_join_drops_persons_without_accounts(tables):
    persons, accounts = tables
    assert ids(A.person_accounts(persons, accounts)) == ["1", "2", "3", "4"]


def test_candidates(tables):
    joined = A.person_accounts(*tables)
    assert ids(P.large_savings_high_earners(joined)) == ["1"]
    assert ids(P.broker_candidates(joined)) == ["1"]
    assert ids(A.select_candidates(joined, A.balance_at_least(10000, "SAVINGS"), A.age_at_least(45))) == ["1", "3"]
    assert ids(P.credit_assistance_candidates(joined)) == ["2"]
    assert ids(A.select_candidates(joined, A.only_accounts_of_type("BROKER"))) == ["4"]


def test_semi_and_anti(tables):
    persons, accounts = tables
    assert ids(A.with_account_type(persons, accounts, "BROKER", True)) == ["4"]
    assert ids(A.with_account_type(persons, accounts, "BROKER", False)) == ["1", "2", "3", "5"]


def test_comparators_absent_is_false(tables):
    joined = A.person_accounts(*tables)
    r = {x.id: x for x in joined.select(
        "id", A.balance_below(6, "BROKER").alias("lt"), A.balance_at_most(5, "BROKER").alias("le"),
        A.balance_above(5, "BROKER").alias("gt"), A.balance_at_least(5, "BROKER").alias("ge"),
    ).collect()}
    assert (r["4"].lt, r["4"].le, r["4"].gt, r["4"].ge) == (True, True, False, True)
    assert (r["1"].lt, r["1"].le, r["1"].gt, r["1"].ge) == (False, False, False, False)


def test_positions_equal_exploded_lists(tables):
    _, accounts = tables
    pos = sorted(tuple(r) for r in A.account_positions(accounts.repartition(4)).collect())
    nested = A.accounts_by_person(accounts).select(
        "person_id", F.posexplode("accounts").alias("pos", "a")
    ).select("person_id", "pos", "a.id", "a.type", "a.balance")
    assert pos == sorted(tuple(r) for r in nested.collect())


def test_list_runs_hold_the_whole_list(tables):
    _, accounts = tables
    by_person = {}
    for r in sorted(A.accounts_by_person(accounts).collect(), key=lambda r: (r.person_id, r.run)):
        by_person.setdefault(r.person_id, []).extend(a.id for a in r.accounts)
    expected = {}
    for i, p, _, _ in sorted(ACCOUNTS):
        expected.setdefault(p, []).append(i)
    assert by_person == expected


def test_positions_with_one_hot_person(spark):
    rows = [(i, "hot" if i % 3 else f"p{i}", "SAVINGS", i) for i in range(3000)]
    acc = spark.createDataFrame(rows, "id long, person_id string, type string, balance int")
    got = A.account_positions(acc.repartition(8)).where(F.col("person_id") == "hot")
    ids_pos = sorted((r.id, r.pos) for r in got.collect())
    hot_ids = sorted(i for i in range(3000) if i % 3)
    assert ids_pos == list(zip(hot_ids, range(len(hot_ids))))


def test_bucketed_tables_join_without_shuffle(spark):
    from quarry.operators.tables import save_bucketed_table
    from quarry.plans import standins as S
    from quarry.session import unique_name
    from quarry.sources.tables import read_table

    sf = "/root/testdata/sf0.001"
    persons = save_bucketed_table(
        S.persons_from_customer(read_table(spark, sf, "customer")), unique_name("persons_b"), "id", 8)
    accounts = save_bucketed_table(
        S.accounts_from_orders(read_table(spark, sf, "orders")), unique_name("accounts_b"), "person_id", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = A.person_accounts(persons, accounts)
        p = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in p
        assert "Exchange" not in p
        direct = A.person_accounts(
            S.persons_from_customer(read_table(spark, sf, "customer")),
            S.accounts_from_orders(read_table(spark, sf, "orders")),
        )
        assert sorted(tuple(r) for r in joined.collect()) == sorted(tuple(r) for r in direct.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["p", "q", "r"]), st.integers(0, 10**6)), max_size=40,
                unique_by=lambda t: t[1]), st.integers(1, 4))
def test_list_runs_property(spark, rows, parts):
    if not rows:
        return
    acc = spark.createDataFrame([(i, p, "SAVINGS", 1) for p, i in rows],
                                "id long, person_id string, type string, balance int")
    got = {}
    for r in sorted(A.accounts_by_person(acc.repartition(parts)).collect(), key=lambda r: (r.person_id, r.run)):
        assert r.accounts
        got.setdefault(r.person_id, []).extend(a.id for a in r.accounts)
    exp = {}
    for p, i in sorted(rows, key=lambda t: t[1]):
        exp.setdefault(p, []).append(i)
    assert got == exp


def test_list_answers_of_a_person_cut_into_runs(spark):
    rows = [(i, "hot", "BROKER" if i < 1500 else "SAVINGS", i) for i in range(2000)] + [(9000, "p", "BROKER", 1), (9001, "q", "CREDIT", 2)]
    acc = spark.createDataFrame(rows, "id long, person_id string, type string, balance int").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lists = A.accounts_by_person(acc)
        assert lists.where("person_id = 'hot'").count() > 1
        got = {t: {r.person_id: (r.has, r.only, r.first) for r in A.list_answers(lists, t).collect()} for t in ("BROKER", "SAVINGS")}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got["BROKER"] == {"hot": (True, False, 0), "p": (True, True, 1), "q": (False, False, None)}
    assert got["SAVINGS"]["hot"] == (True, False, 1500)


def test_no_list_is_longer_than_a_run(spark, monkeypatch):
    monkeypatch.setattr(A, "RUN", 7)
    rows = [(i, "hot" if i % 3 else f"p{i % 5}", "SAVINGS", i) for i in range(200)]
    acc = spark.createDataFrame(rows, "id long, person_id string, type string, balance int").repartition(3)
    got = {}
    for r in sorted(A.accounts_by_person(acc).collect(), key=lambda r: (r.person_id, r.run)):
        assert 0 < len(r.accounts) <= 7
        got.setdefault(r.person_id, []).extend(a.id for a in r.accounts)
    assert got == {p: [i for i, q, _, _ in rows if q == p] for p in {r[1] for r in rows}}


def test_no_text_has_no_characters(spark):
    from quarry.operators.keyed import char_totals

    df = spark.createDataFrame([(None,), ("",), ("añ😀",)], "text string")
    assert tuple(char_totals(df, "text").first()) == (3, 3) and tuple(char_totals(df.where("false"), "text").first()) == (0, 0)
