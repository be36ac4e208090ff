from __spark_entry__ import queries
from quarry.plans import jobs
from quarry.plans import standins as S
from quarry.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_time_usage_job_matches_single_queries(spark):
    res = jobs.time_usage_job(spark, S.survey_from_lineitem(read_table(spark, SF, "lineitem")))
    try:
        q = queries()
        assert rows(res.outputs["grouped"]) == rows(q["time_usage_grouped"](spark, SF))
        assert rows(res.outputs["grouped_typed"]) == rows(q["time_usage_grouped_custom"](spark, SF))
        assert rows(res.outputs["grouped_sql"]) == rows(res.outputs["grouped"])
    finally:
        res.unpersist()


def test_trade_job_reports(spark):
    res = jobs.trade_job(spark, S.trade_lines_from_events(read_table(spark, SF, "events")))
    try:
        n = read_table(spark, SF, "events").count()
        assert res.outputs["event_count"].first()[0] == n
        assert res.outputs["saved_table"].count() == n
        assert rows(res.outputs["amount_by_product"]) == rows(queries()["amount_by_type"](spark, SF))
    finally:
        res.unpersist()


def test_person_accounts_job(spark):
    persons = S.persons_from_customer(read_table(spark, SF, "customer"))
    accounts = S.accounts_from_orders(read_table(spark, SF, "orders"))
    res = jobs.person_accounts_job(persons, accounts)
    try:
        assert rows(res.outputs["broker_candidates"]) == rows(queries()["broker_candidates"](spark, SF))
    finally:
        res.unpersist()
