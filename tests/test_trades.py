import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quarry.operators.reports import register_view, report
from quarry.plans.trades import save_events_table, trade_events

from tests_support import TRADE_LINES as LINES


@pytest.fixture(scope="module")
def events(spark):
    lines = spark.createDataFrame([(i, s) for i, s in enumerate(LINES)], "line_no long, line string")
    ev = trade_events(lines.repartition(3))
    register_view(ev, "trade_events_test")
    return ev


def test_events_per_trade(events):
    counts = {r.trade_id: r["count"] for r in events.groupBy("trade_id").count().collect()}
    assert counts == {0: 3, 1: 3, 2: 4, 3: 3}
    assert events.schema.simpleString() == (
        "struct<trade_id:bigint,product_id:string,timestamp:string,amount:float>"
    )


def test_reports(spark, events):
    v = "trade_events_test"
    assert report(spark, "event_count", v).collect()[0]["count(1)"] == 13
    assert [r.product_id for r in report(spark, "distinct_products", v).collect()] == ["FWD", "SPOT"]
    sums = {r.product_id: r["sum(amount)"] for r in report(spark, "amount_by_product", v).collect()}
    assert sums == {"FWD": 179.7400026321411, "SPOT": 57.22000026702881}
    mins = {r.product_id: r["min(amount)"] for r in report(spark, "min_amount_by_product", v).collect()}
    maxs = {r.product_id: r["max(amount)"] for r in report(spark, "max_amount_by_product", v).collect()}
    assert mins == pytest.approx({"FWD": 10.56, "SPOT": 11.23})
    assert maxs == pytest.approx({"FWD": 56.0, "SPOT": 23.2})


def test_events_ordered_by_time_text(spark, events):
    rows = report(spark, "events_ordered", "trade_events_test").collect()
    assert (rows[0].timestamp, rows[0].trade_id) == ("2905206:08:01", 2)
    assert (rows[-1].timestamp, rows[-1].trade_id) == ("2905206:15:40", 0)
    assert rows[-2].timestamp == "2905206:14:340"
    assert [r.timestamp for r in rows] == sorted(r.timestamp for r in rows)


def test_saved_table_fails_when_present(spark, events):
    name = "events_table_test"
    t = save_events_table(events, name)
    assert t.count() == 13
    with pytest.raises(AnalysisException):
        save_events_table(events, name)
    spark.sql(f"DROP TABLE {name}")


def test_create_table_as_sql(spark, events):
    from quarry.operators.tables import create_table_as

    name = "events_ctas_test"
    t = create_table_as(spark, name, "SELECT * FROM trade_events_test")
    assert t.count() == 13 and t.columns == ["trade_id", "product_id", "timestamp", "amount"]
    with pytest.raises(AnalysisException, match="already exists|ALREADY_EXISTS"):
        create_table_as(spark, name, "SELECT * FROM trade_events_test")
    spark.sql(f"DROP TABLE {name}")


def test_bad_amount_fails(spark):
    lines = spark.createDataFrame([(0, "FWD,t,abc")], "line_no long, line string")
    with pytest.raises(Exception):
        trade_events(lines).collect()


def test_missing_field_fails(spark):
    lines = spark.createDataFrame([(0, "FWD,t")], "line_no long, line string")
    with pytest.raises(Exception):
        trade_events(lines).select(F.col("amount")).collect()
