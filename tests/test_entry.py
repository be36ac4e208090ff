from __spark_entry__ import entry, oracle_sql, queries
from quarry.plans.registry import QUERIES


def test_entry_smoke(spark):
    df = entry(spark)
    rows = df.collect()
    assert df.columns == ["working", "sex", "age", "avg(primaryNeeds)", "avg(work)", "avg(other)"]
    assert len(rows) == 12


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())
