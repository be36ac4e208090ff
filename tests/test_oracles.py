"""Every registered query against its DuckDB oracle at sf0.001: column names
and types, row count and values (floats exact, rows order-insensitive)."""

import duckdb
import pytest

from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
         "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(oracle_sql()[name])
    assert {f.name: TYPES.get(f.dataType.simpleString()) for f in df.schema.fields} == \
        {c: str(t) for c, t in zip(rel.columns, rel.types)}
    expected = rel.fetchall()
    assert len(rows) == len(expected)
    assert canon(df.columns, rows) == canon(rel.columns, expected)
