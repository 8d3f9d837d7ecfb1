"""The training-data queries with SQL give the rows of that SQL."""

import duckdb
import pytest

from tests.test_oracles import TABLES, of_spark, of_sql
from tidemark.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    assert of_spark(queries.QUERIES[name](spark, sf)) == of_sql(con.sql(queries.ORACLES[name]))
