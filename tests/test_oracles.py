"""Every registered query with SQL gives the rows of that SQL."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from tidemark import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def plain(value):
    if not isinstance(value, (list, np.ndarray)) and pd.isna(value):
        return "null"
    if isinstance(value, (list, np.ndarray)):
        return str([plain(x) for x in value])
    if isinstance(value, (bool, np.bool_)):
        return str(bool(value))
    if isinstance(value, (int, np.integer)):
        return str(int(value))
    return str(value)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(tuple(plain(r[i]) for i in order) for r in values)


def of_spark(df):
    return rows(df.columns, df.collect())


def of_sql(relation):
    return rows(relation.columns, relation.fetchall())


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_matches_sql(spark, db, name):
    assert of_spark(plans.QUERIES[name](spark, SF)) == of_sql(db.sql(plans.ORACLES[name]))


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert plans.QUERIES[name](spark, SF).count() > 0
