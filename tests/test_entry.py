import duckdb
import pytest

import __spark_entry__ as entry
from checks.compare import TABLES, differences
from checks.oracle import ORACLE
from checks.queries import QUERIES

from conftest import SF


@pytest.fixture(scope="module")
def connection():
    with duckdb.connect() as c:
        for t in TABLES:
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        yield c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "column" and df.count() == 4


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, connection, name):
    assert differences(spark, connection, name, SF) == []
