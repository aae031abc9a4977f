"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from check_oracle import bag
from tillstream.plans.oracle import ORACLE
from tillstream.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="benchmark tables not found")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["category", "total_revenue", "order_count"]
    assert result.count() > 0


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, db, name):
    result = contract.queries()[name](spark, SF_DIR)
    cursor = db.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    assert bag(result.columns, result.collect()) == bag(columns, cursor.fetchall())
