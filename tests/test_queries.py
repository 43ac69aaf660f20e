"""Every registered query against its SQL on the smallest tables."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    names = ", ".join(f'"{c}"' for c in columns)
    want = Counter(con.sql(f"SELECT {names} FROM ({ORACLE[name]})").fetchall())
    assert sum(got.values()) > 0
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).columns == [
        "type_of_product", "market_min", "market_max", "competitor_count"
    ]


def test_forest_queries_give_finite_prices(spark):
    rows = QUERIES["forest_predict"](spark, FOLDER).collect()
    assert len(rows) > 50
    for r in rows:
        assert math.isfinite(r.predicted_price_per_unit) and r.predicted_price_per_unit > 0
        assert 0 <= r.model_confidence <= 100
