"""Every registered query against DuckDB on the smallest given tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from cataloom import showcase

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _sorted_rows(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("key", sorted(showcase.QUERIES))
def test_query_agrees_with_sql(spark, duck, key):
    result = entry.queries()[key](spark, str(DATA))
    found = duck.execute(entry.oracle_sql()[key])
    columns = [c[0] for c in found.description]
    assert sorted(result.columns) == sorted(columns)
    assert _sorted_rows(result.collect(), result.columns) == _sorted_rows(
        found.fetchall(), columns
    )


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(showcase.QUERIES) == set(showcase.ORACLES)
    assert set(showcase.QUERIES) <= set(entry.queries())
