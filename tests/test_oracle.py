"""Every registered query against its SQL, on the small tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_points
from shopgrain.plans import catalog

TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def canonical(table):
    names = sorted(table.column_names)
    kinds = [str(table.schema.field(n).type).replace("large_string", "string") for n in names]
    rows = zip(*[table.column(n).to_pylist() for n in names]) if names else []
    return names, kinds, sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query_equals_sql(spark, duck, folder, name):
    found = canonical(entry_points.queries()[name](spark, folder).toArrow())
    expected = canonical(duck.sql(entry_points.oracle_sql()[name]).to_arrow_table())
    assert found[0] == expected[0]
    assert found[1] == expected[1]
    assert found[2] == expected[2]


def test_entry(spark):
    assert entry_points.entry(spark).count() == 5


def test_every_query_has_sql():
    assert set(catalog.queries()) <= set(entry_points.oracle_sql())
