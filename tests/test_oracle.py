"""Every registered query against its SQL twin."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
from weatherloom.catalog import registry

NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_a_twin():
    assert set(registry.SQL) == set(NAMES)
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, sf_dir, con, name):
    df, sql = entry.queries()[name](spark, sf_dir), entry.oracle_sql()[name]
    types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert {f.name: SQL_TYPES[f.dataType.simpleString()] for f in df.schema.fields} == types
    columns, got = compare.spark_rows(df)
    want_columns, want = compare.sql_rows(con, sql)
    assert columns == want_columns
    assert got == want


def test_entry_is_one_row(spark):
    assert entry.entry(spark).count() == 1
