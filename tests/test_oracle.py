"""Every registered query against its SQL in DuckDB, over the same tables."""

from __future__ import annotations

import datetime
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry
from tallymonth.queries.oracle import ORACLE_SQL
from tallymonth.queries.registry import QUERIES

TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _rows(columns: list[str], rows: list) -> Counter:
    """Rows as a multiset, columns by name."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def _plain(value: object) -> object:
    if isinstance(value, datetime.datetime):
        return value.date()
    return value


def test_every_query_has_sql() -> None:
    assert QUERIES.keys() == ORACLE_SQL.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_and_types(spark, duck, sf_dir: str, name: str) -> None:
    result = QUERIES[name](spark, sf_dir)
    expected = duck.sql(ORACLE_SQL[name])

    types = {n: TYPES.get(t, t.upper()) for n, t in result.dtypes}
    assert types == {n: str(t) for n, t in zip(expected.columns, expected.types)}
    assert _rows(result.columns, result.collect()) == _rows(expected.columns, expected.fetchall())


def test_flagship_query(spark) -> None:
    report = entry(spark)
    assert report.columns == [
        "fi_code",
        "date",
        "service_system_type",
        "transaction_type",
        "merchant_business_type",
        "merchant_category_code",
        "amount",
        "number",
        "terminal_average_amount_range",
    ]
    assert report.count() > 0
