"""Every registered query against its SQL twin on the small tables."""

from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

from rangehaul.checks import all_checks
from rangehaul.checks.profile_checks import TABLES

registry = all_checks()


@pytest.fixture(scope="module")
def twin(data):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{data}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return float(value) if isinstance(value, (int, float)) and abs(value) < 2**53 else value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, data, twin, name):
    frame = registry.QUERIES[name](spark, data)
    rows = frame.collect()
    assert rows
    if name in registry.SQL:
        cursor = twin.execute(registry.SQL[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(frame.columns)
        assert rows_of(frame.columns, rows) == rows_of(names, cursor.fetchall())
