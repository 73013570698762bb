"""Registered queries: SQL twins, and what the contracts fix."""

import duckdb
import pytest

from rangehaul.llm.checks import QUERIES, SQL

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels")


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, data, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    cursor = connection.execute(SQL[name])
    names = sorted(d[0] for d in cursor.description)
    order = [[d[0] for d in cursor.description].index(n) for n in names]
    expected = sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    frame = QUERIES[name](spark, data)
    assert sorted(frame.columns) == names
    assert sorted((tuple(map(plain, r)) for r in frame.select(names).collect()), key=repr) == expected


def test_one_query_per_operator():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
