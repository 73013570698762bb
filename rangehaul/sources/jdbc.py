"""Parallel JDBC reads by range predicate, and catalog tables of the source.

Needs the driver jar of the source. One task per predicate, a fetch size per plan, the
projection and the snapshot inside a subquery, credentials from the environment at run time.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from rangehaul.functions.literals import quoted_name
from rangehaul.functions.types import SourceColumn
from rangehaul.operators.conform import source_projection


@dataclass(frozen=True)
class JdbcTable:
    """A source table. User and password are named by environment variables, never stored."""

    url: str
    driver: str
    schema: str
    table: str
    dialect: str = "sqlserver"
    user_env: str = "SOURCE_USER"
    password_env: str = "SOURCE_PASSWORD"
    snapshot: int | None = None
    extra: Mapping[str, str] = field(default_factory=dict)

    @property
    def qualified(self) -> str:
        return f"{quoted_name(self.schema, self.dialect)}.{quoted_name(self.table, self.dialect)}"

    def relation(self, columns: Sequence[SourceColumn] = ()) -> str:
        """The table as a subquery: typed projection, and the snapshot all ranges share."""
        if self.snapshot is not None and self.dialect != "oracle":
            raise ValueError("a system change number is an Oracle snapshot")
        selected = source_projection(columns, self.dialect) if columns else "*"
        as_of = f" AS OF SCN {int(self.snapshot)}" if self.snapshot is not None else ""
        return f"(SELECT {selected} FROM {self.qualified}{as_of}) source_rows"

    def properties(self, fetch_rows: int | None = None) -> dict[str, str]:
        missing = [name for name in (self.user_env, self.password_env) if name not in os.environ]
        if missing:
            raise ValueError(f"credentials not in the environment: {', '.join(missing)}")
        options = {
            "driver": self.driver,
            "user": os.environ[self.user_env],
            "password": os.environ[self.password_env],
            # Timestamps without a zone stay without one.
            "preferTimestampNTZ": "true",
            **self.extra,
        }
        if fetch_rows is not None:
            options["fetchsize"] = str(fetch_rows)
        return options


def read_ranges(
    spark: SparkSession,
    table: JdbcTable,
    predicates: Sequence[str],
    columns: Sequence[SourceColumn] = (),
    fetch_rows: int | None = None,
) -> DataFrame:
    """One partition per predicate; the predicates of a plan cover the table exactly once."""
    return spark.read.jdbc(
        table.url,
        table.relation(columns),
        predicates=list(predicates) or ["1=1"],
        properties=table.properties(fetch_rows),
    )


def read_single(spark: SparkSession, table: JdbcTable, columns: Sequence[SourceColumn] = (), fetch_rows: int | None = None) -> DataFrame:
    """A small table, or one without a safe key: a single scan."""
    return read_ranges(spark, table, ["1=1"], columns, fetch_rows)


def read_query(spark: SparkSession, table: JdbcTable, query: str) -> DataFrame:
    return spark.read.jdbc(table.url, f"({query}) source_rows", properties=table.properties())


def read_bounds(spark: SparkSession, table: JdbcTable, column: str) -> DataFrame:
    """Smallest and largest key at the same snapshot as the ranges."""
    name = quoted_name(column, table.dialect)
    relation = table.relation()
    return read_query(spark, table, f"SELECT MIN({name}) AS low, MAX({name}) AS high FROM {relation}")


# Catalog views of SQL Server with the columns that column discovery takes.
SQLSERVER_CATALOG = {
    "columns": "SELECT object_id AS [table], column_id, name AS [column], system_type_id AS type_id, "
    "is_nullable AS nullable, precision, scale, max_length FROM sys.columns",
    "types": "SELECT user_type_id AS type_id, name AS sql_type FROM sys.types WHERE is_user_defined = 0",
    "indexes": "SELECT object_id AS [table], index_id, type AS index_type, is_unique, is_primary_key AS primary_key, "
    "is_disabled AS disabled, is_hypothetical AS hypothetical, has_filter AS filtered FROM sys.indexes",
    "index_columns": "SELECT object_id AS [table], index_id, column_id, key_ordinal FROM sys.index_columns",
    "stats": "SELECT object_id AS [table], stats_id, has_filter AS filtered FROM sys.stats",
    "stats_columns": "SELECT object_id AS [table], stats_id, column_id, stats_column_id FROM sys.stats_columns",
    "partition_stats": "SELECT object_id AS [table], index_id, row_count, used_page_count FROM sys.dm_db_partition_stats",
    "partitions": "SELECT object_id AS [table], index_id, rows AS row_count FROM sys.partitions",
}

# Catalog views of Oracle.
ORACLE_CATALOG = {
    "tables": 'SELECT table_name AS "table", num_rows AS "num_rows", avg_row_len AS "avg_row_len", '
    'blocks AS "blocks" FROM all_tables WHERE owner = \'{owner}\'',
    "columns": 'SELECT table_name AS "table", column_id AS "column_id", column_name AS "column", data_type AS "data_type", '
    'nullable AS "nullable", data_precision AS "precision", data_scale AS "scale", data_length AS "data_length", '
    'avg_col_len AS "avg_col_len" FROM all_tab_columns WHERE owner = \'{owner}\'',
    "indexes": 'SELECT table_name AS "table", index_name AS "index_name", uniqueness AS "uniqueness", status AS "status", '
    'index_type AS "index_type" FROM all_indexes WHERE table_owner = \'{owner}\'',
    "index_columns": 'SELECT table_name AS "table", index_name AS "index_name", column_name AS "column", '
    'column_position AS "key_ordinal" FROM all_ind_columns WHERE table_owner = \'{owner}\'',
    "constraints": 'SELECT table_name AS "table", index_name AS "index_name", constraint_type AS "constraint_type" '
    "FROM all_constraints WHERE owner = '{owner}' AND constraint_type = 'P'",
}


def catalog(spark: SparkSession, table: JdbcTable) -> dict[str, DataFrame]:
    """Catalog frames of the source, for `discover_columns` and the size operators."""
    queries = SQLSERVER_CATALOG if table.dialect == "sqlserver" else ORACLE_CATALOG
    owner = table.schema.replace("'", "''")
    return {name: read_query(spark, table, text.format(owner=owner)) for name, text in queries.items()}
