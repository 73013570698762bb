"""What a database knows about one table: query texts by dialect, and their rows as the frames that planning takes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rangehaul.functions.literals import quoted_name
from rangehaul.functions.types import TEMPORAL_TYPES, SourceColumn
from rangehaul.operators.profile import discover_columns, discover_columns_oracle, table_size, table_size_fallback, table_size_greatest
from rangehaul.sources.jdbc import ORACLE_CATALOG, SQLSERVER_CATALOG, JdbcTable, read_query

Query = Callable[[str], DataFrame]


class TableNotFound(ValueError):
    """The table does not exist, or this user may not see it."""


def text_of(value: str, national: bool = False) -> str:
    """A text constant; a quote inside is doubled."""
    return ("N'" if national else "'") + value.replace("'", "''") + "'"


# --- SQL Server ----------------------------------------------------------------------


def object_query(table: JdbcTable) -> str:
    return f"SELECT OBJECT_ID({text_of(table.qualified, True)}, 'U') AS object_id"


def of_object(view: str, object_id: int) -> str:
    """A catalog view for one table; `types` belongs to all of them."""
    query = SQLSERVER_CATALOG[view]
    if view == "types":
        return query
    return f"{query} {'AND' if ' WHERE ' in query else 'WHERE'} object_id = {int(object_id)}"


def _as_text(expression: str, sql_type: str) -> str:
    """A key as text that reads back as the same value: style 126 for times, 3 for floating numbers, 2 for money."""
    if sql_type in TEMPORAL_TYPES:
        return f"CONVERT(nvarchar(128), CAST({expression} AS datetime2), 126)"
    # Conversion styles.
    style = {"float": ", 3", "real": ", 3", "money": ", 2", "smallmoney": ", 2"}.get(sql_type, "")
    return f"CONVERT(nvarchar(128), {expression}{style})"


def histogram_query(object_id: int, stats_id: int, sql_type: str) -> str:
    """Steps of a statistic in key order; the step without a key counts the NULL rows."""
    return (
        f"SELECT step_number, {_as_text('range_high_key', sql_type)} AS high, range_rows, equal_rows "
        f"FROM sys.dm_db_stats_histogram({int(object_id)}, {int(stats_id)})"
    )


def bounds_query(table: JdbcTable, column: SourceColumn) -> str:
    """Smallest and largest key as text: two seeks in the index on SQL Server, one min/max at the snapshot elsewhere."""
    name = quoted_name(column.name, table.dialect)
    if table.dialect != "sqlserver":
        return f"SELECT MIN({name}) AS \"low\", MAX({name}) AS \"high\" FROM {table.relation()}"
    seek = lambda order: f"(SELECT TOP (1) {_as_text(name, column.sql_type)} FROM {table.qualified} WHERE {name} IS NOT NULL ORDER BY {name} {order})"
    return f"SELECT {seek('ASC')} AS low, {seek('DESC')} AS high"


def count_query(table: JdbcTable) -> str:
    """All rows of the table, at its snapshot where it has one."""
    function = "COUNT_BIG" if table.dialect == "sqlserver" else "COUNT"
    return f'SELECT {function}(*) AS "exact_rows" FROM {table.relation()}'


# --- Oracle --------------------------------------------------------------------------


# Fixed value: the system change number that all queries of a load share.
SNAPSHOT_QUERY = 'SELECT DBMS_FLASHBACK.GET_SYSTEM_CHANGE_NUMBER AS "scn" FROM dual'


def of_name(view: str, table: JdbcTable) -> str:
    """An Oracle catalog view for one table of one owner."""
    query = ORACLE_CATALOG[view].format(owner=table.schema.replace("'", "''"))
    return f"{query} AND table_name = {text_of(table.table)}"


# --- frames --------------------------------------------------------------------------


def key_type(sql_type: str, precision: int | None, scale: int | None) -> T.DataType:
    """The Spark type in which keys of a source type are compared and cut."""
    # Money has four decimals.
    fixed = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "bigint": "bigint", "float": "double", "real": "double",
             "money": "decimal(19,4)", "smallmoney": "decimal(10,4)", "date": "date"}
    if sql_type in fixed:
        return T.DataType.fromDDL(fixed[sql_type])
    if sql_type in ("decimal", "numeric"):
        return T.DecimalType(precision, scale or 0) if precision else T.DecimalType(38, 10)
    if sql_type in TEMPORAL_TYPES:
        return T.TimestampNTZType()
    raise ValueError(f"{sql_type} is no key type")


def _typed(column: str, dtype: T.DataType):
    text = F.trim(F.col(column).cast("string"))
    # Date keys come as the start of their day.
    return (F.substring(text, 1, 10) if isinstance(dtype, T.DateType) else text).cast(dtype)


def typed_steps(steps: DataFrame, dtype: T.DataType) -> DataFrame:
    """Histogram steps with `high` as a key instead of text, and counts as numbers.

    A text that is no value of the type is an error; the step without a key is kept for its NULL rows. Times may have more digits than
    microseconds and are cut.
    """
    return steps.select(_typed("high", dtype).alias("high"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ("range_rows", "equal_rows")])


def typed_bounds(bounds: DataFrame, dtype: T.DataType) -> DataFrame:
    """Smallest and largest key, typed likewise; none for a table without keys."""
    return bounds.select(*[_typed(c, dtype).alias(c) for c in ("low", "high")]).filter("low IS NOT NULL")


@dataclass(frozen=True)
class TableCatalog:
    """A resolved table: the snapshot it is read at, its profile, its estimated size, and what could not be had."""

    table: JdbcTable
    object_id: int | None
    profile: DataFrame
    sizes: DataFrame
    columns: tuple[SourceColumn, ...]
    warnings: tuple[str, ...]


def _booleans(frame: DataFrame, *names: str) -> DataFrame:
    return frame.withColumns({n: F.col(n).cast("boolean") for n in names})


def _sqlserver(table: JdbcTable, query: Query) -> TableCatalog:
    found = query(object_query(table)).first()
    if found is None or found[0] is None:
        raise TableNotFound(f"no such table, or not visible: {table.qualified}")
    object_id = int(found[0])
    view = {name: query(of_object(name, object_id)) for name in ("columns", "types", "indexes", "index_columns", "stats", "stats_columns")}
    profile = discover_columns(
        _booleans(view["columns"], "nullable"), view["types"], _booleans(view["indexes"], "is_unique", "primary_key", "disabled", "hypothetical", "filtered"),
        view["index_columns"], _booleans(view["stats"], "filtered"), view["stats_columns"],
    )
    tables = view["columns"].select("table").distinct()
    warnings = []
    try:
        sizes = table_size(tables, query(of_object("partition_stats", object_id))).select("table", "rows", "bytes")
        sizes.first()
    except Exception as error:  # whatever the driver says when page counts may not be read
        warnings.append(f"page counts not visible, bytes from row count and column widths: {type(error).__name__}")
        sizes = table_size_fallback(tables, query(of_object("partitions", object_id)), view["columns"]).select("table", "rows", "bytes")
    return TableCatalog(table, object_id, profile, sizes, (), tuple(warnings))


def _oracle(table: JdbcTable, query: Query) -> TableCatalog:
    if table.snapshot is None:
        table = replace(table, snapshot=int(query(SNAPSHOT_QUERY).first()[0]))
    view = {name: query(of_name(name, table)) for name in ORACLE_CATALOG}
    known = view["tables"].first()
    if known is None:
        raise TableNotFound(f"no such table, or not visible: {table.qualified}")
    profile = discover_columns_oracle(view["columns"], view["indexes"], view["index_columns"], view["constraints"])
    warnings, exact = [], None
    if known["num_rows"] is None:
        warnings.append("no table statistics: rows were counted")
        exact = query(count_query(table)).select(F.lit(known["table"]).alias("table"), F.col("exact_rows").cast("bigint").alias("exact_rows"))
    sizes = table_size_greatest(view["tables"], view["columns"], exact).select("table", "rows", "bytes")
    return TableCatalog(table, None, profile, sizes, (), tuple(warnings))


def resolve(spark: SparkSession, table: JdbcTable, query: Query | None = None) -> TableCatalog:
    """Everything planning needs about one table, found by its name. Only this table's catalog rows are read.

    `query` runs a query text on the source; it is a JDBC read unless something stands in for the database.
    """
    run = query or (lambda text: read_query(spark, table, text))
    found = {"sqlserver": _sqlserver, "oracle": _oracle}[table.dialect](table, run)
    # One row per column of the table.
    rows = found.profile.orderBy("column_id").collect()
    frame = spark.createDataFrame(rows, found.profile.schema).coalesce(1)
    columns = tuple(SourceColumn(r["column"], r["sql_type"], r["precision"], r["scale"], bool(r["nullable"])) for r in rows)
    if table.dialect == "oracle":
        # The neutral type plans; the source's own type chooses the Spark type of the column.
        kinds = {r["column"]: r for r in run(of_name("columns", found.table)).collect()}
        columns = tuple(replace(c, sql_type=kinds[c.name]["data_type"], precision=kinds[c.name]["precision"], scale=kinds[c.name]["scale"]) for c in columns)
    return replace(found, profile=frame, columns=columns)
