"""Source type rules: which Spark type a source column becomes and how the source writes it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T

# Type families the planner can split on.
INTEGER_TYPES = ("tinyint", "smallint", "int", "bigint")
NUMERIC_TYPES = INTEGER_TYPES + ("decimal", "numeric", "money", "smallmoney", "float", "real")
TEMPORAL_TYPES = ("date", "datetime", "datetime2", "smalldatetime")

# SQL Server type -> (Spark type, expression in the source query).
# `{c}` is the quoted column, `{p}` and `{s}` precision and scale.
SQLSERVER_RULES = {
    "bigint": ("bigint", "{c}"),
    "int": ("int", "{c}"),
    "smallint": ("smallint", "{c}"),
    "tinyint": ("smallint", "CAST({c} AS smallint)"),
    "decimal": ("decimal({p},{s})", "{c}"),
    "numeric": ("decimal({p},{s})", "{c}"),
    "money": ("decimal(19,4)", "{c}"),
    "smallmoney": ("decimal(10,4)", "{c}"),
    "float": ("double", "{c}"),
    "real": ("float", "{c}"),
    "bit": ("boolean", "{c}"),
    "char": ("string", "{c}"),
    "varchar": ("string", "{c}"),
    "nchar": ("string", "{c}"),
    "nvarchar": ("string", "{c}"),
    "xml": ("string", "{c}"),
    "uniqueidentifier": ("string", "{c}"),
    "text": ("string", "CAST({c} AS nvarchar(max))"),
    "ntext": ("string", "CAST({c} AS nvarchar(max))"),
    "binary": ("binary", "{c}"),
    "varbinary": ("binary", "{c}"),
    "timestamp": ("binary", "{c}"),
    "rowversion": ("binary", "{c}"),
    "image": ("binary", "CAST({c} AS varbinary(max))"),
    "date": ("date", "{c}"),
    "datetime": ("timestamp_ntz", "{c}"),
    "datetime2": ("timestamp_ntz", "{c}"),
    "smalldatetime": ("timestamp_ntz", "{c}"),
    "datetimeoffset": ("timestamp", "{c}"),
    "time": ("string", "CONVERT(nvarchar(32), {c})"),
}

# Oracle types other than NUMBER and TIMESTAMP -> Spark type.
ORACLE_RULES = {
    "BINARY_FLOAT": "float",
    "BINARY_DOUBLE": "double",
    "FLOAT": "double",
    "VARCHAR2": "string",
    "NVARCHAR2": "string",
    "CHAR": "string",
    "NCHAR": "string",
    "CLOB": "string",
    "NCLOB": "string",
    "LONG": "string",
    "RAW": "binary",
    "BLOB": "binary",
    "LONG RAW": "binary",
    "DATE": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


@dataclass(frozen=True)
class SourceColumn:
    """A column as the source catalog declares it."""

    name: str
    sql_type: str
    precision: int | None = None
    scale: int | None = None
    nullable: bool = True


class UnsupportedType(ValueError):
    """Raised before any read, naming the column and its type."""


def sqlserver_type(column: SourceColumn) -> tuple[str, str]:
    """Spark type and source expression template of a SQL Server column."""
    rule = SQLSERVER_RULES.get(column.sql_type.lower())
    if rule is None:
        raise UnsupportedType(f"column {column.name!r}: SQL Server type {column.sql_type!r} has no Spark type")
    return rule[0].format(p=column.precision, s=column.scale or 0), rule[1]


def oracle_type(column: SourceColumn, long_decimals_as_text: bool = False) -> str:
    """Spark type of an Oracle column. Decimals over 38 digits fail unless read as text."""
    name = column.sql_type.upper()
    if name == "NUMBER":
        if column.precision is None:
            return "double"
        scale = column.scale or 0
        if scale == 0 and column.precision <= 18:
            return "bigint"
        if column.precision <= 38:
            return f"decimal({column.precision},{scale})"
        if long_decimals_as_text:
            return "string"
        raise UnsupportedType(f"column {column.name!r}: NUMBER({column.precision}) has no Spark decimal")
    if name.startswith("TIMESTAMP"):
        return "timestamp_ntz"
    if name not in ORACLE_RULES:
        raise UnsupportedType(f"column {column.name!r}: Oracle type {column.sql_type!r} has no Spark type")
    return ORACLE_RULES[name]


def planner_type(oracle_name: str, precision: int | None, scale: int | None) -> str:
    """Oracle catalog type as one of the planner's neutral types."""
    name = oracle_name.upper()
    if name == "NUMBER":
        digits = 39 if precision is None else precision
        if (scale or 0) > 0 or digits > 18:
            return "decimal"
        return "int" if digits <= 9 else "bigint"
    if name in ("FLOAT", "BINARY_FLOAT", "BINARY_DOUBLE"):
        return "float"
    if name == "DATE" or name.startswith("TIMESTAMP"):
        return "datetime2"
    return name.lower()


def planner_type_of(name: Column, precision: Column, scale: Column) -> Column:
    """`planner_type` for catalog rows."""
    upper = F.upper(name)
    digits = F.coalesce(precision, F.lit(39))
    number = (
        F.when((F.coalesce(scale, F.lit(0)) > 0) | (digits > 18), "decimal").when(digits <= 9, "int").otherwise("bigint")
    )
    return (
        F.when(upper == "NUMBER", number)
        .when(upper.isin("FLOAT", "BINARY_FLOAT", "BINARY_DOUBLE"), "float")
        .when((upper == "DATE") | upper.startswith("TIMESTAMP"), "datetime2")
        .otherwise(F.lower(name))
    )


def source_schema(columns: list[SourceColumn], source: str = "sqlserver") -> T.StructType:
    """Spark schema of a source table."""
    pick = (lambda c: sqlserver_type(c)[0]) if source == "sqlserver" else oracle_type
    return T.StructType(
        [T.StructField(c.name, T.DataType.fromDDL(pick(c)), c.nullable) for c in columns]
    )


# Whole-number and floating types from narrow to wide, and the digits they hold.
_WHOLE = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 20}
_FLOATING = ("float", "double")


def wider_type(left: T.DataType, right: T.DataType) -> T.DataType:
    """The narrowest type that holds both, as a permissive schema union decides it."""
    a, b = left.simpleString(), right.simpleString()
    if a == b or b == "void":
        return left
    if a == "void":
        return right
    if a in _WHOLE and b in _WHOLE:
        return left if _WHOLE[a] >= _WHOLE[b] else right
    numeric = lambda t: t in _WHOLE or t in _FLOATING or t.startswith("decimal")
    if numeric(a) and numeric(b):
        if a in _FLOATING or b in _FLOATING:
            return T.FloatType() if a == b == "float" else T.DoubleType()
        digits = lambda t, k: (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_WHOLE[k], 0)
        (left_whole, left_scale), (right_whole, right_scale) = digits(left, a), digits(right, b)
        scale = max(left_scale, right_scale)
        precision = max(left_whole, right_whole) + scale
        if precision > 38:
            raise UnsupportedType(f"no decimal of 38 digits holds both {a} and {b}")
        return T.DecimalType(precision, scale)
    if {a, b} == {"date", "timestamp_ntz"}:
        return T.TimestampNTZType()
    if {a, b} == {"date", "timestamp"}:
        return T.TimestampType()
    raise UnsupportedType(f"no common type for {a} and {b}")


def unified_schema(schemas: list[T.StructType]) -> T.StructType:
    """Widest type per column over all schemas; columns keep the order of first appearance."""
    merged: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            known = merged.get(field.name)
            merged[field.name] = field.dataType if known is None else wider_type(known, field.dataType)
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in merged.items()])
