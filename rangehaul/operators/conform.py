"""Typed projections and schema conformity."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rangehaul.functions.literals import quoted_name
from rangehaul.functions.types import (
    NUMERIC_TYPES,
    SourceColumn,
    UnsupportedType,
    oracle_type,
    source_schema,
    sqlserver_type,
    unified_schema,
)


def _c(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def source_projection(columns: Sequence[SourceColumn], source: str = "sqlserver") -> str:
    """Select list for the source query, with the casts that the source has to do itself."""
    parts = []
    for column in columns:
        name = quoted_name(column.name, source)
        if source == "sqlserver":
            expression = sqlserver_type(column)[1].format(c=name)
        else:
            oracle_type(column)
            # A zoned timestamp would lose its zone on the way: bring it to UTC at the source.
            zoned = "TIME ZONE" in column.sql_type.upper()
            expression = f"CAST(SYS_EXTRACT_UTC({name}) AS TIMESTAMP)" if zoned else name
        parts.append(name if expression == name else f"{expression} AS {name}")
    return ", ".join(parts)


def typed_projection(df: DataFrame, columns: Sequence[SourceColumn], source: str = "sqlserver") -> DataFrame:
    """Select the declared columns with the Spark types of their source types.

    An unsupported type fails here, before anything is read; a value that does not fit fails the task.
    """
    schema = source_schema(list(columns), source)
    return df.select(*[_cast(_c(f.name), df.schema[f.name].dataType, f.dataType).alias(f.name) for f in schema])


def _cast(value: Column, current: T.DataType, wanted: T.DataType) -> Column:
    return value if current == wanted else value.cast(wanted)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring a frame to a schema: columns in order, missing ones NULL, other types cast."""
    present = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (_cast(_c(f.name), present[f.name], f.dataType) if f.name in present else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def unify_union(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of frames whose schemas differ, with the widest type per column."""
    schema = unified_schema([f.schema for f in frames])
    return reduce(DataFrame.unionAll, [conform(f, schema) for f in frames])


def schema_compat(file_schemas: DataFrame) -> DataFrame:
    """Per column: how many files have it, how many types occur, and whether one type holds for all.

    Input is one row per (path, column, type), as the footer reader gives it.
    """
    types = F.collect_set("type")
    return file_schemas.groupBy("column").agg(
        F.count("*").alias("files"), F.sort_array(types).alias("types"), (F.size(types) == 1).alias("same_type")
    )


def parse_keys(df: DataFrame, text: str = "text", sql_type: str = "sql_type") -> DataFrame:
    """Catalog text as typed key values, one column per key family; other rows stay NULL."""
    value, kind = F.col(text), F.lower(F.col(sql_type))
    day = F.substring_index(F.substring_index(value, "T", 1), " ", 1)
    moment = F.replace(value, F.lit("T"), F.lit(" "))
    return df.withColumns(
        {
            "numeric_key": F.when(kind.isin(*NUMERIC_TYPES), value.try_cast("decimal(38,6)")),
            "date_key": F.when(kind == "date", day.try_cast("date")),
            "datetime_key": F.when(
                kind.isin("datetime", "datetime2", "smalldatetime"), moment.try_cast("timestamp_ntz")
            ),
        }
    )
