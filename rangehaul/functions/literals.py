"""Identifier quoting and typed literals for range predicates, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F, types as T


@dataclass(frozen=True)
class Dialect:
    """How a source database writes names and temporal constants."""

    opening: str
    closing: str
    date: str
    timestamp: str
    timestamp_pattern: str


# The quoting and literal syntax of each source.
DIALECTS = {
    "sqlserver": Dialect("[", "]", "CAST('%s' AS date)", "CAST('%s' AS datetime2)", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
    "oracle": Dialect('"', '"', "DATE '%s'", "TIMESTAMP '%s'", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    "ansi": Dialect('"', '"', "DATE '%s'", "TIMESTAMP '%s'", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    "spark": Dialect("`", "`", "DATE '%s'", "TIMESTAMP_NTZ '%s'", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
}


def quoted(name: Column, dialect: str = "spark") -> Column:
    """Quote identifiers held in a column; a closing mark inside a name is doubled."""
    marks = DIALECTS[dialect]
    doubled = F.replace(name, F.lit(marks.closing), F.lit(marks.closing * 2))
    return F.concat(F.lit(marks.opening), doubled, F.lit(marks.closing))


def quoted_name(name: str, dialect: str = "spark") -> str:
    """The same rule for a name the job already holds."""
    marks = DIALECTS[dialect]
    return f"{marks.opening}{name.replace(marks.closing, marks.closing * 2)}{marks.closing}"


def literal(value: Column, dtype: T.DataType, dialect: str = "spark") -> Column:
    """Text of a key value as a typed literal of the dialect (no session date format involved)."""
    marks = DIALECTS[dialect]
    if isinstance(dtype, T.DateType):
        return F.format_string(marks.date, F.date_format(value, "yyyy-MM-dd"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.format_string(marks.timestamp, F.date_format(value, marks.timestamp_pattern))
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # The shortest text that reads back as the same double: predicate, ledger and assignment share one boundary.
        text = value.cast("double").cast("string")
        return F.when(F.contains(text, F.lit("E")), text).otherwise(F.concat(text, F.lit("E0")))
    return value.cast("string")


def constant_array(values: Sequence, dtype: T.DataType) -> Column:
    """Key values as one constant array of the key's type, folded once: the same values as in single comparisons."""
    return F.array(*[F.lit(v).cast(dtype) for v in values])
