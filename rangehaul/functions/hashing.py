"""Row hashes and order-free table fingerprints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _hashable(field: T.StructField) -> Column:
    """A value xxhash64 takes, with nested NULLs kept apart: arrays, structs and maps are written as JSON, maps in order of their entries."""
    value = F.col(_name(field.name))
    if isinstance(field.dataType, T.MapType):
        value = F.array_sort(F.map_entries(value))
    if isinstance(field.dataType, (T.MapType, T.ArrayType, T.StructType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    return value


_MASK_BITS = 60


def _null_mask(fields: list[T.StructField]) -> Column:
    bits = [
        F.when(F.col(_name(f.name)).isNull(), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
        for i, f in enumerate(fields)
    ]
    return reduce(Column.bitwiseOR, bits)


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """64-bit hash of a row in which NULLs keep their place.

    xxhash64 steps over NULL arguments, so (NULL, 1) and (1, NULL) would meet; the positions of
    the NULLs are therefore hashed with the values, as bit masks.
    """
    chosen = [f for f in df.schema.fields if columns is None or f.name in columns]
    if not chosen:
        return F.lit(0).cast("bigint")
    masks = [_null_mask(chosen[i : i + _MASK_BITS]) for i in range(0, len(chosen), _MASK_BITS)]
    return F.xxhash64(*[_hashable(f) for f in chosen], *masks)


def wide_sum(value: Column) -> Column:
    """Exact sum of bigints as decimal(38,0) from four long sums.

    The 16-bit pieces stay in whole-stage codegen and cannot overflow below 2^47 rows, which
    a direct decimal(38,0) sum pays for with a big-number addition per row.
    """
    mask = F.lit(0xFFFF).cast("bigint")
    total = F.sum(F.shiftright(value, 48)).cast("decimal(38,0)") * F.lit(1 << 48).cast("decimal(15,0)")
    for shift in (32, 16, 0):
        piece = F.shiftright(value, shift).bitwiseAND(mask)
        unit = F.lit(1 << shift).cast("decimal(15,0)")
        total = total.cast("decimal(38,0)") + (F.sum(piece).cast("decimal(38,0)") * unit).cast("decimal(38,0)")
    return F.coalesce(total.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))


def md5_number(text: Column) -> Column:
    """The first 60 bits of an MD5 as a bigint, reproducible in any SQL engine."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def portable_text(columns: list[Column]) -> Column:
    """Columns as one text; NULL is marked apart from an empty string."""
    return F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("\\N")) for c in columns])


def request_hash(document: Column) -> Column:
    """SHA-256 of a canonical JSON text."""
    return F.sha2(document, 256)
