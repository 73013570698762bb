"""A point between two key values, typed as the key."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

_RATIO_UNITS = 10**17


def _ratio(ratio: Column) -> Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), ratio.cast("double")))


def _whole(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _integer_point(low: Column, high: Column, ratio: Column, up: bool) -> Column:
    """low + (high - low) * ratio in whole numbers, without leaving 38 digits.

    The span is split into quotient and remainder of 10^17, so that no product is longer
    than the span itself; `up` rounds towards the high end.
    """
    units = F.lit(_RATIO_UNITS).cast("decimal(18,0)")
    share = (ratio.cast("string").cast("decimal(18,17)") * units).cast("decimal(18,0)")
    span = _whole(high) - _whole(low)
    rest = _whole(span % units)
    parts = _whole((_whole(span) - rest) / units)
    product = _whole(rest * share)
    remainder = _whole(product % units)
    tail = _whole((product - remainder) / units)
    point = _whole(low) + _whole(parts * share) + tail
    if up:
        point = point + F.when(remainder > 0, F.lit(1)).otherwise(F.lit(0)).cast("decimal(1,0)")
    return _whole(point)


def _units(value: Column) -> Column:
    """A decimal in units of its last digit."""
    return F.replace(value.cast("string"), F.lit("."), F.lit("")).cast("decimal(38,0)")


def _from_units(units: Column, dtype: T.DecimalType) -> Column:
    digits = F.abs(units).cast("string")
    digits = F.lpad(digits, F.greatest(F.length(digits), F.lit(dtype.scale + 1)), F.lit("0"))
    whole = F.concat(F.substring(digits, F.lit(1), F.length(digits) - dtype.scale), F.lit("."), F.right(digits, F.lit(dtype.scale)))
    return F.when(units < 0, F.concat(F.lit("-"), whole)).otherwise(whole).cast(dtype)


def interpolate(low: Column, high: Column, ratio: Column, dtype: T.DataType) -> Column:
    """Integers round up, decimals are rounded to the column's scale, dates to whole days and
    timestamps to microseconds. The ratio is held inside [0, 1]."""
    share = _ratio(ratio)
    if isinstance(dtype, T.DateType):
        return F.date_add(low, F.rint(F.datediff(high, low) * share).cast("int"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        micros = F.timestamp_diff("MICROSECOND", low, high)
        return F.timestamp_add("MICROSECOND", F.rint(micros * share).cast("bigint"), low)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (low + (high - low) * share).cast(dtype)
    if isinstance(dtype, T.DecimalType) and dtype.scale > 0:
        if dtype.precision <= 18:
            exact = share.cast("string").cast("decimal(18,17)")
            return F.bround(low + (high - low) * exact, dtype.scale).cast(dtype)
        # Long decimals: exact in units of the last digit, where 38 digits leave no room for a product.
        return _from_units(_integer_point(_units(low), _units(high), share, up=False), dtype)
    return _integer_point(low, high, share, up=not isinstance(dtype, T.DecimalType)).cast(dtype)
