"""A table as it was at a boundary shared by all ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rangehaul.operators.manifests import first_per_key


def snapshot_as_of(df: DataFrame, boundary: Column, keys: Sequence[str], ts: str = "ts", tie: str | None = None) -> DataFrame:
    """Latest version of each key at or before the boundary; the boundary filter reaches the scan."""
    order = [F.col(ts).desc()] + ([F.col(tie).desc()] if tie else [])
    return first_per_key(df.filter(F.col(ts) <= boundary), keys, *order)
