"""Rows in which a copy differs from its source, found by fingerprints of ever smaller key ranges."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rangehaul.functions.hashing import row_hash, wide_sum
from rangehaul.session import scratch_path

# Ranges that a differing one is cut into (as a power of two), rows at which single keys are compared, spans pushed to a scan (as a power of two).
FANOUT_BITS = 8
LEAF_ROWS = 4096
SPAN_BITS = 5
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _sided(rows: DataFrame, by: str) -> DataFrame:
    """Rows and fingerprint of both sides for each group that differs."""
    left, right = F.col("_copy") == F.lit(False), F.col("_copy")
    sums = rows.groupBy(by).agg(
        F.count_if(left).alias("source_rows"),
        F.count_if(right).alias("target_rows"),
        wide_sum(F.when(left, F.col("_hash"))).alias("source_checksum"),
        wide_sum(F.when(right, F.col("_hash"))).alias("target_checksum"),
    )
    return sums.where((F.col("source_rows") != F.col("target_rows")) | (F.col("source_checksum") != F.col("target_checksum")))


def _near(key: Column, spans: Sequence[tuple[int, int]]) -> Column:
    """Keys inside the spans; rows without a key stay as well."""
    return reduce(Column.__or__, [key.between(low, high) for low, high in spans], key.isNull())


def differing_rows(source: DataFrame, target: DataFrame, key: str, columns: Sequence[str] | None = None, fanout_bits: int = FANOUT_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Keys whose rows differ: (key, source_rows, target_rows, status).

    Status is `missing` (in the source only), `unexpected` (in the target only), `count` or `content`. Both sides are
    fingerprinted by range; only ranges that differ are cut again, into 2**`fanout_bits` parts, until none holds more than
    `leaf_rows` rows, and then compared by key. Ranges are equal leading bits of the key, so their number per round follows
    the differences. Whole-number keys: spans of differing ranges reach the scan, so equal ranges are read once. Other keys are
    cut by their hash, and every round scans again.

    - columns that both sides have are compared (or those named); their types must be the same;
    - rows without a key are compared as one group; repeated keys are compared as bags of rows;
    - equal or empty tables give an empty result.
    """
    spark = source.sparkSession
    shared = [c for c in (columns or source.columns) if c in target.columns]
    if other := [c for c in {key, *shared} if source.schema[c].dataType != target.schema[c].dataType]:
        raise ValueError(f"types differ: {sorted(other)}")
    name = F.col("`" + key.replace("`", "``") + "`")
    whole = isinstance(source.schema[key].dataType, _WHOLE)
    low, high = _LEAST, _MOST
    if whole:
        ends = source.select(name.alias("k")).unionByName(target.select(name.alias("k"))).agg(F.min("k"), F.max("k")).first()
        low, high = (0, 0) if ends[0] is None else ends

    def rows(spans: Sequence[tuple[int, int]] | None, ranges: DataFrame | None, shift: int) -> DataFrame:
        at = F.coalesce(name.cast("bigint"), F.lit(low).cast("bigint")) if whole else F.xxhash64(name)
        sides = [
            (df.where(_near(name, spans)) if spans else df).select(name.alias("_key"), at.alias("_at"), row_hash(df, shared).alias("_hash"), F.lit(copy).alias("_copy"))
            for copy, df in ((False, source), (True, target))
        ]
        both = sides[0].unionByName(sides[1]).withColumn("_range", F.shiftright("_at", shift))
        return both.join(ranges.select("_range"), "_range", "left_semi") if ranges is not None else both

    shift = max(0, (high - low).bit_length() - fanout_bits)
    found = rows(None, None, shift)
    while True:
        path = scratch_path(spark, "differing")
        # Written, so that the next round does not read this round's ranges again.
        _sided(found, "_range").write.parquet(path)
        differing = spark.read.parquet(path)
        top = differing.agg(F.max(F.greatest("source_rows", "target_rows")).alias("rows"), F.min("_range").alias("low"), F.max("_range").alias("high")).first()
        spans = None
        if whole and top["rows"] is not None:
            cell = F.shiftright("_range", max(0, (top["high"] - top["low"]).bit_length() - SPAN_BITS))
            # At most 33 rows.
            cells = differing.groupBy(cell.alias("cell")).agg(F.min("_range").alias("low"), F.max("_range").alias("high")).collect()
            spans = sorted((max(_LEAST, c["low"] << shift), min(_MOST, (c["high"] + 1 << shift) - 1)) for c in cells)
        found = rows(spans, differing, shift)
        if shift == 0 or (top["rows"] or 0) <= leaf_rows:
            break
        shift = max(0, shift - fanout_bits)
        found = found.withColumn("_range", F.shiftright("_at", shift))
    status = (
        F.when(F.col("target_rows") == 0, "missing").when(F.col("source_rows") == 0, "unexpected")
        .when(F.col("source_rows") != F.col("target_rows"), "count").otherwise("content")
    )
    return _sided(found, "_key").select(F.col("_key").alias(key), "source_rows", "target_rows", status.alias("status"))
