"""Proof that a copy equals its source: counts and order-free fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rangehaul.functions.hashing import md5_number, portable_text, row_hash, wide_sum


def table_checksum(df: DataFrame) -> DataFrame:
    """Rows and the sum of 64-bit row hashes over all columns, in one pass without a row shuffle."""
    return df.select(row_hash(df).alias("_hash")).agg(
        F.count("*").alias("rows"), wide_sum(F.col("_hash")).alias("checksum")
    )


def portable_fingerprint(df: DataFrame, columns: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """The fingerprint in a form any SQL engine can repeat (MD5 instead of xxhash64)."""
    hashed = df.select(*by, md5_number(portable_text(list(columns))).alias("_hash"))
    return hashed.groupBy(*by).agg(F.count("*").alias("rows"), wide_sum(F.col("_hash")).alias("checksum"))


def range_fingerprints(df: DataFrame, chunk: str = "chunk", columns: Sequence[str] | None = None) -> DataFrame:
    """Rows and fingerprint of each range."""
    values = [c for c in (columns or df.columns) if c != chunk]
    hashed = df.select(F.col(chunk), row_hash(df, values).alias("_hash"))
    return hashed.groupBy(chunk).agg(F.count("*").alias("rows"), wide_sum(F.col("_hash")).alias("checksum"))


def compare_fingerprints(source: DataFrame, target: DataFrame, by: Sequence[str] = ("chunk",)) -> DataFrame:
    """Source and target fingerprints side by side with a status per range; all rows are kept."""
    left = source.select(*by, F.col("rows").alias("source_rows"), F.col("checksum").alias("source_checksum"))
    right = target.select(*by, F.col("rows").alias("target_rows"), F.col("checksum").alias("target_checksum"))
    zero = F.lit(0).cast("bigint")
    status = (
        F.when(F.col("target_rows").isNull(), F.lit("missing"))
        .when(F.col("source_rows").isNull(), F.lit("unexpected"))
        .when(F.col("source_rows") != F.col("target_rows"), F.lit("count"))
        .when(F.col("source_checksum") != F.col("target_checksum"), F.lit("content"))
        .otherwise(F.lit("equal"))
    )
    return left.join(right, list(by), "full_outer").select(
        *by,
        F.coalesce("source_rows", zero).alias("source_rows"),
        F.coalesce("target_rows", zero).alias("target_rows"),
        "source_checksum",
        "target_checksum",
        status.alias("status"),
    )


def reconcile_ranges(source: DataFrame, target: DataFrame, chunk: str = "chunk") -> DataFrame:
    """Per-range reconciliation: both sides are reduced to one row per range before they meet."""
    shared = [c for c in source.columns if c in set(target.columns)]
    return compare_fingerprints(
        range_fingerprints(source, chunk, shared), range_fingerprints(target, chunk, shared), [chunk]
    )


def reconcile_counts(source: DataFrame, written: DataFrame, readback: DataFrame, by: Sequence[str] = ("table",), strict: bool = True) -> DataFrame:
    """Counts of source, write and read-back per table. Each input is (by…, rows).

    With `strict=False` a source that moves during the copy does not fail the check.
    """
    zero = F.lit(0).cast("bigint")
    side = lambda df, name: df.select(*by, F.col("rows").cast("bigint").alias(name))
    joined = (
        side(source, "source_rows")
        .join(side(written, "written_rows"), list(by), "full_outer")
        .join(side(readback, "readback_rows"), list(by), "full_outer")
        .na.fill(0, ["source_rows", "written_rows", "readback_rows"])
    )
    same = F.col("written_rows") == F.col("readback_rows")
    if strict:
        same = same & (F.col("source_rows") == F.col("readback_rows"))
    return joined.withColumn("status", F.when(same, F.lit("equal")).otherwise(F.lit("different")))


def manifest_totals(manifests: DataFrame, snapshot_counts: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Rows promised by the manifests against rows in the snapshot, per run."""
    promised = manifests.groupBy(*by).agg(F.sum("rows").cast("bigint").alias("manifest_rows"))
    found = snapshot_counts.select(*by, F.col("rows").cast("bigint").alias("snapshot_rows"))
    return (
        promised.join(found, list(by), "full_outer")
        .na.fill(0, ["manifest_rows", "snapshot_rows"])
        .withColumn("equal", F.col("manifest_rows") == F.col("snapshot_rows"))
    )
