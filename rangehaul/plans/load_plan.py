"""Load decisions for many tables in one job: a frame with one row per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rangehaul.functions.sizing import (
    ChunkLimits,
    FetchLimits,
    PartitionLimits,
    chunk_bytes,
    chunk_count,
    fetch_rows,
    partition_count,
)

# Reasons of the decisions.
FITS_ONE_TASK = "table fits one task, or the budget allows one range"
NO_KEY = "no indexed numeric or temporal key"
NO_SPLIT_POINT = "key has no usable split points"
BY_HISTOGRAM = "equi-depth ranges from the key histogram"
BY_BOUNDS = "even ranges between the smallest and largest key"
FEWER_RANGES = "heavy hitters or low cardinality reduced the number of ranges"


def size_plan(
    sizes: DataFrame,
    partitions: PartitionLimits = PartitionLimits(),
    chunks: ChunkLimits = ChunkLimits(),
    fetch: FetchLimits = FetchLimits(),
) -> DataFrame:
    """Partitions of a Spark read, durable chunks and fetch sizes from (table, rows, bytes)."""
    rows, size = F.col("rows"), F.col("bytes")
    return (
        sizes.withColumn("partitions", partition_count(size, partitions))
        .withColumn("chunks", chunk_count(rows, size, chunks))
        .withColumn("chunk_bytes", chunk_bytes(size, F.col("chunks"), chunks))
        .withColumn("partition_fetch_rows", fetch_rows(rows, size, F.col("partitions"), fetch))
        .withColumn("chunk_fetch_rows", fetch_rows(rows, size, F.col("chunks"), fetch))
    )


def load_strategy(
    sizes: DataFrame,
    keys: DataFrame,
    histogram_points: DataFrame,
    even_points: DataFrame,
    requested: Column,
    max_parallel: int = 8,
) -> DataFrame:
    """Strategy per table with its reason and warning.

    sizes(table, rows, bytes), keys(table, column), and the boundaries found by histogram and by
    bounds, each as (table, boundary). Histogram ranges go before even ranges, a single scan is last.
    """
    count = lambda points, name: points.groupBy("table").agg(F.count("*").alias(name))
    zero = F.lit(0).cast("bigint")
    joined = (
        sizes.select("table", "rows", "bytes")
        .withColumn("requested", requested.cast("bigint"))
        .join(keys.select("table", "column"), "table", "left")
        .join(count(histogram_points, "_by_histogram"), "table", "left")
        .join(count(even_points, "_by_bounds"), "table", "left")
    )
    by_histogram = F.coalesce(F.col("_by_histogram"), zero)
    by_bounds = F.coalesce(F.col("_by_bounds"), zero)
    alone = (F.col("requested") <= 1) | F.col("column").isNull()
    points = F.when(alone, zero).when(by_histogram > 0, by_histogram).otherwise(by_bounds)
    strategy = (
        F.when(alone | (points == 0), "single_scan").when(by_histogram > 0, "histogram_ranges").otherwise("indexed_ranges")
    )
    reason = (
        F.when(F.col("requested") <= 1, FITS_ONE_TASK)
        .when(F.col("column").isNull(), NO_KEY)
        .when(points == 0, NO_SPLIT_POINT)
        .when(by_histogram > 0, BY_HISTOGRAM)
        .otherwise(BY_BOUNDS)
    )
    return joined.select(
        "table",
        F.when(F.col("requested") > 1, F.col("column")).alias("column"),
        "rows",
        "bytes",
        "requested",
        (points + 1).alias("ranges"),
        F.least(points + 1, F.lit(max_parallel).cast("bigint")).alias("parallelism"),
        strategy.alias("strategy"),
        reason.alias("reason"),
        F.when((points > 0) & (points + 1 < F.col("requested")), F.lit(FEWER_RANGES)).alias("warning"),
    )
