"""Range reads that open only the row groups which can hold the range.

The footers say between which keys each row group lies (a zone map, read in tasks). Every group is handed to the ranges it overlaps, as a
table in the shared folder with one part per range; the task of a range reads its own part, so neither paths nor zones pass the driver.
Inside an opened file, filters that Spark pushes down rule out further groups by the statistics of their columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rangehaul.operators.ranges import with_range_index
from rangehaul.session import scratch_path
from rangehaul.sources.arrow import read_arrow_ranges
from rangehaul.sources.tasks import zone_batches, zone_reader

# Ranges that open a row group, on average: beyond that the source is not laid out by the key.
MOST_OVERLAP = 4.0


class ZonesOverlap(ValueError):
    """Most ranges would open most row groups."""


def zone_maps(inventory: DataFrame, column: str, dtype: T.DataType, tasks: int | None = None) -> DataFrame:
    """(path, row_group, num_rows, bytes, nulls, low, high) from footers, read inside tasks.

    `low` and `high` are bounds of the key, not always values of it (long texts are cut). A group without statistics has NULL in both; a group of
    NULLs alone as well, then `nulls` equals `num_rows`. An unknown number of NULLs is NULL.
    """
    count = tasks or 4 * inventory.sparkSession.sparkContext.defaultParallelism
    key = T.StructType([T.StructField("key", dtype)])
    schema = T.StructType.fromDDL("path string, row_group int, num_rows bigint, bytes bigint, nulls bigint").add("low", dtype).add("high", dtype)
    read = zone_reader(column, to_arrow_schema(key).field("key").type)
    return inventory.select("path").repartition(count, "path").mapInArrow(read, schema)


def zones_of_ranges(zones: DataFrame, boundaries: Sequence) -> DataFrame:
    """One row per range (`chunk`) and row group that may hold a row of it, with the range's bounds `from` and `to`.

    NULL keys belong to the first range, NaN to the last; statistics do not show NaN, so a group of floating keys is in the last range too.
    Groups without rows are in none.
    """
    points = sorted(set(boundaries))
    dtype = zones.schema["low"].dataType
    placed = with_range_index(zones.filter("num_rows > 0"), F.col("low"), points, "_first", dtype)
    placed = with_range_index(placed, F.col("high"), points, "_last", dtype)
    last, none = F.lit(len(points)), F.array().cast("array<int>")
    unknown = (F.col("low").isNull() | F.col("high").isNull()) & ~F.coalesce(F.col("nulls") == F.col("num_rows"), F.lit(False))
    own = F.when(unknown, F.sequence(F.lit(0), last)).when(F.col("low").isNull(), none).otherwise(F.sequence("_first", "_last"))
    with_null = F.when(F.coalesce(F.col("nulls"), F.lit(1)) > 0, F.array(F.lit(0))).otherwise(none)
    with_nan = F.array(last) if isinstance(dtype, (T.FloatType, T.DoubleType)) else none
    ranges = placed.withColumn("chunk", F.explode(F.array_union(F.array_union(own, with_null), with_nan)))
    if not points:
        return ranges.select("chunk", "path", "row_group", F.lit(None).cast(dtype).alias("from"), F.lit(None).cast(dtype).alias("to"))
    edges = F.array(*[F.lit(p).cast(dtype) for p in points])
    edge = lambda at: F.get(edges, at)
    return ranges.select("chunk", "path", "row_group", F.when(F.col("chunk") > 0, edge(F.col("chunk") - 1)).alias("from"), edge(F.col("chunk")).alias("to"))


def write_zones(spark: SparkSession, inventory: DataFrame, column: str, boundaries: Sequence, dtype: T.DataType, most_overlap: float = MOST_OVERLAP) -> str:
    """The groups of every range as a table, one part per range, and its path.

    Raises `ZonesOverlap` where a row group would be opened by more than `most_overlap` ranges on average: such a source is loaded by files instead.
    """
    path = scratch_path(spark, "zones")
    ranges = zones_of_ranges(zone_maps(inventory, column, dtype), boundaries)
    ranges.repartition("chunk").write.partitionBy("chunk").parquet(path)
    seen = spark.read.schema(ranges.drop("chunk").schema).parquet(path).agg(F.count(F.lit(1)).alias("opened"), F.countDistinct("path", "row_group").alias("groups")).first()
    if seen["opened"] > most_overlap * max(1, seen["groups"]):
        raise ZonesOverlap(f"{seen['groups']} row groups would be opened {seen['opened']} times; load this source by files")
    return path


def read_zone_ranges(
    spark: SparkSession, path: str | Sequence[str] | DataFrame, schema: T.StructType, column: str, boundaries: Sequence,
    chunks: Sequence[int] | None = None, most_overlap: float = MOST_OVERLAP, batch_rows: int = 65_536,
) -> DataFrame:
    """Rows of Parquet files by ranges of a key: one partition per range (all, or those in `chunks`), each row once.

    `schema` chooses the columns; the key need not be among them, and then is taken as the files have it.
    """
    from rangehaul.sources.files import file_inventory

    inventory = path if isinstance(path, DataFrame) else file_inventory(spark, path)
    dtype = schema[column].dataType if column in schema.names else spark.read.parquet(inventory.first()["path"]).schema[column].dataType
    zones = write_zones(spark, inventory, column, boundaries, dtype, most_overlap)
    return zone_frame(spark, zones, schema, column, range(len(set(boundaries)) + 1) if chunks is None else chunks, batch_rows)


def zone_frame(spark: SparkSession, zones: str, schema: T.StructType, column: str, chunks: Sequence[int], batch_rows: int = 65_536) -> DataFrame:
    return read_arrow_ranges(
        spark, zone_batches, [str(k) for k in chunks], schema, pushdown=True, zones=zones, key=column, batch_rows=str(batch_rows)
    )


def zone_read(spark: SparkSession, path: str | Sequence[str] | DataFrame, schema: T.StructType, plan, most_overlap: float = MOST_OVERLAP) -> Callable[[Sequence[str]], DataFrame]:
    """The `read` of a load by ranges (`plans.ingest.ingest`) whose source is files laid out by the plan's key: nothing is shuffled,
    and a resumed run opens only the groups of the ranges it still lacks."""
    zones: list[str] = []

    def read(predicates: Sequence[str]) -> DataFrame:
        if not zones:
            from rangehaul.sources.files import file_inventory

            inventory = path if isinstance(path, DataFrame) else file_inventory(spark, path)
            zones.append(write_zones(spark, inventory, plan.column, plan.boundaries, schema[plan.column].dataType, most_overlap))
        place = {predicate: k for k, predicate in enumerate(plan.predicates)}
        return zone_frame(spark, zones[0], schema, plan.column, [place[p] for p in predicates])

    return read
