"""File inventory, Parquet footers and run documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rangehaul.sources.tasks import counts_reader, read_footers, read_row_groups, sample_encoder


def file_inventory(spark: SparkSession, path: str | Sequence[str], glob: str = "*.parquet") -> DataFrame:
    """(path, size, modified) of the data files below one or more paths; contents are not read.

    Loader state and transaction log folders do not count.
    """
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path if isinstance(path, str) else list(path))
        .select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    )
    return listed.filter(~F.col("path").rlike(r"/(_delta_log|_dlt_[^/]*)/"))


def as_objects(inventory: DataFrame) -> DataFrame:
    """Split a path into (bucket, key, size), the shape manifests use."""
    rest = F.regexp_replace("path", r"^[a-zA-Z0-9]+:/+", "")
    return inventory.select(
        F.substring_index(rest, "/", 1).alias("bucket"),
        F.regexp_replace(rest, r"^[^/]*/", "").alias("key"),
        "size",
    )


def _spread(inventory: DataFrame, tasks: int | None) -> DataFrame:
    """Paths over a fixed number of tasks; adaptive merging would put these tiny rows in one."""
    count = tasks or 4 * inventory.sparkSession.sparkContext.defaultParallelism
    return inventory.select("path").repartition(count, "path")


def file_schemas(inventory: DataFrame, tasks: int | None = None) -> DataFrame:
    """(path, column, type, num_rows) from Parquet footers, read inside tasks."""
    return _spread(inventory, tasks).mapInArrow(read_footers, "path string, column string, type string, num_rows bigint")


def row_groups(inventory: DataFrame, tasks: int | None = None) -> DataFrame:
    """(path, row_group, num_rows, bytes): disjoint physical ranges that cover every row once."""
    return _spread(inventory, tasks).mapInArrow(
        read_row_groups, "path string, row_group int, num_rows bigint, bytes bigint"
    )


def file_counts(inventory: DataFrame, columns: Sequence[str] | None = None, tasks: int | None = None) -> DataFrame:
    """(path, size, modified, rows, bytes): rows of each file and the decoded bytes of the columns (of all without a choice), from footers.

    The cost follows the number of files; no row and no column is read.
    """
    count = tasks or 4 * inventory.sparkSession.sparkContext.defaultParallelism
    placed = inventory.select("path", "size", "modified").repartition(count, "path")
    return placed.mapInArrow(counts_reader(list(columns) if columns else None), "path string, size bigint, modified timestamp, rows bigint, bytes bigint")


def encoded_width(inventory: DataFrame, schema: T.StructType, compression: str = "zstd", files: int = 32, rows: int = 20_000) -> float:
    """Bytes a row takes in Parquet with a codec, measured: the beginnings of `files` files, chosen by hash, are encoded in tasks.

    At most `files * rows` rows are read, whatever the size of the table, and only sums come back. Without rows, 0. A measure of sizes alone: no row
    is left out of a load by it.
    """
    some = inventory.orderBy(F.xxhash64("path"), "path").limit(files).select("path").repartition(files, "path")
    codec = "none" if compression == "uncompressed" else compression
    found = some.mapInArrow(sample_encoder(codec, rows, to_arrow_schema(schema)), "rows bigint, bytes bigint")
    total = found.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).first()
    return total["bytes"] / total["rows"] if total["rows"] else 0.0


def output_stats(spark: SparkSession, path: str) -> DataFrame:
    """Number of data files and their compressed bytes."""
    return file_inventory(spark, path).agg(
        F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")
    )


# Columns of a run document; durations are open-ended, so they form a map.
RUN_SCHEMA = (
    "run_id string, engine string, read_mode string, extract_backend string, profile string, `table` string, "
    "started_at string, rows bigint, source_estimated_rows bigint, source_estimated_bytes bigint, "
    "output_bytes bigint, files bigint, partitions int, plan struct<strategy:string,column:string>, "
    "durations_seconds map<string,double>, throughput_rows_per_second double, "
    "readback_rows bigint, success int"
)


def load_runs(
    spark: SparkSession, prefixes: Sequence[str], multiline: bool = False, schema: str = RUN_SCHEMA,
    excluded_ids: Sequence[str] = (), excluded_prefixes: Sequence[str] = (), glob: str = "*.json",
) -> DataFrame:
    """Run summaries below several prefixes, without failures. Checks of an installation are left out by name: `excluded_ids`, `excluded_prefixes`.

    A missing engine is `spark`; a missing reader is the extract backend, else `jdbc` for Spark.
    """
    documents = spark.read.schema(schema).option("multiLine", multiline).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    found = documents.json(list(prefixes)).filter(~F.col("_metadata.file_name").endswith(".failed.json"))
    engine: Column = F.coalesce(F.col("engine"), F.lit("spark"))
    fallback = F.coalesce(
        F.col("extract_backend"), F.when(engine == "spark", F.lit("jdbc")).otherwise(F.lit("unknown"))
    )
    run_id = F.coalesce(F.col("run_id"), F.lit(""))
    left_out = run_id.isin(*excluded_ids)
    for prefix in excluded_prefixes:
        left_out = left_out | run_id.startswith(prefix)
    return (
        found.filter(~left_out)
        .withColumn("engine", engine)
        .withColumn("read_mode", F.coalesce(F.col("read_mode"), fallback))
    )
