"""Snapshot writes, file sizing, chunked staging and publication."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from heapq import heappop, heappush

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rangehaul.operators.conform import conform, unify_union
from rangehaul.operators.reconcile import table_checksum
from rangehaul.sinks.commits import remove_folder
from rangehaul.sources.files import encoded_width, file_counts, file_inventory, output_stats

MIB = 1 << 20
TARGET_FILE_BYTES = 128 * MIB
COMPRESSION_RATIO = 0.33
# Rows of a part that is encoded before few files are made of the parts.
PART_ROWS = 1 << 20
# With more files than this a file's share of the rows is small, and rows move to it by a plain shuffle.
PACKED_FILES = 64
# Fixed value: a union of one-partition frames keeps a partition for each instead of merging them into one.
_UNION_APART = {"spark.sql.unionOutputPartitioning": "false"}


def write_snapshot(df: DataFrame, path: str, fmt: str = "parquet", compression: str = "zstd", **options) -> None:
    """Write to a fresh path; an existing one is an error. `fmt="delta"` needs the Delta jar."""
    df.write.format(fmt).option("compression", compression).options(**options).mode("errorifexists").save(path)


def replace_table(df: DataFrame, path: str, fmt: str = "parquet", compression: str = "zstd") -> None:
    """Whole-table load that replaces what was there."""
    df.write.format(fmt).option("compression", compression).mode("overwrite").save(path)


def desired_files(source_bytes: int, files: int | None = None, target_bytes: int | None = TARGET_FILE_BYTES, ratio: float = COMPRESSION_RATIO) -> int | None:
    """Explicit count first, else estimated output bytes over the target; None keeps the partitions."""
    if files is not None:
        return files
    if target_bytes is None:
        return None
    output = max(1, int(-(-source_bytes * ratio // 1)))
    return max(1, -(-output // target_bytes))


def sized(df: DataFrame, desired: int | None, current: int | None = None) -> tuple[DataFrame, str]:
    """Bring a frame to the wanted number of output partitions, and say how.

    Close below the present number the partitions are merged in place; far below it that would
    leave the reads to a few tasks, so the rows are spread anew instead.
    """
    if desired is None or desired == current:
        return df, "preserve"
    if current is not None and desired < current <= 4 * desired:
        return df.coalesce(desired), "coalesce"
    return df.repartition(desired), "repartition"


def write_files(df: DataFrame, path: str, desired: int | None, current: int | None = None, fmt: str = "parquet", compression: str = "zstd") -> str:
    """Write a frame as the wanted number of files, and say how (the names of `sized`).

    A file is written by one task. Where few files take the rows of many partitions, the partitions are first encoded where
    they are, by as many tasks, and each file's task reads its parts back: encoded columns, about as many bytes as
    the file will have, instead of shuffled rows. The parts are deleted afterwards.
    """
    output, operation = sized(df, desired, current)
    if operation != "repartition" or desired > PACKED_FILES or (current is not None and current < desired) or fmt not in ("parquet", "orc", "delta"):
        write_snapshot(output, path, fmt, compression)
        return operation
    spark, parts = df.sparkSession, f"{path.rstrip('/')}-parts-{uuid.uuid4().hex}"
    try:
        write_snapshot(df, parts, maxRecordsPerFile=PART_ROWS)
        with _conf(spark, _UNION_APART):
            write_snapshot(_packed(spark, parts, df.schema, desired), path, fmt, compression)
    finally:
        remove_folder(spark, parts)
    return operation


def _packed(spark: SparkSession, parts: str, schema: T.StructType, files: int) -> DataFrame:
    """The rows of all parts in `files` partitions of about as many rows; fewer parts than files are spread by rows."""
    found = file_counts(file_inventory(spark, parts), tasks=spark.sparkContext.defaultParallelism).where("rows > 0")
    listed = found.select("path", "rows").orderBy(F.desc("rows"), "path").collect()
    if len(listed) < files:
        return spark.read.schema(schema).parquet(parts).repartition(files)
    shares = [(0, i) for i in range(files)]
    paths: list[list[str]] = [[] for _ in shares]
    for part in listed:
        rows, i = heappop(shares)
        paths[i].append(part["path"])
        heappush(shares, (rows + part["rows"], i))
    return reduce(DataFrame.union, [spark.read.schema(schema).parquet(*own).coalesce(1) for own in paths])


def write_sized(spark: SparkSession, path: str, source: str | Sequence[str], target_bytes: int = TARGET_FILE_BYTES, compression: str = "zstd", schema: T.StructType | None = None) -> tuple[int, str]:
    """Copy Parquet files into files of about `target_bytes`; returns the number asked for and how it was reached.

    Rows come from the footers, their width in the wanted columns and codec from a bounded sample that is encoded first.
    """
    inventory = file_inventory(spark, source)
    whole = (spark.read.schema(schema) if schema else spark.read).parquet(*([source] if isinstance(source, str) else source))
    rows = file_counts(inventory).agg(F.sum("rows")).first()[0] or 0
    desired = desired_files(round(rows * encoded_width(inventory, whole.schema, compression)), target_bytes=target_bytes, ratio=1.0)
    output, operation = sized(whole, desired, whole.rdd.getNumPartitions())
    write_snapshot(output, path, compression=compression)
    return desired, operation


@dataclass(frozen=True)
class Variant:
    """One way to write the same rows."""

    name: str
    fmt: str = "parquet"
    compression: str = "snappy"
    partitions: int | None = None


def writer_matrix(df: DataFrame, base: str, variants: Sequence[Variant], current: int | None = None, isolate: bool = True) -> DataFrame:
    """Write the same rows in several variants; time, bytes, files, rows and fingerprint of each.

    `isolate` keeps the rows in executor memory or disk first, so that only the write is timed.
    Raises when a variant reads back different rows.
    """
    spark = df.sparkSession
    started = time.perf_counter()
    frame = df.persist(StorageLevel.MEMORY_AND_DISK) if isolate else df
    rows_in = frame.count() if isolate else None
    source_seconds = time.perf_counter() - started if isolate else 0.0
    results = []
    try:
        for variant in variants:
            path = f"{base.rstrip('/')}/{variant.name}"
            started = time.perf_counter()
            operation = write_files(frame, path, variant.partitions, current, variant.fmt, variant.compression)
            write_seconds = time.perf_counter() - started
            started = time.perf_counter()
            check = table_checksum(spark.read.format(variant.fmt).load(path)).first()
            validation_seconds = time.perf_counter() - started
            stats = output_stats(spark, path).first()
            results.append(
                (variant.name, variant.fmt, variant.compression, operation, write_seconds, validation_seconds,
                 source_seconds, check["rows"], str(check["checksum"]), stats["files"], stats["bytes"])
            )
    finally:
        if isolate:
            frame.unpersist()
    first = results[0]
    for result in results:
        if result[7:9] != first[7:9] or (rows_in is not None and result[7] != rows_in):
            raise RuntimeError(f"variant {result[0]} holds different rows")
    return spark.createDataFrame(
        results,
        "name string, format string, compression string, operation string, write_seconds double, "
        "validation_seconds double, source_seconds double, rows bigint, checksum string, files bigint, output_bytes bigint",
    )


# --- chunked staging -----------------------------------------------------------------


def stage_chunks(df: DataFrame, path: str, chunk: str = "chunk", compression: str = "zstd", rows_per_file: int = 5_000_000, already_split: bool = False) -> None:
    """Write one folder per chunk.

    Rows move to their chunk by a rebalance, which AQE splits where a chunk is hot and merges
    where chunks are small: a chunk with a third of all rows is written by many tasks. When
    the partitions of the read already are the ranges (`already_split`), nothing moves.
    """
    placed = df if already_split else df.hint("rebalance", chunk)
    with _unsorted(df.sparkSession, already_split):
        (
            placed.write.option("compression", compression)
            .option("maxRecordsPerFile", rows_per_file)
            .partitionBy(chunk)
            .mode("errorifexists")
            .parquet(path)
        )


# A task may hold two files open at a time; only beyond that are its rows sorted by folder first.
_TWO_WRITERS = {"spark.sql.optimizer.plannedWrite.enabled": "false", "spark.sql.maxConcurrentOutputFileWriters": "2"}


@contextmanager
def _unsorted(spark: SparkSession, apply: bool) -> Iterator[None]:
    """Tasks that hold one chunk each (or the end of one and the start of the next) need no sort before they write."""
    with _conf(spark, _TWO_WRITERS if apply else {}):
        yield


@contextmanager
def _conf(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Settings of the session for a while."""
    before = {name: spark.conf.get(name) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def read_staged(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    return (reader.schema(schema) if schema else reader).parquet(path)


def read_chunks(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """The rows of chunk folders; without folders, none."""
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def chunk_files(spark: SparkSession, path: str, chunk: str = "chunk") -> DataFrame:
    """(chunk, path, size, rows) per staged file; rows come from the footers, so the cost follows the files and not the rows."""
    counted = file_counts(file_inventory(spark, path), tasks=spark.sparkContext.defaultParallelism)
    return counted.select(F.regexp_extract("path", f"/{chunk}=([^/]+)/[^/]+$", 1).cast("int").alias(chunk), "path", "size", "rows")


def chunk_manifests(files: DataFrame, run_id: str, attempt_id: str, path: str, completed_at: str, chunk: str = "chunk") -> DataFrame:
    """One manifest per chunk; the file list stays a table of its own (`chunk_files`)."""
    return files.groupBy(F.col(chunk).cast("int").alias("index")).agg(
        F.sum("rows").alias("rows"), F.sum("size").alias("bytes"), F.count("*").alias("files")
    ).select(
        F.lit(run_id).alias("run_id"),
        "index",
        F.lit(attempt_id).alias("attempt_id"),
        F.concat(F.lit(f"{path.rstrip('/')}/{chunk}="), F.col("index").cast("string")).alias("path"),
        "rows",
        "bytes",
        "files",
        F.lit(completed_at).alias("completed_at"),
    )


# --- publication ---------------------------------------------------------------------


def publish_by_reference(ledger, run_id: str, table: str, selected: DataFrame, version: int) -> None:
    """Publish the selected chunk folders as they are: only ledger rows are written."""
    rows = selected.select(
        F.lit(run_id).alias("run_id"),
        F.lit(table).alias("table"),
        F.lit(version).alias("version"),
        F.lit("zero_copy").alias("mode"),
        "index",
        "path",
        "rows",
        "bytes",
        "files",
        F.current_timestamp().alias("published_at"),
    )
    ledger.append("snapshots", rows.coalesce(1))


def rewrite(spark: SparkSession, frames: Sequence[DataFrame], path: str, files: int | None = None, compression: str = "zstd", schema: T.StructType | None = None) -> None:
    """Publish by writing again: types unified over all inputs (or a given schema).

    Without a file count nothing is shuffled: a scan packs small files and cuts large ones to
    `spark.sql.files.maxPartitionBytes`, so each task already writes one file of that order.
    """
    whole = unify_union([conform(f, schema) for f in frames] if schema else frames)
    write_files(whole, path, files, whole.rdd.getNumPartitions() if files else None, compression=compression)


def publish_rewrite(ledger, run_id: str, table: str, path: str, version: int) -> None:
    """Ledger row of a rewritten snapshot."""
    spark = ledger.spark
    stats = output_stats(spark, path)
    rows = spark.read.parquet(path).agg(F.count("*").alias("rows"))
    row = stats.select(
        F.lit(run_id).alias("run_id"),
        F.lit(table).alias("table"),
        F.lit(version).alias("version"),
        F.lit("rewrite").alias("mode"),
        F.lit(None).cast("int").alias("index"),
        F.lit(path).alias("path"),
        F.lit(rows.first()["rows"]).alias("rows"),
        "bytes",
        "files",
        F.current_timestamp().alias("published_at"),
    )
    ledger.append("snapshots", row)


def snapshot_rows(ledger, run_id: str) -> DataFrame:
    return ledger.read("snapshots").filter(F.col("run_id") == run_id)


def read_snapshot(ledger, run_id: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of a published run: exactly the folders its ledger rows name (one per chunk)."""
    paths = [r["path"] for r in snapshot_rows(ledger, run_id).select("path").distinct().collect()]
    if not paths:
        raise ValueError(f"run {run_id!r} is not published")
    reader = ledger.spark.read
    return (reader.schema(schema) if schema else reader).parquet(*sorted(paths))


def publish_existing(ledger, run_id: str, expected_rows: int) -> DataFrame | None:
    """A run that is published already: check its count and return its totals; None if it is not."""
    found = snapshot_rows(ledger, run_id)
    total = found.agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes"), F.sum("files").alias("files"), F.max("version").alias("version")
    )
    row = total.first()
    if row["version"] is None:
        return None
    actual = read_snapshot(ledger, run_id).count()
    if actual != expected_rows or actual != row["rows"]:
        raise RuntimeError(f"run {run_id!r}: snapshot holds {actual} rows, expected {expected_rows}")
    return total.select(F.lit(run_id).alias("run_id"), F.lit("existing").alias("mode"), "rows", "bytes", "files", "version")
