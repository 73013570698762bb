"""Loading a folder of files: the files seen first are the load, cut into chunks that are read and written in place."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from rangehaul.plans.ingest import CHUNK, FILE_CHUNKS, IngestOptions, RangePlan, ingest
from rangehaul.sinks.ledger import Ledger
from rangehaul.sources.files import file_counts, file_inventory

MIB = 1 << 20
TARGET_BYTES = 1024 * MIB
# Chunks that are numbered together; so many files at most meet in one task.
_CHUNKS_OF_BUCKET = 64


class SourceChanged(RuntimeError):
    """A file of the load is gone, or is not the file it was."""


def pack_files(files: DataFrame, target_bytes: int = TARGET_BYTES, buckets: int | None = None) -> DataFrame:
    """Adds `chunk` (from 0, without gaps) to files (path, bytes, …): neighbours are packed to about `target_bytes`.

    A chunk takes files until it has reached the target, so it is at most one file larger; files are never cut (a large one is read by many
    tasks all the same). Files are dealt over buckets by the hash of their path and packed within, so that no task sees all of them.
    The same files always give the same chunks. A file without bytes counts as one byte.
    """
    weight = F.greatest(F.coalesce(F.col("bytes"), F.lit(0)), F.lit(1)).cast("bigint")
    if buckets is None:
        total = files.agg(F.sum(weight).alias("n")).first()["n"] or 0
        buckets = max(1, total // (_CHUNKS_OF_BUCKET * target_bytes))
    number = F.conv(F.substring(F.md5("path"), 1, 8), 16, 10).cast("bigint")
    own = W.partitionBy("_bucket")
    before = F.coalesce(F.sum("_weight").over(own.orderBy("path").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = files.withColumns({"_bucket": number % buckets, "_weight": weight}).withColumn("_part", F.call_function("div", before, F.lit(target_bytes).cast("bigint")))
    placed = placed.withColumn("_place", F.dense_rank().over(own.orderBy("_part")))
    # One row per bucket.
    heights = placed.groupBy("_bucket").agg(F.max("_place").alias("_height"))
    offsets = heights.select(F.col("_bucket").alias("_b"), F.coalesce(F.sum("_height").over(W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    numbered = placed.join(offsets, placed["_bucket"] == offsets["_b"])
    return numbered.select(*files.columns, (F.col("_offset") + F.col("_place") - 1).cast("int").alias("chunk"))


def file_boundary(ledger: Ledger, run_id: str, path: str | Sequence[str], target_bytes: int = TARGET_BYTES, columns: Sequence[str] | None = None, glob: str = "*.parquet") -> DataFrame:
    """The files of a run with their chunks, rows and bytes: seen once, kept in the ledger, and the same for every attempt.

    Files that came later are not part of the run. One that is gone or was written anew raises `SourceChanged`.
    """
    spark = ledger.spark
    kept = ledger.read("sources").filter(F.col("run_id") == run_id)
    listed = file_inventory(spark, path, glob)
    if kept.isEmpty():
        packed = pack_files(file_counts(listed, columns), target_bytes)
        ledger.append("sources", packed.withColumn("run_id", F.lit(run_id)))
        return ledger.read("sources").filter(F.col("run_id") == run_id)
    now = listed.select("path", F.col("size").alias("_size"), F.col("modified").alias("_modified"))
    same = F.col("_size").eqNullSafe(F.col("size")) & F.col("_modified").eqNullSafe(F.col("modified"))
    changed = kept.join(now, "path", "left").filter(~same).select("path").limit(5).collect()
    if changed:
        raise SourceChanged(f"files changed since run {run_id!r} began: {', '.join(r['path'] for r in changed)}")
    return kept


def chunk_reader(spark: SparkSession, boundary: DataFrame, schema: T.StructType) -> Callable[[Sequence[int]], DataFrame]:
    """Turns chunk numbers into their rows, with the number as a column. Each chunk is a scan of its own files: nothing is shuffled or joined."""

    def read(chunks: Sequence[int]) -> DataFrame:
        paths: dict[int, list[str]] = {k: [] for k in chunks}
        # The paths of one wave; a scan holds its paths in the driver anyway.
        for row in boundary.filter(F.col("chunk").isin(*chunks)).select("chunk", "path").collect():
            paths[row["chunk"]].append(row["path"])
        frames = [spark.read.schema(schema).parquet(*sorted(own)).withColumn(CHUNK, F.lit(k)) for k, own in paths.items()]
        return reduce(DataFrame.unionAll, frames)

    return read


def ingest_files(
    spark: SparkSession,
    path: str | Sequence[str],
    root: str,
    run_id: str,
    table: str,
    options: IngestOptions = IngestOptions(),
    target_bytes: int = TARGET_BYTES,
    schema: T.StructType | None = None,
    glob: str = "*.parquet",
) -> DataFrame:
    """Load the Parquet files below a path without moving a row: chunks of whole files, written where they are read.

    Rows and sizes come from footers, resume goes by chunk, and the published rows must be as many as the footers promised. `schema` chooses and
    types the columns; without it the first file's schema holds. A folder without files is an error.
    """
    ledger = Ledger(spark, f"{root.rstrip('/')}/ledger")
    boundary = file_boundary(ledger, run_id, path, target_bytes, schema.names if schema else None, glob)
    counted = boundary.agg(F.max("chunk").alias("last"), F.sum("rows").alias("rows"), F.min("path").alias("first")).first()
    if counted["last"] is None:
        raise ValueError(f"no file below {path}")
    kind = schema or spark.read.parquet(counted["first"]).schema
    chunks = counted["last"] + 1
    plan = RangePlan(FILE_CHUNKS, None, (), tuple(f"files of chunk {k}" for k in range(chunks)), chunks, counted["rows"])
    read = chunk_reader(spark, boundary, kind)
    source = read(range(chunks)).drop(CHUNK) if chunks <= options.wave_chunks else spark.read.schema(kind).parquet(*[r["path"] for r in boundary.select("path").collect()])
    return ingest(source, root, run_id, table, None, options, plan, read)
