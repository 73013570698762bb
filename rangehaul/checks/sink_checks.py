"""Writes, publication, validation and the load job, on fresh folders of the shared scratch space."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from rangehaul.checks.conform_checks import UNIFIED_SQL, differing_frames
from rangehaul.checks.manifest_checks import k_of
from rangehaul.checks.range_checks import ASSIGNED_SQL, assigned_lines
from rangehaul.checks.registry import check, table
from rangehaul.operators import reconcile as V
from rangehaul.operators.drilldown import differing_rows
from rangehaul.plans.file_load import ingest_files, pack_files
from rangehaul.plans.ingest import IngestOptions, ingest, reconcile
from rangehaul.session import scratch_path
from rangehaul.sinks import snapshots as S
from rangehaul.sinks.ledger import Ledger, run_conflicts
from rangehaul.sources.files import output_stats as stats_of_path


# --- fingerprints ---


@check("table_checksum")
def table_checksum(spark, sf):
    lines = V.table_checksum(table(spark, sf, "lineitem")).withColumn("table", F.lit("lineitem"))
    vectors = V.table_checksum(table(spark, sf, "embeddings")).withColumn("table", F.lit("embeddings"))
    return lines.unionByName(vectors)


_MD5_SQL = "md5(o_orderkey || '|' || o_custkey || '|' || o_orderstatus || '|' || coalesce(nullif(o_orderpriority, '5-LOW'), '\\N'))"


@check(
    "table_fingerprint_md5",
    f"""
    SELECT count(*) AS rows, CAST(sum(CAST(CAST('0x' || substr({_MD5_SQL}, 1, 15) AS BIGINT) AS HUGEINT)) AS VARCHAR) AS checksum
    FROM orders
    """,
)
def table_fingerprint_md5(spark, sf):
    priority = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority"))
    columns = [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"), priority]
    found = V.portable_fingerprint(table(spark, sf, "orders"), columns)
    return found.withColumn("checksum", F.col("checksum").cast("string"))


# --- writes ---


@check("write_snapshot", "SELECT * FROM orders")
def write_snapshot(spark, sf):
    path = scratch_path(spark, "snapshot")
    S.write_snapshot(table(spark, sf, "orders"), path)
    return spark.read.parquet(path)


@check(
    "sized_write",
    "SELECT l_returnflag, count(*) AS rows, sum(l_orderkey)::BIGINT AS keys, 3 AS files FROM lineitem GROUP BY 1",
)
def sized_write(spark, sf):
    path = scratch_path(spark, "sized")
    S.write_files(table(spark, sf, "lineitem"), path, S.desired_files(0, files=3))
    files = stats_of_path(spark, path).select(F.col("files").cast("int")).scalar()
    return spark.read.parquet(path).groupBy("l_returnflag").agg(
        F.count("*").alias("rows"), F.sum("l_orderkey").alias("keys")
    ).withColumn("files", files)


_SIZED = 128 << 10


@check(
    "measured_write",
    "SELECT o_orderstatus, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys, true AS near_target FROM orders GROUP BY 1",
)
def measured_write(spark, sf):
    """Orders copied into files of a wanted size, by a sample that is encoded first; the mean size is within a factor of two of it."""
    source, path = scratch_path(spark, "many"), scratch_path(spark, "measured")
    S.write_snapshot(table(spark, sf, "orders").repartition(24), source, compression="snappy")
    desired, _ = S.write_sized(spark, path, source, _SIZED)
    stats = stats_of_path(spark, path)
    near = stats.select((F.col("bytes").between(F.col("files") * (_SIZED // 2), F.col("files") * _SIZED * 2)) | (F.lit(desired) == 1)).scalar()
    found = spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys"))
    return found.withColumn("near_target", near)


@check("output_stats")
def output_stats(spark, sf):
    path = scratch_path(spark, "stats")
    S.write_snapshot(table(spark, sf, "events").repartition(4), path)
    return stats_of_path(spark, path)


@check("writer_matrix")
def writer_matrix(spark, sf):
    variants = [
        S.Variant("snappy"),
        S.Variant("zstd", compression="zstd"),
        S.Variant("uncompressed", compression="uncompressed"),
        S.Variant("one_file", partitions=1),
    ]
    return S.writer_matrix(table(spark, sf, "orders"), scratch_path(spark, "matrix"), variants)


def _staged(spark, sf) -> tuple[str, DataFrame]:
    """Line items staged by eight ranges, and the manifests of the chunks."""
    path = scratch_path(spark, "staged")
    S.stage_chunks(assigned_lines(spark, sf), path)
    files = S.chunk_files(spark, path)
    return path, S.chunk_manifests(files, "run-1", "attempt-1", path, "2025-01-01T00:00:00")


@check(
    "chunk_manifests",
    f"{ASSIGNED_SQL} SELECT 'run-1' AS run_id, chunk AS index, count(*) AS rows, true AS has_files FROM assigned GROUP BY chunk",
)
def chunk_manifests(spark, sf):
    _, manifests = _staged(spark, sf)
    stored = (F.col("files") > 0) & (F.col("bytes") > 0)
    return manifests.select("run_id", "index", "rows", stored.alias("has_files"))


@check("publish_zero_copy", "SELECT * FROM lineitem")
def publish_zero_copy(spark, sf):
    _, manifests = _staged(spark, sf)
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    S.publish_by_reference(ledger, "run-1", "lineitem", manifests, 1)
    lines = table(spark, sf, "lineitem").schema
    return S.read_snapshot(ledger, "run-1", lines)


@check("publish_rewrite", UNIFIED_SQL)
def publish_rewrite(spark, sf):
    path = scratch_path(spark, "rewrite")
    S.rewrite(spark, differing_frames(spark, sf), path)
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    S.publish_rewrite(ledger, "run-1", "parties", path, 1)
    return S.read_snapshot(ledger, "run-1")


@check(
    "publish_existing",
    "SELECT 'run-1' AS run_id, 'existing' AS mode, count(*) AS rows, CAST(1 AS BIGINT) AS version FROM lineitem",
)
def publish_existing(spark, sf):
    _, manifests = _staged(spark, sf)
    ledger = Ledger(spark, scratch_path(spark, "ledger"))
    S.publish_by_reference(ledger, "run-1", "lineitem", manifests, 1)
    expected = table(spark, sf, "lineitem").count()
    return S.publish_existing(ledger, "run-1", expected).select("run_id", "mode", "rows", "version")


@check(
    "run_conflicts",
    """
    WITH r AS (SELECT user_id, event_id % 2 AS half, sha256('{"k":' || (CASE WHEN user_id % 3 = 0 THEN event_id % 2 ELSE 0 END) || '}') AS h,
                      user_id % 5 = 0 AS late FROM events),
    known AS (SELECT DISTINCT user_id, h FROM r WHERE half = 0 AND NOT late),
    asked AS (SELECT DISTINCT user_id, h FROM r WHERE half = 1)
    SELECT 'run-' || a.user_id AS run_id, a.h AS request_hash,
           CASE WHEN count(k.h) = 0 THEN 'new' WHEN bool_and(k.h = a.h) THEN 'repeat' ELSE 'conflict' END AS status
    FROM asked a LEFT JOIN known k USING (user_id) GROUP BY ALL
    """,
)
def conflicts(spark, sf):
    half = F.col("event_id") % 2
    content = F.when(F.col("user_id") % 3 == 0, half).otherwise(0)
    requests = table(spark, sf, "events").select(
        F.concat(F.lit("run-"), F.col("user_id")).alias("run_id"),
        F.sha2(F.to_json(F.struct(content.alias("k"))), 256).alias("request_hash"),
        half.alias("half"),
        (F.col("user_id") % 5 == 0).alias("late"),
    )
    return run_conflicts(requests.filter("half = 0 AND NOT late"), requests.filter("half = 1"))


# --- validation ---


@check(
    "reconcile_counts",
    """
    SELECT 'o_' || o_orderstatus AS "table", count(*) AS source_rows, count(*) AS written_rows, count(*) AS readback_rows,
           'equal' AS status FROM orders GROUP BY 1
    UNION ALL SELECT 'all', count(*), count(*), count(*), 'equal' FROM orders
    """,
)
def reconcile_counts(spark, sf):
    path = scratch_path(spark, "counts")
    orders = table(spark, sf, "orders")
    seen = Observation("written")
    S.write_snapshot(orders.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    copy = spark.read.parquet(path)
    total = lambda df: df.agg(F.count("*").alias("rows")).withColumn("table", F.lit("all"))
    parts = lambda df: df.groupBy(F.concat(F.lit("o_"), F.col("o_orderstatus")).alias("table")).agg(F.count("*").alias("rows"))
    both = lambda df: parts(df).unionByName(total(df))
    written = parts(copy).unionByName(total(copy).withColumn("rows", F.lit(seen.get["rows"])))
    return V.reconcile_counts(both(orders), written, both(copy))


@check(
    "manifest_totals",
    """
    WITH m AS (SELECT user_id AS run_id, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS manifest_rows FROM events GROUP BY 1),
    s AS (SELECT o_custkey AS run_id, count(*) AS snapshot_rows FROM orders GROUP BY 1)
    SELECT coalesce(m.run_id, s.run_id) AS run_id, coalesce(manifest_rows, 0) AS manifest_rows, coalesce(snapshot_rows, 0) AS snapshot_rows,
           coalesce(manifest_rows, 0) = coalesce(snapshot_rows, 0) AS equal
    FROM m FULL JOIN s ON m.run_id = s.run_id
    """,
)
def manifest_totals(spark, sf):
    manifests = table(spark, sf, "events").select(F.col("user_id").alias("run_id"), k_of().alias("rows"))
    counts = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("run_id")).agg(F.count("*").alias("rows"))
    return V.manifest_totals(manifests, counts)


@check(
    "reconcile_ranges",
    f"""
    {ASSIGNED_SQL}, changed AS (SELECT chunk, l_orderkey % 1000 = 7 AS lost, l_partkey % 997 = 3 AND chunk IN (2, 5) AS altered FROM assigned)
    SELECT chunk, count(*) AS source_rows, count(*) FILTER (NOT lost) AS target_rows,
           CASE WHEN bool_or(lost) THEN 'count' WHEN bool_or(altered) THEN 'content' ELSE 'equal' END AS status
    FROM changed GROUP BY chunk
    """,
)
def reconcile_ranges(spark, sf):
    """A copy with lost rows and altered values: the ranges that hold them are named."""
    source = assigned_lines(spark, sf)
    altered = (F.col("l_partkey") % 997 == 3) & F.col("chunk").isin(2, 5)
    copy = source.filter(F.col("l_orderkey") % 1000 != 7).withColumn(
        "l_quantity", F.when(altered, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )
    return V.reconcile_ranges(source, copy).select("chunk", "source_rows", "target_rows", "status")


@check(
    "differing_rows",
    """
    WITH copy AS (
        SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 400000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderdate FROM orders
        WHERE NOT (o_orderpriority = '1-URGENT' AND o_totalprice < 20000)
        UNION ALL SELECT -o_orderkey - 1, o_custkey, o_orderstatus, o_orderdate FROM orders WHERE o_totalprice BETWEEN 100000 AND 101000
        UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders WHERE o_totalprice BETWEEN 200000 AND 201000
    ), sides AS (
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, 1 AS source, 0 AS target FROM orders
        UNION ALL SELECT *, 0, 1 FROM copy
    ), bags AS (
        SELECT o_orderkey, sum(source) AS a, sum(target) AS b FROM sides GROUP BY o_orderkey, o_custkey, o_orderstatus, o_orderdate
    )
    SELECT o_orderkey, CAST(sum(a) AS BIGINT) AS source_rows, CAST(sum(b) AS BIGINT) AS target_rows,
           CASE WHEN sum(b) = 0 THEN 'missing' WHEN sum(a) = 0 THEN 'unexpected' WHEN sum(a) <> sum(b) THEN 'count' ELSE 'content' END AS status
    FROM bags GROUP BY o_orderkey HAVING bool_or(a <> b)
    """,
)
def differing(spark, sf):
    """A copy with lost, altered, invented and doubled rows: their keys are named, by ranges that are halved while they differ."""
    source = table(spark, sf, "orders")
    some = source.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    priced = lambda low, high: source.where(F.col("o_totalprice").between(low, high))
    altered = F.when(F.col("o_totalprice") > 400000, "X").otherwise(F.col("o_orderstatus"))
    kept = source.where(~((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") < 20000))).withColumn("o_orderstatus", altered)
    invented = priced(100000, 101000).withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    copy = kept.unionByName(invented).unionByName(priced(200000, 201000)).select(*some.columns)
    return differing_rows(some, copy, "o_orderkey", leaf_rows=64)


# --- the load job ---

OPTIONS = IngestOptions(ranges=8)


@check(
    "run_summary",
    "SELECT 'orders-1' AS run_id, 'succeeded' AS status, 'o_orderkey' AS \"column\", count(*) AS rows, count(*) AS source_rows, 1 AS success FROM orders",
)
def run_summary(spark, sf):
    run = ingest(table(spark, sf, "orders"), scratch_path(spark, "load"), "orders-1", "orders", "o_orderkey", OPTIONS)
    return run.select("run_id", "status", "column", "rows", "source_rows", "success")


def load_and_reconcile(spark, sf) -> DataFrame:
    """Load orders by ranges; source and copy compared range by range."""
    root = scratch_path(spark, "load")
    orders = table(spark, sf, "orders")
    ingest(orders, root, "orders-1", "orders", "o_orderkey", OPTIONS)
    return reconcile(orders, root, "orders-1", "o_orderkey", OPTIONS)


@check(
    "ingest_reconciled",
    "SELECT count(*) AS source_rows, count(*) AS target_rows, true AS equal FROM orders",
)
def ingest_reconciled(spark, sf):
    return load_and_reconcile(spark, sf).agg(
        F.sum("source_rows").alias("source_rows"),
        F.sum("target_rows").alias("target_rows"),
        F.bool_and(F.col("status") == "equal").alias("equal"),
    )


@check(
    "file_chunks",
    """
    WITH f AS (SELECT CAST(o_orderkey AS VARCHAR) AS path, CAST(floor(o_totalprice) AS BIGINT) AS bytes FROM orders),
    b AS (SELECT *, CAST('0x' || substr(md5(path), 1, 8) AS BIGINT) % 7 AS bucket FROM f),
    r AS (SELECT *, coalesce(sum(greatest(bytes, 1)) OVER (PARTITION BY bucket ORDER BY path ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) // 2000000 AS part FROM b),
    n AS (SELECT *, dense_rank() OVER (ORDER BY bucket, part) - 1 AS chunk FROM r)
    SELECT path, bytes, CAST(chunk AS INTEGER) AS chunk FROM n
    """,
)
def file_chunks(spark, sf):
    """Files packed into chunks (an order stands for a file, its price for its bytes)."""
    files = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("path"), F.floor("o_totalprice").cast("bigint").alias("bytes"))
    return pack_files(files, 2_000_000, 7)


@check("ingest_files", "SELECT * FROM lineitem")
def ingest_line_files(spark, sf):
    """Line items as a folder of files, loaded in chunks without a shuffle, and the published rows with all their columns."""
    source, root = scratch_path(spark, "lines"), scratch_path(spark, "load")
    S.write_snapshot(table(spark, sf, "lineitem").repartition(16), source)
    ingest_files(spark, source, root, "lines-1", "lineitem", IngestOptions(wave_chunks=4), target_bytes=200_000)
    return S.read_snapshot(Ledger(spark, f"{root}/ledger"), "lines-1")


@check("ingest_temporal", "SELECT * FROM events")
def ingest_temporal(spark, sf):
    """Load events by ranges of their time, published by rewriting, and read the snapshot back."""
    root = scratch_path(spark, "load")
    events = table(spark, sf, "events")
    ingest(events, root, "events-1", "events", "ts", IngestOptions(ranges=6, publication="rewrite", file_bytes=256 << 10))
    return S.read_snapshot(Ledger(spark, f"{root}/ledger"), "events-1", events.schema)
