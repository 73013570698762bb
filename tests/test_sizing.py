import pytest
from pyspark.sql import functions as F

from rangehaul.functions import sizing as S
from rangehaul.plans.load_plan import load_strategy, size_plan
from rangehaul.plans.ingest import IngestOptions, ingest
from rangehaul.sinks import snapshots
from rangehaul.sinks.snapshots import Variant, desired_files, rewrite, sized, write_files, write_sized, writer_matrix
from rangehaul.sources.files import encoded_width, file_inventory, output_stats

MIB = 1 << 20


def one(spark, column, rows=0, size=0):
    frame = spark.createDataFrame([(rows, size)], "rows bigint, bytes bigint")
    return frame.select(column.alias("x")).first()["x"]


ROWS, BYTES = F.col, F.col


@pytest.mark.parametrize(
    "size, limits, expected",
    [
        (1000, {}, 1),
        (0, {}, 1),
        (1 << 30, {}, 2),
        (1 << 30, {"task_slots": 8, "max_connections": 3}, 3),
        (512 * MIB, {"task_slots": 2, "oversubscription": 2}, 4),
        (33 * MIB, {"task_slots": 8}, 2),
    ],
)
def test_partitions(spark, size, limits, expected):
    assert one(spark, S.partition_count(F.col("bytes"), S.PartitionLimits(**limits)), 10**6, size) == expected


@pytest.mark.parametrize(
    "rows, size, limits, expected",
    [
        (10**6, 512 * MIB, {}, 8),
        (200_000, 68 * MIB, {}, 1),
        (10**6, 512 * MIB, {"max_chunks": 64, "target_bytes": 16 * MIB}, 32),
        (10**6, 512 * MIB, {"max_chunks": 64, "target_bytes": 8 * MIB}, 64),
        (0, 10 << 30, {}, 1),
        (10**9, 100 << 30, {}, 128),
        # Few useful rows per chunk override the byte preference.
        (150_000, 10 << 30, {}, 2),
        # Very large tables without a chunk cap follow the preferred size.
        (2 * 10**12, 100 << 40, {"max_chunks": 10**6}, 409_600),
    ],
)
def test_chunks(spark, rows, size, limits, expected):
    assert one(spark, S.chunk_count(F.col("rows"), F.col("bytes"), S.ChunkLimits(**limits)), rows, size) == expected


@pytest.mark.parametrize(
    "rows, size, chunks, limits, expected",
    [
        (10**6, 512 * MIB, 8, {}, 31242),
        (10**6, 1000, 1, {}, 100_000),
        (0, 0, 1, {}, 1000),
        (500, 10 * MIB, 1, {}, 500),
        (10**6, 1 << 40, 4, {}, 1000),
        (10**6, 1 << 30, 4, {"rows": 7500}, 7500),
    ],
)
def test_fetch(spark, rows, size, chunks, limits, expected):
    column = S.fetch_rows(F.col("rows"), F.col("bytes"), F.lit(chunks), S.FetchLimits(**limits))
    assert one(spark, column, rows, size) == expected


def test_counts_stay_exact_beyond_double(spark):
    assert one(spark, S.units_of(F.col("bytes"), 3), 0, 2**60 + 1) == -(-(2**60 + 1) // 3)


def test_files(spark):
    assert desired_files(10**9, files=3) == 3
    assert desired_files(10**9, target_bytes=None) is None
    assert desired_files(0) == 1
    assert desired_files(1 << 30) == 3
    assert one(spark, S.file_count(F.col("bytes"), 128 * MIB), 0, 1 << 30) == 3
    frame = spark.range(0, 100, 1, 8)
    assert sized(frame, None, 8)[1] == "preserve" and sized(frame, 8, 8)[1] == "preserve"
    assert sized(frame, 4, 8)[1] == "coalesce" and sized(frame, 1, 8)[1] == "repartition" and sized(frame, 16, 8)[1] == "repartition"


def test_strategies(spark):
    sizes = spark.createDataFrame(
        [("small", 10, 10), ("nokey", 10**7, 1 << 31), ("hist", 10**7, 1 << 31), ("even", 10**7, 1 << 31), ("flat", 10**7, 1 << 31), ("few", 10**7, 1 << 31)],
        "table string, rows bigint, bytes bigint",
    )
    keys = spark.createDataFrame([(t, "k") for t in ("small", "hist", "even", "flat", "few")], "table string, column string")
    points = lambda rows: spark.createDataFrame(rows, "table string, boundary bigint")
    plan = load_strategy(
        sizes, keys,
        points([("hist", i) for i in range(3)] + [("few", 1), ("small", 5)]),
        points([("even", i) for i in range(3)] + [("hist", 9)]),
        S.partition_count(F.col("bytes"), S.PartitionLimits(task_slots=4)),
        max_parallel=3,
    )
    got = {r["table"]: (r["strategy"], r["ranges"], r["parallelism"], r["column"], r["warning"] is not None) for r in plan.collect()}
    assert got == {
        "small": ("single_scan", 1, 1, None, False),
        "nokey": ("single_scan", 1, 1, None, False),
        "hist": ("histogram_ranges", 4, 3, "k", False),
        "even": ("indexed_ranges", 4, 3, "k", False),
        "flat": ("single_scan", 1, 1, "k", False),
        "few": ("histogram_ranges", 2, 2, "k", True),
    }
    planned = size_plan(sizes).filter("table = 'hist'").first()
    assert planned["chunks"] == 8 and planned["chunk_bytes"] == 1 << 28


def test_limits_are_positive():
    for make in (lambda: S.PartitionLimits(task_slots=0), lambda: S.ChunkLimits(max_chunks=True), lambda: S.ChunkLimits(target_bytes=-1), lambda: S.FetchLimits(rows="auto")):
        with pytest.raises(ValueError):
            make()
    from rangehaul.plans.ingest import IngestOptions

    for wrong in ({"compression": "lz77"}, {"publication": "now"}, {"validation": "none"}):
        with pytest.raises(ValueError):
            IngestOptions(**wrong)


def test_measured_sizes(spark, scratch):
    path, out = scratch(), scratch()
    frame = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"), (F.col("id") % 7).cast("int").alias("s"))
    frame.repartition(6).write.option("compression", "none").parquet(path)
    width = encoded_width(file_inventory(spark, path), frame.schema, "zstd", rows=5000)
    narrow = encoded_width(file_inventory(spark, path), frame.select("s").schema, "zstd")
    assert narrow < 2 < 30 < width
    desired, how = write_sized(spark, out, path, 1 << 20)
    stats = output_stats(spark, out).first()
    assert how in ("coalesce", "preserve", "repartition") and stats["files"] == desired > 1
    assert 0.5 < stats["bytes"] / desired / (1 << 20) < 1.5 and 0.7 < stats["bytes"] / (60_000 * width) < 1.4
    assert spark.read.parquet(out).exceptAll(frame).isEmpty() and spark.read.parquet(out).count() == 60_000
    empty = scratch()
    frame.limit(0).write.parquet(empty)
    assert encoded_width(file_inventory(spark, empty), frame.schema) == 0.0 and write_sized(spark, scratch(), empty)[0] == 1


def test_rewritten_files_follow_staged_bytes(spark, scratch):
    root = scratch()
    frame = spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"))
    run = ingest(frame, root, "r", "t", "id", IngestOptions(ranges=4, publication="rewrite", file_bytes=800_000)).first()
    assert run["mode"] == "rewrite" and run["rows"] == 40_000 and 2 <= run["files"] <= 4
    assert 400_000 < run["output_bytes"] / run["files"] < 1_200_000


def test_few_files_take_encoded_parts(spark, scratch, monkeypatch):
    """Tasks that write few files read encoded parts; no shuffled row reaches them."""
    plans, real = [], snapshots.write_snapshot

    def spied(df, path, *args, **kwargs):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        real(df, path, *args, **kwargs)

    monkeypatch.setattr(snapshots, "write_snapshot", spied)
    frame = spark.range(0, 50_000, 1, 40).select("id", (F.col("id") % 1000).cast("string").alias("t"), F.when(F.col("id") % 3 > 0, F.col("id")).alias("n"))
    for files in (1, 3):
        path = scratch()
        assert write_files(frame, path, files) == "repartition"
        assert sorted(r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect())[0] >= 50_000 // files - 1250
        assert output_stats(spark, path).first()["files"] == files
        assert spark.read.parquet(path).exceptAll(frame).isEmpty() and spark.read.parquet(path).count() == 50_000
    base, whole = scratch(), scratch()
    assert writer_matrix(frame, base, [Variant("many"), Variant("one", partitions=1)]).where("name = 'one'").first()["files"] == 1
    rewrite(spark, [frame], whole, files=2)
    assert output_stats(spark, whole).first()["files"] == 2
    assert plans and not any("Exchange" in plan for plan in plans)
    # Nothing but the files is left beside them.
    assert file_inventory(spark, base).where(F.col("path").contains("-parts-")).isEmpty()


def test_few_files_of_small_frames(spark, scratch):
    for rows, parts, files in ((7, 1, 3), (0, 4, 2), (30, 12, 3)):
        path = scratch()
        write_files(spark.range(0, rows, 1, parts), path, files)
        assert spark.read.parquet(path).count() == rows
        assert output_stats(spark, path).first()["files"] == (files if rows else 1)
