"""Loads of files: chunks without a shuffle, a boundary that attempts share, manifests from footers."""

import pytest
from pyspark.sql import functions as F

from rangehaul.plans import ingest as I
from rangehaul.plans.file_load import SourceChanged, chunk_reader, file_boundary, ingest_files, pack_files
from rangehaul.plans.ingest import IngestOptions
from rangehaul.sinks import snapshots as S
from rangehaul.sinks.ledger import Ledger
from rangehaul.sources.files import file_counts, file_inventory


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def folder(spark, data, scratch, files=6):
    path = scratch()
    spark.read.parquet(f"{data}/lineitem.parquet").repartition(files).write.parquet(path)
    return path


def ledger(spark, root):
    return Ledger(spark, f"{root}/ledger")


@pytest.mark.parametrize("buckets", [1, 3, None])
def test_packing(spark, buckets):
    rows = [(f"f{i:03d}", (i * 37) % 50 if i % 9 else None) for i in range(200)] + [("huge", 5000)]
    files = spark.createDataFrame(rows, "path string, bytes bigint").repartition(4)
    packed = [tuple(r) for r in pack_files(files, 100, buckets).collect()]
    assert sorted(p[:2] for p in packed) == sorted(rows)
    assert sorted(packed) == sorted(tuple(r) for r in pack_files(files.coalesce(1), 100, buckets).collect())
    sizes = {}
    for _, size, chunk in packed:
        sizes.setdefault(chunk, []).append(max(1, size or 0))
    assert sorted(sizes) == list(range(len(sizes)))
    # A chunk goes on only while it is below the target.
    assert all(sum(own) - max(own) < 100 for own in sizes.values())
    assert pack_files(files.limit(0), 100, buckets).isEmpty()


def test_footers_count(spark, data, scratch):
    path = folder(spark, data, scratch)
    source = spark.read.parquet(path)
    counted = file_counts(file_inventory(spark, path))
    rows = source.groupBy(F.col("_metadata.file_name").alias("name")).count()
    assert {(r["path"].split("/")[-1], r["rows"]) for r in counted.collect()} == {(r["name"], r["count"]) for r in rows.collect()}
    narrow = file_counts(file_inventory(spark, path), ["l_orderkey"]).agg(F.sum("bytes")).first()[0]
    assert 0 < narrow < counted.agg(F.sum("bytes")).first()[0] / 4


def test_files_are_loaded_without_a_shuffle(spark, data, scratch):
    path, root = folder(spark, data, scratch), scratch()
    source = spark.read.parquet(path)
    run = ingest_files(spark, path, root, "r", "lineitem", IngestOptions(wave_chunks=2), target_bytes=30_000).first()
    assert run["strategy"] == I.FILE_CHUNKS and run["rows"] == run["source_rows"] == source.count() and run["partitions"] > 2
    assert same_rows(S.read_snapshot(ledger(spark, root), "r"), source)
    boundary = ledger(spark, root).read("sources")
    read = chunk_reader(spark, boundary, source.schema)(range(run["partitions"]))
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Sort" not in plan
    # Staged files are counted from footers: no scan of their rows.
    staged = S.read_staged(spark, ledger(spark, root).read("manifests").select(F.regexp_replace("path", "/[^/]*$", "")).first()[0])
    files = S.chunk_files(spark, ledger(spark, root).read("manifests").select(F.regexp_replace("path", "/[^/]*$", "")).first()[0])
    assert "FileScan parquet" not in files._jdf.queryExecution().executedPlan().toString()
    by_footer = {(r["chunk"], r["rows"]) for r in files.groupBy("chunk").agg(F.sum("rows").alias("rows")).collect()}
    assert by_footer == {(r["chunk"], r["count"]) for r in staged.groupBy("chunk").count().collect()}
    # The same run id gives the stored result.
    assert ingest_files(spark, path, root, "r", "lineitem", IngestOptions(wave_chunks=9), target_bytes=30_000).first()["started_at"] == run["started_at"]


def test_resume_goes_by_wave_and_ignores_later_files(spark, data, scratch, monkeypatch):
    path, root = folder(spark, data, scratch), scratch()
    source = spark.read.parquet(path)
    before = source.select("*").collect()
    options = IngestOptions(wave_chunks=1)
    staged, real = [], I._stage_wave

    def failing(*arguments):
        if len(staged) == 2:
            raise OSError("lost")
        staged.append(arguments[5])
        return real(*arguments)

    monkeypatch.setattr(I, "_stage_wave", failing)
    with pytest.raises(OSError):
        ingest_files(spark, path, root, "r", "lineitem", options, target_bytes=30_000)
    # The source gains files; the boundary of the run does not.
    source.limit(50).write.mode("append").parquet(path)
    again = []
    monkeypatch.setattr(I, "_stage_wave", lambda *arguments: again.extend(arguments[5]) or real(*arguments))
    run = ingest_files(spark, path, root, "r", "lineitem", options, target_bytes=30_000).first()
    assert not set(again) & {k for own in staged for k in own} and len(again) == run["partitions"] - 2
    assert run["rows"] == len(before)
    assert same_rows(S.read_snapshot(ledger(spark, root), "r"), spark.createDataFrame(before, source.schema))
    # A new run sees all files.
    assert ingest_files(spark, path, root, "r2", "lineitem", options, target_bytes=1 << 30).first()["rows"] == len(before) + 50


def test_changed_files_are_refused(spark, data, scratch):
    path, root = folder(spark, data, scratch, 2), scratch()
    kept = file_boundary(ledger(spark, root), "r", path)
    assert kept.count() == 2
    spark.read.parquet(f"{data}/lineitem.parquet").limit(10).coalesce(1).write.mode("overwrite").parquet(path)
    with pytest.raises(SourceChanged, match="part-"):
        file_boundary(ledger(spark, root), "r", path)


def test_narrow_schema_and_nothing(spark, data, scratch):
    path, root = folder(spark, data, scratch, 2), scratch()
    schema = spark.read.parquet(path).select("l_orderkey", "l_comment").schema if "l_comment" in spark.read.parquet(path).columns else spark.read.parquet(path).select("l_orderkey", "l_quantity").schema
    run = ingest_files(spark, path, root, "r", "narrow", schema=schema).first()
    copy = S.read_snapshot(ledger(spark, root), "r")
    assert copy.columns == schema.names and run["rows"] == copy.count()
    empty = scratch()
    spark.read.parquet(path).limit(0).write.parquet(empty)
    done = ingest_files(spark, empty, scratch(), "r", "empty").first()
    assert done["rows"] == 0 and done["status"] == "succeeded"
