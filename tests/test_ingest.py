import pytest
from pyspark.sql import Row, functions as F

from rangehaul.plans import ingest as I
from rangehaul.operators.profile import column_histogram
from rangehaul.plans.ingest import IngestOptions, ingest, plan_ranges, reconcile
from rangehaul.plans.jdbc_load import plan_from_catalog, planned_fetch_rows
from rangehaul.sinks import snapshots as S
from rangehaul.sinks.ledger import Ledger, RunConflict, canonical


def orders(spark, data):
    return spark.read.parquet(f"{data}/orders.parquet")


def same_rows(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def load(root, ledger_name="ledger"):
    return f"{root}/{ledger_name}"


def test_load_publishes_once(spark, data, scratch):
    root, source = scratch(), orders(spark, data)
    options = IngestOptions(ranges=5)
    run = ingest(source, root, "r1", "orders", "o_orderkey", options).first()
    assert run["status"] == "succeeded" and run["rows"] == source.count() == run["source_rows"]
    assert run["strategy"] == "histogram_ranges" and run["partitions"] == 5 and run["mode"] == "zero_copy"
    assert {"planning", "extraction", "publication", "validation", "engine_total"} <= set(run["durations_seconds"])
    ledger = Ledger(spark, load(root))
    assert same_rows(S.read_snapshot(ledger, "r1", source.schema), source)
    # The same request again returns the stored result and writes nothing.
    again = ingest(source, root, "r1", "orders", "o_orderkey", options).first()
    assert again == run and ledger.read("manifests").count() == 5
    with pytest.raises(RunConflict):
        ingest(source, root, "r1", "orders", "o_orderkey", IngestOptions(ranges=6))
    assert {r["status"] for r in reconcile(source, root, "r1", "o_orderkey", options).collect()} == {"equal"}
    # A second run of the table is the next version.
    ingest(source, root, "r2", "orders", "o_orderkey", options)
    versions = {r["run_id"]: r["version"] for r in ledger.read("snapshots").collect()}
    assert versions == {"r1": 1, "r2": 2}


def test_failed_run_is_recorded_and_continues(spark, data, scratch, monkeypatch):
    root, source = scratch(), orders(spark, data)
    options = IngestOptions(ranges=4)

    def broken(*_):
        raise OSError("storage is away")

    with monkeypatch.context() as patch:
        patch.setattr(I, "_publish", broken)
        with pytest.raises(OSError):
            ingest(source, root, "r", "orders", "o_orderkey", options)
    ledger = Ledger(spark, load(root))
    failed = ledger.read("runs").first()
    assert failed["status"] == "failed" and failed["error_type"] == "OSError" and failed["success"] == 0
    attempts = {r["attempt_id"] for r in ledger.read("manifests").collect()}
    run = ingest(source, root, "r", "orders", "o_orderkey", options).first()
    assert run["status"] == "succeeded" and run["rows"] == source.count()
    assert {r["attempt_id"] for r in ledger.read("manifests").collect()} == attempts


def test_resume_reads_only_pending_ranges(spark, data, scratch, monkeypatch):
    first, second, source = scratch(), scratch(), orders(spark, data)
    options = IngestOptions(ranges=6)
    monkeypatch.setattr(I, "_publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        ingest(source, first, "r", "orders", "o_orderkey", options)
    monkeypatch.undo()
    # A ledger that lost the manifests of four chunks.
    before, after = Ledger(spark, load(first)), Ledger(spark, load(second))
    for name in ("requests", "plans"):
        after.append(name, before.read(name))
    after.append("manifests", before.read("manifests").filter(F.col("index").isin(1, 4)))
    run = ingest(source, second, "r", "orders", "o_orderkey", options).first()
    assert run["rows"] == source.count()
    kept = {r["index"]: r["attempt_id"] for r in after.read("manifests").collect()}
    assert len(kept) == 6 and len(set(kept.values())) == 2 and kept[1] == kept[4] != kept[0]
    assert same_rows(S.read_snapshot(after, "r", source.schema), source)


def test_damage_is_found(spark, data, scratch, monkeypatch):
    source = orders(spark, data)
    real = S.read_chunks
    monkeypatch.setattr(I.sink, "read_chunks", lambda *a: real(*a).withColumn("o_totalprice", F.col("o_totalprice") + 1))
    with pytest.raises(RuntimeError, match="differs"):
        ingest(source, scratch(), "r", "orders", "o_orderkey", IngestOptions(ranges=3))
    monkeypatch.setattr(I.sink, "read_chunks", lambda *a: real(*a).limit(10))
    with pytest.raises(RuntimeError, match="10 rows"):
        ingest(source, scratch(), "r", "orders", "o_orderkey", IngestOptions(ranges=3, validation="metadata"))


@pytest.mark.parametrize("publication", ["auto", "rewrite"])
def test_empty_table_and_null_keys(spark, scratch, publication):
    empty = spark.createDataFrame([], "k bigint, v string")
    root = scratch()
    run = ingest(empty, root, "e", "t", "k", IngestOptions(ranges=3, publication=publication)).first()
    assert run["rows"] == 0 and run["success"] == 1
    assert S.read_snapshot(Ledger(spark, load(root)), "e").schema.names == ["k", "v"]
    rows = spark.createDataFrame([(None if i % 3 == 0 else i, str(i)) for i in range(300)], "k bigint, v string")
    run = ingest(rows, root, "n", "t", "k", IngestOptions(ranges=4, publication=publication, files=2)).first()
    assert run["rows"] == 300
    assert same_rows(S.read_snapshot(Ledger(spark, load(root)), "n", rows.schema), rows)


def test_range_without_rows_is_done(spark, scratch, monkeypatch):
    source = spark.range(100).withColumnRenamed("id", "k")
    plan = I.RangePlan("histogram_ranges", "k", (50, 1000), ("`k` < 50 OR `k` IS NULL", "`k` >= 50 AND `k` < 1000", "`k` >= 1000"), 3, 100)
    monkeypatch.setattr(I, "plan_ranges", lambda *_: plan)
    root = scratch()
    assert ingest(source, root, "r", "t", "k", IngestOptions(ranges=3)).first()["rows"] == 100
    rows = {r["index"]: (r["rows"], r["files"]) for r in Ledger(spark, load(root)).read("manifests").collect()}
    assert rows[2] == (0, 0) and rows[0][0] == rows[1][0] == 50


def partition_per_predicate(source):
    """Stands in for a database: a frame with one partition per predicate, in their order."""

    def read(predicates):
        read.calls.append(list(predicates))
        frames = [source.filter(p).coalesce(1) for p in predicates]
        whole = frames[0]
        for frame in frames[1:]:
            whole = whole.union(frame)
        return whole

    read.calls = []
    return read


def catalog_plan(spark, source, rows):
    kinds = "table string, column string, position int, sql_type string, nullable boolean, index_id int, clustered boolean, is_unique boolean, primary_key boolean"
    profile = spark.createDataFrame([("t", "o_orderkey", 1, "bigint", True, 1, True, True, True), ("t", "o_custkey", 2, "bigint", True, None, False, False, False)], kinds)
    sizes = spark.createDataFrame([("t", rows, 1 << 30)], "table string, rows bigint, bytes bigint")
    steps = column_histogram(source, "o_orderkey", 20)
    return profile, sizes, steps


def test_database_ranges_resume(spark, data, scratch, monkeypatch):
    source, root = orders(spark, data), scratch()
    profile, sizes, steps = catalog_plan(spark, source, source.count())
    limits = I.PartitionLimits(task_slots=4)
    plan = plan_from_catalog(profile, sizes, steps, limits=limits, dialect="spark")
    assert plan.strategy == "histogram_ranges" and plan.ranges == 4 and plan.column == "o_orderkey"
    assert plan.predicates[0].endswith("IS NULL)")
    read = partition_per_predicate(source)
    schema_only = source.limit(0)
    monkeypatch.setattr(I, "_publish", lambda *_: 1 / 0)
    options = IngestOptions(require_source_match=False)
    with pytest.raises(ZeroDivisionError):
        ingest(schema_only, root, "r", "orders", "o_orderkey", options, plan, read)
    monkeypatch.undo()
    assert read.calls == [list(plan.predicates)]
    # Keep two of four manifests: only the other ranges are read again.
    other = scratch()
    before, after = Ledger(spark, load(root)), Ledger(spark, load(other))
    for name in ("requests", "plans"):
        after.append(name, before.read(name))
    after.append("manifests", before.read("manifests").filter(F.col("index").isin(0, 2)))
    run = ingest(schema_only, other, "r", "orders", "o_orderkey", options, plan, read).first()
    assert read.calls[1] == [plan.predicates[1], plan.predicates[3]]
    assert run["rows"] == source.count() and run["files"] == 4
    assert same_rows(S.read_snapshot(after, "r", source.schema), source)


def test_plans_from_a_catalog(spark, data):
    source = orders(spark, data)
    profile, sizes, steps = catalog_plan(spark, source, 10**6)
    bounds = source.agg(F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))
    limits = I.PartitionLimits(task_slots=4)
    assert plan_from_catalog(profile, sizes, None, bounds, limits).strategy == "indexed_ranges"
    assert plan_from_catalog(profile, sizes, steps, bounds, limits).predicates[1].startswith("[o_orderkey] >= ")
    assert plan_from_catalog(profile.filter("index_id IS NULL"), sizes, steps, bounds, limits).predicates == ("1=1",)
    assert plan_from_catalog(profile, sizes, None, None, limits).strategy == "single_scan"
    assert plan_from_catalog(profile, sizes, steps, bounds, I.PartitionLimits(task_slots=1)).column is None
    assert planned_fetch_rows(sizes, 4) == 15621


def test_sorted_source_is_not_shuffled(spark, data, scratch):
    source, root = orders(spark, data).sort("o_orderkey"), scratch()
    run = ingest(source, root, "r", "orders", "o_orderkey", IngestOptions(ranges=3, sorted_by_key=True)).first()
    assert run["rows"] == source.count() and run["partitions"] == 3


def test_hot_chunk_is_written_by_many_tasks(spark, scratch):
    """A chunk with most rows is split over several files."""
    hot = spark.range(0, 400_000, 1, 8).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 4).otherwise(7).cast("int").alias("chunk"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    path = scratch()
    previous = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        S.stage_chunks(hot, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", previous)
    files = S.chunk_files(spark, path).groupBy("chunk").agg(F.count("*").alias("n"), F.sum("rows").alias("rows"))
    got = {r["chunk"]: (r["n"], r["rows"]) for r in files.collect()}
    assert got[7][1] == 360_000 and got[7][0] > 3
    assert sum(r for _, r in got.values()) == 400_000


def test_plans(spark, data):
    source = orders(spark, data)
    assert plan_ranges(source, "o_orderkey", IngestOptions(source_bytes=1000)).strategy == "single_scan"
    assert plan_ranges(source, None, IngestOptions(ranges=4)).predicates == ("1=1",)
    flat = spark.range(100).select(F.lit(7).alias("k"))
    plan = plan_ranges(flat, "k", IngestOptions(ranges=4))
    assert plan.strategy == "single_scan" and plan.column == "k" and plan.source_rows == 100
    dated = plan_ranges(source, "o_orderdate", IngestOptions(ranges=4))
    assert dated.ranges == 4 and "TIMESTAMP_NTZ '" in dated.predicates[1]
    sized = plan_ranges(source, "o_orderkey", IngestOptions(limits=I.PartitionLimits(task_slots=8, target_bytes=20_000)))
    assert sized.requested > 1 and sized.ranges == sized.requested


def test_rewrite_and_existing(spark, data, scratch):
    source, root = orders(spark, data), scratch()
    run = ingest(source, root, "r", "orders", "o_orderkey", IngestOptions(ranges=4, publication="rewrite", files=2)).first()
    assert run["mode"] == "rewrite" and run["files"] == 2
    ledger = Ledger(spark, load(root))
    found = S.publish_existing(ledger, "r", source.count()).first()
    assert (found["mode"], found["rows"], found["files"]) == ("existing", source.count(), 2)
    with pytest.raises(RuntimeError, match="expected 5"):
        S.publish_existing(ledger, "r", 5)
    assert S.publish_existing(ledger, "unknown", 5) is None
    with pytest.raises(ValueError, match="not published"):
        S.read_snapshot(ledger, "unknown")


def test_snapshot_path_is_never_overwritten(spark, scratch):
    path = scratch()
    S.write_snapshot(spark.range(3), path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        S.write_snapshot(spark.range(4), path)
    S.replace_table(spark.range(4), path)
    assert spark.read.parquet(path).count() == 4


def test_writer_variants_agree(spark, data, scratch):
    variants = [S.Variant("a"), S.Variant("b", compression="zstd", partitions=1)]
    got = S.writer_matrix(orders(spark, data), scratch(), variants).collect()
    assert len({(r["rows"], r["checksum"]) for r in got}) == 1 and got[1]["files"] == 1 and got[1]["operation"] == "repartition"
    plain = S.writer_matrix(orders(spark, data), scratch(), variants[:1], isolate=False).first()
    assert plain["source_seconds"] == 0.0
    # A frame that gives other rows each time cannot pass.
    moving = spark.range(1000).withColumn("x", F.current_timestamp())
    with pytest.raises(RuntimeError, match="different rows"):
        S.writer_matrix(moving, scratch(), variants, isolate=False)


def test_canonical_requests():
    assert canonical({"b": 1, "a": {"y": None, "x": "ä"}}) == '{"a":{"x":"ä","y":null},"b":1}'


def test_failed_validation_publishes_nothing_and_heals(spark, data, scratch):
    source, root = orders(spark, data), scratch()
    with pytest.MonkeyPatch.context() as patch:
        real = S.read_chunks
        patch.setattr(I.sink, "read_chunks", lambda *a: real(*a).withColumn("o_totalprice", F.col("o_totalprice") + 1))
        with pytest.raises(I.ContentMismatch):
            ingest(source, root, "r", "orders", "o_orderkey", IngestOptions(ranges=3))
    assert I.Ledger(spark, f"{root}/ledger").read("snapshots").isEmpty()
    assert ingest(source, root, "r", "orders", "o_orderkey", IngestOptions(ranges=3)).first()["rows"] == source.count()


def test_lost_folder_is_staged_again(spark, data, scratch):
    import shutil

    source, root = orders(spark, data), scratch()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(I, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest(source, root, "r", "orders", "o_orderkey", IngestOptions(ranges=4))
    lost = I.Ledger(spark, f"{root}/ledger").read("manifests").filter("index = 2").first()["path"]
    shutil.rmtree(lost)
    assert ingest(source, root, "r", "orders", "o_orderkey", IngestOptions(ranges=4)).first()["rows"] == source.count()


def test_resume_keeps_close_float_keys(spark, scratch):
    source, root = spark.range(4000).select((F.lit(0.5) + F.col("id") * F.lit(1e-15)).alias("k")), scratch()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(I, "_publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            ingest(source, root, "r", "t", "k", IngestOptions(ranges=4))
    ledger = I.Ledger(spark, f"{root}/ledger")
    attempt = ledger.read("manifests").first()["attempt_id"]
    kept = ledger.read("manifests").filter("index % 2 = 0").collect()
    I._discard(ledger, "r", [Row(attempt_id=attempt)])
    again = [Row(**{**r.asDict(), "attempt_id": "kept"}) for r in kept]
    ledger.append("manifests", spark.createDataFrame(again, "run_id string, index int, attempt_id string, path string, rows bigint, bytes bigint, files bigint, completed_at string"))
    assert ingest(source, root, "r", "t", "k", IngestOptions(ranges=4)).first()["rows"] == 4000
