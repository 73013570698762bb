from pyspark.sql import functions as F

from rangehaul.operators import manifests as M
from rangehaul.operators.snapshot import snapshot_as_of

DDL = "run_id string, index int, attempt_id string, files array<struct<bucket:string,key:string,size:bigint>>, rows bigint, completed_at string"


def manifests(spark):
    f = lambda *keys: [("b", k, 1) for k in keys]
    return spark.createDataFrame(
        [
            ("r", 0, "p2", f("k1", "k2"), 5, "2025-01-02"),
            ("r", 0, "p1", f("k1"), 5, "2025-01-02"),
            ("r", 0, "p0", f("k1", "gone"), 5, "2025-01-01"),
            ("r", 1, "q", [], 0, None),
            ("r", 2, "s", None, 0, "2025-01-01"),
            ("r", 3, "u", f("k3"), 1, "2025-01-05"),
            ("r", 3, "v", f("k3"), 1, None),
            ("other", 0, "w", f("k4"), 1, "2025-01-01"),
        ],
        DDL,
    )


def objects(spark):
    return spark.createDataFrame([("b", f"k{i}", 1) for i in range(1, 6)], "bucket string, key string, size bigint")


def test_valid_selected_missing_pending(spark):
    valid = M.valid_manifests(manifests(spark), objects(spark))
    assert {r["attempt_id"] for r in valid.collect()} == {"p2", "p1", "q", "u", "v", "w"}
    selected = M.select_manifests(valid)
    assert {(r["run_id"], r["index"]): r["attempt_id"] for r in selected.collect()} == {
        ("r", 0): "p1", ("r", 1): "q", ("r", 3): "v", ("other", 0): "w",
    }
    plans = spark.createDataFrame([("r", 5), ("empty", 0)], "run_id string, chunk_count int")
    assert sorted(map(tuple, M.missing_chunks(plans, valid).collect())) == [("r", 2), ("r", 4)]
    ranges = M.planned_chunks(plans).withColumnRenamed("index", "chunk")
    assert sorted(r["chunk"] for r in M.pending_chunks(ranges, valid).collect()) == [2, 4]
    planned = spark.createDataFrame([("r", 0)], "run_id string, index int")
    assert {r["attempt_id"] for r in M.valid_manifests(manifests(spark), objects(spark), planned).collect()} == {"p1", "p2"}


def test_active_and_orphan_files(spark):
    valid = M.valid_manifests(manifests(spark), objects(spark))
    orphans = M.orphan_files(objects(spark), M.select_manifests(valid))
    assert {r["key"] for r in orphans.collect()} == {"k2", "k5"}
    snapshot = spark.createDataFrame([("b", "k1"), ("c", "k2")], "bucket string, key string")
    assert {r["key"] for r in M.active_files(objects(spark), snapshot).collect()} == {"k1"}


def test_relative_paths(spark):
    files = spark.createDataFrame(
        [("lake", "t/_staging/chunks/00000/data.parquet"), ("lake", "tt/x.parquet"), ("other", "t/x.parquet")], "bucket string, key string"
    )
    for root in ("t", "t/"):
        got = [r["path"] for r in M.relative_paths(files, F.lit(root), F.lit("lake")).collect()]
        assert got == ["_staging/chunks/00000/data.parquet", None, None]


def test_progress_counts_each_chunk_once(spark):
    keys = ["c/chunks/00001/attempts/a/manifest.json", "c/chunks/00001/attempts/b/manifest.json", "chunks/00012/attempts/b/manifest.json",
            "c/chunks/00002/attempts/b/other.json", "c/chunks/002/attempts/b/manifest.json"]
    stored = spark.createDataFrame([("b", k) for k in keys], "bucket string, key string")
    assert [tuple(r) for r in M.completed_chunks(stored).collect()] == [("b", 2)]


def test_retries_and_latest(spark):
    attempts = spark.createDataFrame([(0,), (0,), (0,), (1,), (2,), (2,)], "worker int")
    assert M.retry_count(attempts, ["worker"]).first()["retries"] == 3
    assert M.retry_count(attempts.filter("worker > 5"), ["worker"]).first()["retries"] == 0
    docs = spark.createDataFrame([("k", 1.0, "a", 10), ("k", 2.0, "b", 20), ("m", 1.0, "c", 30)], "key string, finished double, id string, rows int")
    assert sorted(r["rows"] for r in M.latest_attempt(docs, ["key"], "finished", "id").collect()) == [20, 30]


def test_snapshot_at_a_boundary(spark):
    rows = spark.createDataFrame([("k", 1, "a"), ("k", 3, "b"), ("k", 9, "c"), ("late", 8, "d")], "key string, ts int, v string")
    assert [r["v"] for r in snapshot_as_of(rows, F.lit(5), ["key"]).collect()] == ["b"]


def test_first_per_key_limits_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 2).alias("k"), "id")
    plan = M.first_per_key(frame, ["k"], F.col("id"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
