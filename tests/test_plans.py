"""What Spark makes of the operators: pushed filters, columns read, exchanges."""

import re

from pyspark.sql import functions as F

from rangehaul.operators import manifests as M, ranges as R, reconcile as V, runs
from rangehaul.operators.profile import column_bounds, split_candidates
from rangehaul.operators.snapshot import snapshot_as_of


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def lines(spark, data):
    return spark.read.parquet(f"{data}/lineitem.parquet")


def read_columns(plan):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)))


def test_assignment_does_not_shuffle(spark, data):
    for cuts in ([5, 9], list(range(0, 1000, 5))):
        plan = plan_of(R.assign_ranges(lines(spark, data), "l_orderkey", cuts))
        assert "Exchange" not in plan and "PythonUDF" not in plan


def test_counts_read_the_key_only(spark, data):
    counts = R.range_counts(R.assign_ranges(lines(spark, data), "l_orderkey", list(range(0, 1000, 5))))
    plan = plan_of(counts)
    assert read_columns(plan) == {"l_orderkey"} and "partial_count" in plan
    assert read_columns(plan_of(column_bounds(lines(spark, data), ["l_shipdate"]))) == {"l_shipdate"}


def test_fingerprint_moves_one_row_per_task(spark, data):
    plan = plan_of(V.table_checksum(lines(spark, data)))
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "SortAggregate" not in plan


def test_range_predicates_reach_the_scan(spark, data):
    points = spark.createDataFrame([("t", "l_orderkey", 100), ("t", "l_orderkey", 700)], "table string, column string, boundary bigint")
    ranges = [r["predicate"] for r in R.range_predicates(points, True).orderBy("chunk").collect()]
    plan = plan_of(lines(spark, data).filter(F.expr(ranges[1])))
    assert "GreaterThanOrEqual(l_orderkey,100)" in plan and "LessThan(l_orderkey,700)" in plan
    both = plan_of(lines(spark, data).filter(F.expr(f"({ranges[0]}) OR ({ranges[2]})")))
    assert re.search(r"PushedFilters: \[Or\(", both)


def test_snapshot_filter_is_pushed_and_limited(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet")
    plan = plan_of(snapshot_as_of(events, F.lit("2024-01-15").cast("timestamp_ntz"), ["user_id"], "ts", "event_id"))
    assert "LessThanOrEqual(ts," in plan and "WindowGroupLimit" in plan


def test_no_nested_loops(spark, data):
    steps = spark.createDataFrame([("t", "c", 1, 0.0, 1.0), ("t", "c", 9, 7.0, 1.0)], "table string, column string, high bigint, range_rows double, equal_rows double")
    objects = spark.createDataFrame([("b", "k")], "bucket string, key string")
    manifests = spark.createDataFrame([("r", 0, "a", [("b", "k", 1)])], "run_id string, index int, attempt_id string, files array<struct<bucket:string,key:string,size:bigint>>")
    metrics = spark.createDataFrame([("r", 1, {"p": 1.0})], "run_id string, rows bigint, durations_seconds map<string,double>")
    for frame in (R.histogram_boundaries(steps, 8), M.valid_manifests(manifests, objects), runs.metrics_long(metrics, ["rows"], ["run_id"])):
        plan = plan_of(frame)
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "Exchange" not in plan_of(runs.metrics_long(metrics, ["rows"], ["run_id"]))


def test_discovered_columns_lead_to_a_key(spark):
    ddl = "table string, column_id int, column string, sql_type string, nullable boolean, precision int, scale int, index_name string, clustered boolean, is_unique boolean, primary_key boolean"
    found = spark.createDataFrame([("T", 1, "A", "bigint", False, 18, 0, "PK", False, True, True), ("T", 2, "B", "bigint", False, 18, 0, None, False, False, False)], ddl)
    assert R.choose_split_key(split_candidates(found)).first()["column"] == "A"
