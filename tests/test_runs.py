from datetime import datetime

from pyspark.sql import functions as F

from rangehaul.operators import runs as R
from rangehaul.sinks.ledger import run_conflicts

TASKS = (
    "chunks bigint, batches bigint, rows bigint, bytes bigint, connect double, fetch double, wall_seconds double, started_at double, finished_at double"
)


def test_task_summary_keeps_span_apart_from_sums(spark):
    tasks = spark.createDataFrame(
        [(1, 2, 100, 1000, 0.1, 4.0, 10.0, 100.0, 110.0), (1, 3, 200, 2000, 0.2, 5.0, 12.0, 101.0, 113.0)], TASKS
    )
    row = R.task_summary(tasks, ["connect", "fetch"]).first()
    assert (row["tasks"], row["rows"], row["bytes"], row["batches"]) == (2, 300, 3000, 5)
    assert row["fetch_sum"] == 9.0 and row["wall_seconds_max"] == 12.0 and row["span_seconds"] == 13.0
    assert row["rows_per_second"] == 300 / 13.0
    empty = R.task_summary(tasks.filter("rows > 999"), ["connect"]).first()
    assert (empty["tasks"], empty["rows"], empty["connect_sum"], empty["span_seconds"], empty["rows_per_second"]) == (0, 0, 0.0, 0.0, 0.0)


def test_throughput_and_amplification_have_floors(spark):
    runs = spark.createDataFrame([(10, 100, 0.0), (10, 100, 2.0)], "rows bigint, output_bytes bigint, seconds double")
    assert [r["rows_per_second"] for r in R.throughput(runs).collect()] == [10 / 1e-9, 5.0]
    staged = spark.createDataFrame([("a", 100), ("b", 50)], "run_id string, size bigint")
    published = spark.createDataFrame([("a", 100, "rewrite"), ("c", 10, "zero_copy")], "run_id string, size bigint, mode string")
    got = {r["run_id"]: r["amplification"] for r in R.write_amplification(staged, published).collect()}
    assert got == {"a": 2.0, "b": 50.0, "c": 0.0}


def brute_rate(samples):
    """Steps of one sorted series, by the minute of the later sample."""
    out, last = {}, None
    for ts, value in sorted(samples):
        step = 0 if last is None else (value - last if value >= last else value)
        minute = ts.replace(second=0, microsecond=0)
        out[minute] = out.get(minute, 0) + step
        last = value
    return out


def test_rate_across_minutes_and_resets(spark):
    at = lambda m, s: datetime(2025, 1, 1, 0, m, s)
    one = [(at(0, 1), 5), (at(0, 30), 9), (at(0, 59), 2), (at(2, 0), 7), (at(2, 1), 7), (at(5, 0), 1)]
    two = [(at(0, 2), 100), (at(2, 10), 160)]
    rows = [("p", "one", *s) for s in one] + [("p", "two", *s) for s in two]
    frame = spark.createDataFrame(rows, "pod string, container string, ts timestamp_ntz, value bigint")
    got = {r["minute"]: r["increase"] for r in R.rate_per_minute(frame, ["pod", "container"], ["pod"]).collect()}
    expected = brute_rate(one)
    for minute, step in brute_rate(two).items():
        expected[minute] = expected.get(minute, 0) + step
    assert got == expected


def test_gauges_progress_selection(spark):
    at = lambda s: datetime(2025, 1, 1, 0, 0, s)
    frame = spark.createDataFrame(
        [("p", "a", at(1), 5), ("p", "a", at(2), 1), ("p", "b", at(1), 7), ("q", "a", at(1), 3)], "pod string, container string, ts timestamp_ntz, value bigint"
    )
    assert {r["pod"]: r["value"] for r in R.gauge_by_group(frame, ["pod", "container"], ["pod"]).collect()} == {"p": 8, "q": 3}
    assert {r["pod"] for r in R.label_values(frame, "pod").collect()} == {"p", "q"}
    # A pattern matches the whole label, alternatives included.
    names = spark.createDataFrame([("a",), ("ab",), ("b",), ("ba",)], "x string")
    assert {r["x"] for r in R.select_series(names, {"x": "a|b"}).collect()} == {"a", "b"}
    assert R.select_series(names, {"x": ".*", "y": None}).count() == 4
    chunks = spark.createDataFrame([("t", True), ("t", False), ("t", True), ("u", False)], "table string, ok boolean")
    got = {r["table"]: (r["done"], r["total"], r["percent"]) for r in R.progress_pct(chunks, F.col("ok")).collect()}
    assert got["u"] == (0, 1, 0.0) and got["t"][:2] == (2, 3)


def test_latest_runs_compared_and_reported(spark):
    ddl = "run_id string, engine string, read_mode string, profile string, `table` string, started_at string, rows bigint, seconds double, source_estimated_bytes bigint, output_bytes bigint, partitions int, strategy string"
    runs = spark.createDataFrame(
        [("1", "spark", "jdbc", "small", "wide", "2025-01-01", 100, 1.0, 1 << 20, 1 << 19, 4, "h"),
         ("2", "spark", "jdbc", "small", "wide", "2025-01-02", 100, 2.0, 1 << 20, 1 << 19, 4, "h"),
         ("3", "spark", "arrow", "small", "wide", "2025-01-01", 100, 0.5, 1 << 20, 1 << 19, 4, "h"),
         ("4", "spark", "jdbc", "small", "tiny", "2025-01-01", 100, 0.5, 1 << 20, 1 << 19, 1, "s")],
        ddl,
    )
    latest = R.latest_run(R.throughput(runs))
    assert {r["run_id"] for r in latest.collect()} == {"2", "3", "4"}
    assert [tuple(r) for r in R.compare_modes(latest, "jdbc", "arrow").collect()] == [("small", "wide", 50.0, 200.0, 4.0)]
    report = R.benchmark_report(latest).collect()
    assert [r["table"] for r in report] == ["wide", "tiny", "wide"] and report[0]["source_mib"] == 1.0 and report[0]["rows_per_second"] == 200.0


def test_long_metrics(spark):
    runs = spark.createDataFrame(
        [("r1", 10, 2.5, {"planning": 1.0, "read_write": 3.0}), ("r2", 0, 0.0, None)], "run_id string, rows bigint, rate double, durations_seconds map<string,double>"
    )
    got = sorted((r["metric"], r["labels"]["run_id"], r["labels"].get("phase"), r["value"]) for r in R.metrics_long(runs, ["rows", "rate"], ["run_id"]).collect())
    assert [g for g in got if g[0] == "duration_seconds"] == [("duration_seconds", "r1", "planning", 1.0), ("duration_seconds", "r1", "read_write", 3.0)]
    assert len(got) == 6


def test_phases_versions_conflicts(spark):
    docs = spark.createDataFrame([({"a": 1.0, "b": 2.0},), ({"a": 3.0},), (None,)], "durations_seconds map<string,double>")
    assert {r["phase"]: r["seconds"] for r in R.phase_totals(docs).collect()} == {"a": 4.0, "b": 2.0}
    versions = spark.createDataFrame([("t", 1), ("t", 3), ("u", 2)], "table string, version bigint")
    assert {(r["table"], r["version"]) for r in R.latest_version(versions).collect()} == {("t", 3), ("u", 2)}
    pair = "run_id string, request_hash string"
    known = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1")], pair)
    asked = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], pair)
    assert {r["run_id"]: r["status"] for r in run_conflicts(known, asked).collect()} == {"a": "repeat", "b": "conflict", "c": "new"}


def test_metric_text_is_escaped(spark):
    runs = spark.createDataFrame([('a"b\\c\nd', 5, {"fetch": 1.5}, None)], "run_id string, rows bigint, reader map<string,double>, bytes bigint")
    long = R.metrics_long(runs, ["rows", "bytes"], ["run_id"], {"reader": "reader_"}, {"plan_info": ["rows"]})
    lines = sorted(r["value"] for r in R.metrics_text(long, "x_").collect())
    label = 'run_id="a\\"b\\\\c\\nd"'
    assert lines == [f'x_duration_seconds{{{label},phase="reader_fetch"}} 1.5', f'x_plan_info{{{label},rows="5"}} 1.0', f"x_rows{{{label}}} 5.0"]
