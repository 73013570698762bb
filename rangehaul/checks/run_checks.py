"""Run metrics: events stand in for runs, tasks and metric samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rangehaul.checks.manifest_checks import k_of
from rangehaul.checks.registry import check, table
from rangehaul.operators import runs as R

_MONEY = "CAST(round(value, 2) AS DECIMAL(18,2))"


def _money():
    """Two-decimal values are summed exactly, whatever the order of rows."""
    return F.round("value", 2).cast("decimal(18,2)")


def _epoch(ts: str = "ts"):
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts)) / F.lit(1e6)


@check(
    "task_summary",
    f"""
    WITH t AS (SELECT user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, {_MONEY} AS v, value,
                      epoch_us(ts) / 1e6 AS s, epoch_us(ts) / 1e6 + value AS f FROM events),
    a AS (SELECT user_id, count(*) AS tasks, count(*) AS chunks, CAST(sum(k % 5) AS BIGINT) AS batches, CAST(sum(k) AS BIGINT) AS rows,
                 CAST(sum(k * 1000) AS BIGINT) AS bytes, CAST(sum(v) AS DOUBLE) AS fetch_seconds_sum,
                 CAST(sum(v * 2) AS DOUBLE) AS encode_seconds_sum, max(value) AS wall_seconds_max, max(f) - min(s) AS span_seconds
          FROM t GROUP BY user_id)
    SELECT *, CAST(rows AS DOUBLE) / greatest(span_seconds, 1e-9) AS rows_per_second,
           CAST(bytes AS DOUBLE) / greatest(span_seconds, 1e-9) AS bytes_per_second FROM a
    """,
)
def task_summary(spark, sf):
    k = k_of()
    tasks = table(spark, sf, "events").select(
        "user_id",
        F.lit(1).cast("bigint").alias("chunks"),
        (k % 5).alias("batches"),
        k.alias("rows"),
        (k * 1000).alias("bytes"),
        _money().alias("fetch_seconds"),
        (_money() * 2).alias("encode_seconds"),
        F.col("value").alias("wall_seconds"),
        _epoch().alias("started_at"),
        (_epoch() + F.col("value")).alias("finished_at"),
    )
    return R.task_summary(tasks, ["fetch_seconds", "encode_seconds"], ["user_id"])


@check(
    "throughput",
    """
    WITH r AS (SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) * 1000 AS rows,
                      CASE WHEN event_type = 'error' THEN 0 ELSE value END AS seconds FROM events)
    SELECT event_id, rows, rows * 8 AS output_bytes, seconds, rows / greatest(seconds, 1e-9) AS rows_per_second,
           (rows * 8) / greatest(seconds, 1e-9) AS bytes_per_second FROM r
    """,
)
def throughput(spark, sf):
    rows = k_of() * 1000
    seconds = F.when(F.col("event_type") == "error", 0.0).otherwise(F.col("value"))
    return R.throughput(
        table(spark, sf, "events").select("event_id", rows.alias("rows"), (rows * 8).alias("output_bytes"), seconds.alias("seconds"))
    )


@check(
    "write_amplification",
    """
    WITH s AS (SELECT l_orderkey % 500 AS run_id, CAST(sum(CAST(floor(l_extendedprice) AS BIGINT)) AS BIGINT) AS staging_bytes
               FROM lineitem GROUP BY 1),
    p AS (SELECT o_orderkey % 510 AS run_id, CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS BIGINT) AS output_bytes,
                 CAST(sum(CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS BIGINT) ELSE 0 END) AS BIGINT) AS rewritten_bytes
          FROM orders GROUP BY 1)
    SELECT coalesce(s.run_id, p.run_id) AS run_id, coalesce(staging_bytes, 0) AS staging_bytes, coalesce(output_bytes, 0) AS output_bytes,
           coalesce(rewritten_bytes, 0) AS rewritten_bytes,
           CAST(coalesce(staging_bytes, 0) + coalesce(rewritten_bytes, 0) AS DOUBLE) / greatest(coalesce(output_bytes, 0), 1) AS amplification
    FROM s FULL JOIN p ON s.run_id = p.run_id
    """,
)
def write_amplification(spark, sf):
    staged = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") % 500).alias("run_id"), F.floor("l_extendedprice").alias("size")
    )
    published = table(spark, sf, "orders").select(
        (F.col("o_orderkey") % 510).alias("run_id"),
        F.floor("o_totalprice").alias("size"),
        F.when(F.col("o_orderstatus") == "F", "rewrite").otherwise("zero_copy").alias("mode"),
    )
    return R.write_amplification(staged, published)


@check(
    "phase_totals",
    f"""
    WITH d AS (SELECT user_id % 3 AS t, event_type, {_MONEY} AS v FROM events)
    SELECT t AS "table", 'fetch' AS phase, CAST(sum(v) AS DOUBLE) AS seconds FROM d GROUP BY t
    UNION ALL SELECT t, event_type, CAST(sum(v * 3) AS DOUBLE) FROM d GROUP BY ALL
    """,
)
def phase_totals(spark, sf):
    documents = table(spark, sf, "events").select(
        (F.col("user_id") % 3).alias("table"),
        F.create_map(F.lit("fetch"), _money(), F.col("event_type"), (_money() * 3).cast("decimal(18,2)")).alias("durations_seconds"),
    )
    totals = R.phase_totals(documents, by=["table"])
    return totals.withColumn("seconds", F.col("seconds").cast("double"))


@check(
    "max_by_group",
    'SELECT event_type AS engine, user_id % 5 AS "table", max(value) AS value FROM events GROUP BY ALL',
)
def max_by_group(spark, sf):
    samples = table(spark, sf, "events").select(
        F.col("event_type").alias("engine"), (F.col("user_id") % 5).alias("table"), "value"
    )
    return R.max_by_group(samples, ["engine", "table"])


def _samples(spark, sf) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "ts", "event_type", "user_id", _money().alias("value"))


@check(
    "rate_per_minute",
    f"""
    WITH s AS (SELECT event_type, user_id, ts, {_MONEY} AS v,
                      lag({_MONEY}) OVER (PARTITION BY event_type, user_id % 4 ORDER BY ts, event_id) AS p FROM events)
    SELECT event_type, date_trunc('minute', ts) AS minute,
           CAST(sum(CASE WHEN p IS NULL THEN 0 WHEN v >= p THEN v - p ELSE v END) AS DOUBLE) AS increase,
           CAST(sum(CASE WHEN p IS NULL THEN 0 WHEN v >= p THEN v - p ELSE v END) AS DOUBLE) / 60.0 AS per_second
    FROM s GROUP BY ALL
    """,
)
def rate_per_minute(spark, sf):
    samples = _samples(spark, sf).withColumn("pod", F.col("user_id") % 4)
    rates = R.rate_per_minute(samples, ["event_type", "pod"], ["event_type"], tie="event_id")
    return rates.withColumn("increase", F.col("increase").cast("double"))


@check(
    "gauge_by_group",
    f"""
    WITH l AS (SELECT event_type, user_id, {_MONEY} AS v FROM events
               QUALIFY row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) = 1)
    SELECT event_type, CAST(sum(v) AS DOUBLE) AS value FROM l GROUP BY 1
    """,
)
def gauge_by_group(spark, sf):
    samples = _samples(spark, sf).withColumn("at", F.struct("ts", "event_id"))
    sums = R.gauge_by_group(samples, ["event_type", "user_id"], ["event_type"], ts="at")
    return sums.withColumn("value", F.col("value").cast("double"))


@check(
    "progress_pct",
    """
    SELECT user_id % 3 AS "table", count(*) FILTER (event_type <> 'error') AS done, count(*) AS total,
           100.0::DOUBLE * count(*) FILTER (event_type <> 'error') / count(*) AS percent
    FROM events GROUP BY 1
    """,
)
def progress_pct(spark, sf):
    chunks = table(spark, sf, "events").select((F.col("user_id") % 3).alias("table"), "event_type")
    return R.progress_pct(chunks, F.col("event_type") != "error")


@check(
    "select_series",
    """
    SELECT event_id, event_type, 'table_' || user_id AS "table" FROM events
    WHERE regexp_full_match(event_type, 'click|v.*') AND regexp_full_match('table_' || user_id, 'table_[0-4]?[0-9]')
    """,
)
def select_series(spark, sf):
    samples = table(spark, sf, "events").select(
        "event_id", "event_type", F.concat(F.lit("table_"), F.col("user_id")).alias("table")
    )
    return R.select_series(samples, {"event_type": "click|v.*", "table": "table_[0-4]?[0-9]", "event_id": ".*"})


@check("label_values", "SELECT DISTINCT event_type FROM events")
def label_values(spark, sf):
    return R.label_values(table(spark, sf, "events"), "event_type")


# --- runs ---

_RUNS_SQL = """
runs AS (SELECT event_id AS run_id, CASE WHEN event_type = 'purchase' THEN 'direct' ELSE 'spark' END AS engine,
                CASE event_type WHEN 'view' THEN 'jdbc' WHEN 'click' THEN 'arrow' ELSE event_type END AS read_mode,
                'p' || (user_id % 3) AS profile, 't' || user_id AS "table", ts AS started_at,
                (CAST(json_extract(props, '$.k') AS BIGINT) + 1) * 1000 AS rows, value AS seconds FROM events),
latest AS (SELECT *, rows / greatest(seconds, 1e-9) AS rate FROM runs
           QUALIFY row_number() OVER (PARTITION BY engine, read_mode, profile, "table" ORDER BY started_at DESC, run_id DESC) = 1)"""


def event_runs(spark, sf) -> DataFrame:
    kind = F.col("event_type")
    rows = (k_of() + 1) * 1000
    return table(spark, sf, "events").select(
        F.col("event_id").alias("run_id"),
        F.when(kind == "purchase", "direct").otherwise("spark").alias("engine"),
        F.when(kind == "view", "jdbc").when(kind == "click", "arrow").otherwise(kind).alias("read_mode"),
        F.concat(F.lit("p"), F.col("user_id") % 3).alias("profile"),
        F.concat(F.lit("t"), F.col("user_id")).alias("table"),
        F.col("ts").alias("started_at"),
        rows.alias("rows"),
        F.col("value").alias("seconds"),
        (rows * 100).alias("source_estimated_bytes"),
        (rows * 33).alias("output_bytes"),
        F.lit(8).alias("partitions"),
        F.lit("histogram_ranges").alias("strategy"),
    )


@check(
    "latest_run",
    f'WITH {_RUNS_SQL} SELECT run_id, engine, read_mode, profile, "table", started_at, rows, seconds FROM latest',
)
def latest_run(spark, sf):
    return R.latest_run(event_runs(spark, sf)).select(
        "run_id", "engine", "read_mode", "profile", "table", "started_at", "rows", "seconds"
    )


@check(
    "compare_modes",
    f"""
    WITH {_RUNS_SQL}
    SELECT profile, "table", a.rate AS base_rate, b.rate AS other_rate, b.rate / greatest(a.rate, 1e-9) AS ratio
    FROM latest a JOIN latest b USING (profile, "table") WHERE a.read_mode = 'jdbc' AND b.read_mode = 'arrow'
    """,
)
def compare_modes(spark, sf):
    latest = R.latest_run(R.throughput(event_runs(spark, sf)))
    return R.compare_modes(latest, "jdbc", "arrow")


@check(
    "benchmark_report",
    f"""
    WITH {_RUNS_SQL}
    SELECT engine, read_mode, profile, "table", rows, round(rows * 100 / 1048576.0, 2) AS source_mib,
           round(rows * 33 / 1048576.0, 2) AS output_mib, 8 AS partitions, 'histogram_ranges' AS strategy,
           round(seconds, 2) AS seconds, round(rate, 1) AS rows_per_second
    FROM latest
    """,
)
def benchmark_report(spark, sf):
    return R.benchmark_report(R.latest_run(event_runs(spark, sf)))


@check(
    "latest_version",
    'SELECT o_custkey AS "table", max(o_orderkey) AS version FROM orders GROUP BY 1',
)
def latest_version(spark, sf):
    versions = table(spark, sf, "orders").select(F.col("o_custkey").alias("table"), F.col("o_orderkey").alias("version"))
    return R.latest_version(versions)


@check(
    "metrics_long",
    f"""
    WITH {_RUNS_SQL},
    m AS (SELECT run_id, engine, "table", 'rows' AS metric, NULL AS phase, CAST(rows AS DOUBLE) AS value FROM runs
          UNION ALL SELECT run_id, engine, "table", 'output_bytes', NULL, CAST(rows * 33 AS DOUBLE) FROM runs
          UNION ALL SELECT run_id, engine, "table", 'duration_seconds', 'read_write', seconds FROM runs
          UNION ALL SELECT run_id, engine, "table", 'duration_seconds', 'planning', seconds / 4 FROM runs)
    SELECT CAST(run_id AS VARCHAR) AS run_id, engine, "table", metric, phase, value FROM m
    """,
)
def metrics_long(spark, sf):
    runs = event_runs(spark, sf).withColumn(
        "durations_seconds", F.create_map(F.lit("read_write"), F.col("seconds"), F.lit("planning"), F.col("seconds") / 4)
    )
    rows = R.metrics_long(runs, ["rows", "output_bytes"], ["run_id", "engine", "table"])
    label = lambda name: F.try_element_at("labels", F.lit(name)).alias(name)
    return rows.select(label("run_id"), label("engine"), label("table"), "metric", label("phase"), "value")


@check(
    "metrics_text",
    f"""
    WITH {_RUNS_SQL}
    SELECT 'load_rows{{run_id="' || run_id || '",engine="' || engine || '"}} ' || rows || '.0' AS value FROM runs
    UNION ALL
    SELECT 'load_plan_info{{run_id="' || run_id || '",engine="' || engine || '",strategy="histogram_ranges",read_mode="' || read_mode || '"}} 1.0' FROM runs
    """,
)
def metrics_text(spark, sf):
    runs = event_runs(spark, sf)
    rows = R.metrics_long(runs, ["rows"], ["run_id", "engine"], {}, {"plan_info": ["strategy", "read_mode"]})
    return R.metrics_text(rows, "load_")
