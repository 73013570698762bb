"""Streaming forms of progress and rate, run over the events that are there."""

from __future__ import annotations

from pyspark.sql import functions as F

from rangehaul.checks.registry import check, table
from rangehaul.session import scratch_path
from rangehaul.streaming.live import run_updates
from rangehaul.streaming.progress import progress_stream, rate_stream, run_available, stream_files


def _events(spark, sf):
    return stream_files(spark, sf, table(spark, sf, "events").schema, glob="events.parquet")


@check(
    "progress_stream",
    """
    SELECT user_id % 3 AS "table", count(*) FILTER (event_type <> 'error') AS done, count(*) AS total,
           100.0::DOUBLE * count(*) FILTER (event_type <> 'error') / count(*) AS percent
    FROM events GROUP BY 1
    """,
)
def progress(spark, sf):
    chunks = _events(spark, sf).select((F.col("user_id") % 3).alias("table"), "event_type")
    stream = progress_stream(chunks, F.col("event_type") != "error")
    base = scratch_path(spark, "progress")
    return run_available(stream, f"{base}/result", "complete", f"{base}/checkpoint", base.rsplit("/", 1)[-1])


@check(
    "rate_stream",
    """
    SELECT event_type, date_trunc('minute', ts) AS minute, CAST(sum(CAST(round(value, 2) AS DECIMAL(18,2))) AS DOUBLE) AS increase,
           CAST(sum(CAST(round(value, 2) AS DECIMAL(18,2))) AS DOUBLE) / 60.0 AS per_second
    FROM events GROUP BY ALL
    """,
)
def rate(spark, sf):
    """All minutes, those still open when the stream ends included."""
    samples = _events(spark, sf).withColumn("value", F.round("value", 2).cast("decimal(18,2)"))
    stream = rate_stream(samples, ["event_type"])
    base = scratch_path(spark, "rate")
    done = run_updates(stream, f"{base}/result", ["event_type", "minute"], f"{base}/checkpoint", base.rsplit("/", 1)[-1])
    return done.withColumn("increase", F.col("increase").cast("double"))
