from datetime import datetime

from pyspark.sql import functions as F

from rangehaul.streaming.progress import progress_stream, rate_stream, run_available, stream_files


def test_progress_over_several_batches(spark, scratch):
    base = scratch()
    frame = spark.range(90).select((F.col("id") % 3).alias("table"), (F.col("id") % 2 == 0).alias("ok"))
    frame.repartition(6).write.parquet(f"{base}/in")
    stream = stream_files(spark, f"{base}/in", frame.schema, files_per_trigger=1)
    done = run_available(progress_stream(stream, F.col("ok")), f"{base}/out", "complete", f"{base}/state", "progress_test")
    assert {r["table"]: (r["done"], r["total"], r["percent"]) for r in done.collect()} == {t: (15, 30, 50.0) for t in range(3)}
    # Later manifests continue from the checkpoint.
    frame.filter("ok").write.mode("append").parquet(f"{base}/in")
    stream = stream_files(spark, f"{base}/in", frame.schema)
    done = run_available(progress_stream(stream, F.col("ok")), f"{base}/out", "complete", f"{base}/state", "progress_test")
    assert {r["table"]: (r["done"], r["total"]) for r in done.collect()} == {t: (30, 45) for t in range(3)}


def test_rate_leaves_open_minutes_out(spark, scratch):
    base = scratch()
    at = lambda m, s: datetime(2025, 1, 1, 0, m, s)
    rows = [("p", at(0, 1), 30), ("p", at(0, 40), 30), ("q", at(1, 0), 5), ("p", at(3, 30), 1), ("p", at(4, 0), 1)]
    frame = spark.createDataFrame(rows, "pod string, ts timestamp_ntz, value bigint")
    frame.write.parquet(f"{base}/in")
    stream = stream_files(spark, f"{base}/in", frame.schema)
    done = run_available(rate_stream(stream, ["pod"]), f"{base}/out", "append", f"{base}/state", "rate_test")
    got = {(r["pod"], r["minute"]): (r["increase"], r["per_second"]) for r in done.collect()}
    assert got == {("p", at(0, 0)): (60, 1.0), ("q", at(1, 0)): (5, 5 / 60)}
