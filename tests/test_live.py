from datetime import datetime

from rangehaul.streaming.live import keep_batch, newest_rows, run_updates
from rangehaul.streaming.progress import rate_stream, stream_files

SCHEMA = "pod string, ts timestamp_ntz, value bigint"
KEYS = ["pod", "minute"]


def at(minute, second):
    return datetime(2025, 1, 1, 0, minute, second)


def run(spark, base, frame):
    stream = rate_stream(stream_files(spark, f"{base}/in", frame.schema), ["pod"], delay="2 minutes")
    done = run_updates(stream, f"{base}/out", KEYS, f"{base}/state", "live_test")
    return {(r["pod"], r["minute"]): r["increase"] for r in done.collect()}, stream.schema


def test_open_minutes_come_out_and_late_rows_correct_them(spark, scratch):
    base = scratch()
    frame = spark.createDataFrame([("p", at(0, 1), 30), ("p", at(0, 40), 30), ("q", at(1, 0), 5), ("p", at(2, 30), 1)], SCHEMA)
    frame.write.parquet(f"{base}/in")
    got, schema = run(spark, base, frame)
    assert got == {("p", at(0, 0)): 60, ("q", at(1, 0)): 5, ("p", at(2, 0)): 1}
    # A late row inside the delay corrects its minute, a new minute is added.
    spark.createDataFrame([("q", at(1, 59), 7), ("p", at(9, 0), 2)], SCHEMA).write.mode("append").parquet(f"{base}/in")
    got, _ = run(spark, base, frame)
    assert got == {("p", at(0, 0)): 60, ("q", at(1, 0)): 12, ("p", at(2, 0)): 1, ("p", at(9, 0)): 2}
    # One that comes after the watermark passed its minute is dropped.
    spark.createDataFrame([("q", at(1, 59), 100)], SCHEMA).write.mode("append").parquet(f"{base}/in")
    assert run(spark, base, frame)[0] == got
    # A repeated batch replaces itself.
    last = spark.createDataFrame([("q", at(1, 0), 99, 0.0)], schema)
    for _ in range(2):
        keep_batch(last, 50, f"{base}/out")
    again = newest_rows(spark, f"{base}/out", schema, KEYS).collect()
    assert len(again) == len(got) and {r["increase"] for r in again if r["pod"] == "q"} == {99}


def test_nothing_arrived(spark, scratch):
    base = scratch()
    frame = spark.createDataFrame([], SCHEMA)
    frame.write.parquet(f"{base}/in")
    assert run(spark, base, frame)[0] == {}
