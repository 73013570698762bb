import datetime
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rangehaul.operators.ranges import assign_ranges
from rangehaul.plans.ingest import IngestOptions, ingest, plan_ranges
from rangehaul.sinks.ledger import Ledger
from rangehaul.sinks.snapshots import read_snapshot
from rangehaul.sources import tasks
from rangehaul.sources.files import file_inventory
from rangehaul.sources.zones import ZonesOverlap, read_zone_ranges, write_zones, zone_maps, zone_read


def laid_out(spark, path, key="id", rows=20_000, files=4):
    frame = spark.range(rows).select(F.expr(key).alias("k"), F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 256)).alias("v"), (F.col("id") % 100).cast("int").alias("m"))
    frame.repartitionByRange(files, "k").sortWithinPartitions("k").write.option("parquet.block.size", 64 << 10).option("parquet.page.size", 8 << 10).parquet(path)
    return frame


def spans(path):
    """Every data file with the place of its row groups and their keys."""
    for file in sorted(glob.glob(f"{path.replace('file:', '')}/*.parquet")):
        footer = pq.ParquetFile(file).metadata
        for g in range(footer.num_row_groups):
            group = footer.row_group(g)
            first = min(c.dictionary_page_offset or c.data_page_offset for c in (group.column(k) for k in range(group.num_columns)))
            yield file, g, first, sum(group.column(k).total_compressed_size for k in range(group.num_columns)), tasks.column_bounds(group, "k")


def test_zone_maps(spark, scratch):
    path = scratch()
    laid_out(spark, path)
    found = {(r["path"].rsplit("/", 1)[1], r["row_group"]): (r["low"], r["high"], r["nulls"]) for r in zone_maps(file_inventory(spark, path), "k", spark.read.parquet(path).schema["k"].dataType).collect()}
    assert found == {(os.path.basename(file), g): bounds for file, g, _, _, bounds in spans(path)} and len(found) > 8


def test_only_groups_of_the_range_are_opened(spark, scratch):
    path = scratch()
    frame = laid_out(spark, path)
    # All groups outside the second range are damaged: a read that opened one would fail.
    kept = 0
    for file, _, first, size, (low, high, _) in spans(path):
        if high < 5000 or low >= 7000:
            with open(file, "r+b") as out:
                out.seek(first)
                out.write(b"\xff" * size)
        else:
            kept += 1
    for crc in glob.glob(f"{path.replace('file:', '')}/.*.crc"):
        os.remove(crc)
    read = read_zone_ranges(spark, path, frame.schema, "k", [5000, 7000], chunks=[1])
    assert read.rdd.getNumPartitions() == 1 and 0 < kept < 8
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, frame.filter("k >= 5000 AND k < 7000").collect()))
    # Pushed filters spare the damaged groups as well.
    some = read_zone_ranges(spark, path, frame.schema, "k", [100, 9000]).filter("k >= 5500 AND k <= 6500")
    assert some.count() == 1001


@pytest.mark.parametrize(
    "key, boundaries",
    [
        ("IF(id % 9 > 0, id % 997, NULL)", [0, 100, 500, 996]),
        ("IF(id % 9 > 0, IF(id % 7 > 0, id / 8, double('NaN')), NULL)", [10.5, 1000.0]),
        ("CAST(id * 3 AS decimal(30,2))", [300, 40_000]),
        ("lpad(CAST(id AS string), 90, 'ä')", ["ä" * 86 + "1000", "ä" * 86 + "2500"]),
        ("date_add(DATE '2020-01-01', CAST(id % 400 AS int))", [datetime.date(2020, 3, 1), datetime.date(2020, 12, 31)]),
        ("CAST(timestamp_seconds(id * 60) AS timestamp_ntz)", [datetime.datetime(1970, 1, 2, 5)]),
        ("timestamp_seconds(id * 60)", [datetime.datetime(1970, 1, 2, 5)]),
        ("CAST(NULL AS bigint)", [1, 2]),
        ("id", []),
    ],
)
def test_each_row_comes_from_its_range(spark, scratch, key, boundaries):
    path = scratch()
    frame = laid_out(spark, path, key, 3000)
    read = read_zone_ranges(spark, path, frame.schema, "k", boundaries, most_overlap=100)
    assert read.exceptAll(frame).isEmpty() and frame.exceptAll(read).isEmpty()
    placed = assign_ranges(read, "k", boundaries).withColumn("part", F.spark_partition_id())
    assert placed.filter("chunk <> part").isEmpty()


def test_filters_and_columns(spark, scratch):
    path = scratch()
    frame = laid_out(spark, path)
    narrow = read_zone_ranges(spark, path, frame.select("v").schema, "k", [5000, 12_000])
    assert narrow.columns == ["v"] and narrow.exceptAll(frame.select("v")).isEmpty() and narrow.count() == 20_000
    read = read_zone_ranges(spark, path, frame.schema, "k", [5000, 12_000])
    for text in ("k = 777", "k IS NULL", "k IS NOT NULL AND m < 3", "k > 19000 OR m = 5", "v = 'none'", "k < 10 AND m >= 5"):
        assert read.filter(text).count() == frame.filter(text).count(), text


def test_groups_are_counted(spark, scratch, monkeypatch):
    path = scratch()
    frame = laid_out(spark, path)
    zones = write_zones(spark, file_inventory(spark, path), "k", [5000, 7000], frame.schema["k"].dataType)
    opened = []

    class Counting:
        def __init__(self, inner):
            self.inner, self.metadata = inner, inner.metadata

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.inner.close()

        def iter_batches(self, *values, **named):
            opened.extend(named["row_groups"])
            return self.inner.iter_batches(*values, **named)

    plain = tasks.open_parquet
    monkeypatch.setattr(tasks, "open_parquet", lambda p: Counting(plain(p)))
    arrow = pq.ParquetFile(next(spans(path))[0]).schema_arrow
    options = {"zones": zones, "key": "k", "batch_rows": "1000"}
    rows = sum(b.num_rows for b in tasks.zone_batches("1", options, arrow))
    expected = sum(1 for *_, (low, high, _) in spans(path) if high >= 5000 and low < 7000)
    assert rows == 2000 and len(opened) == expected < sum(1 for _ in spans(path))
    opened.clear()
    assert sum(b.num_rows for b in tasks.zone_batches("1", options, arrow, [("k", "=", 6000)])) > 0 and len(opened) == 1
    assert list(tasks.zone_batches("9", options, arrow)) == []


def test_sources_without_layout_are_refused(spark, scratch):
    path = scratch()
    frame = laid_out(spark, path, "pmod(xxhash64(id), 20000)")
    shuffled = scratch()
    spark.read.parquet(path).repartition(8).write.parquet(shuffled)
    with pytest.raises(ZonesOverlap):
        read_zone_ranges(spark, shuffled, frame.schema, "k", list(range(1000, 20_000, 1000)))
    empty = scratch()
    spark.read.parquet(path).limit(0).write.parquet(empty)
    assert read_zone_ranges(spark, empty, frame.schema, "k", [5]).isEmpty()


def test_load_by_zones(spark, scratch):
    path, root = scratch(), scratch()
    frame = laid_out(spark, path)
    source = spark.read.parquet(path)
    plan = plan_ranges(source, "k", IngestOptions(ranges=4))
    read = zone_read(spark, path, source.schema, plan)
    plans = read(list(plan.predicates))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plans
    run = ingest(source, root, "r", "t", "k", IngestOptions(), plan, read).first()
    assert (run["status"], run["rows"], run["partitions"]) == ("succeeded", 20_000, 4)
    copy = read_snapshot(Ledger(spark, f"{root}/ledger"), "r", frame.schema)
    assert copy.exceptAll(frame).isEmpty() and copy.count() == 20_000
