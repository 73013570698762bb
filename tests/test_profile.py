from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rangehaul.operators import profile as P


def steps_of(frame):
    return {r["high"]: (r["range_rows"], r["equal_rows"]) for r in frame.collect()}


@pytest.mark.parametrize("builder", [P.column_histogram, P.even_histogram])
def test_histogram_counts_every_row(spark, builder):
    keys = [i * i % 97 for i in range(1000)] + [5] * 500 + [None] * 30
    frame = spark.createDataFrame([(k,) for k in keys], "k bigint").repartition(3)
    steps = steps_of(builder(frame, "k", 10))
    assert steps.pop(None) == (0.0, 30.0)
    counts = Counter(k for k in keys if k is not None)
    assert min(steps) == min(counts) and max(steps) == max(counts)
    below = -1
    for high in sorted(steps):
        inside = sum(n for k, n in counts.items() if below < k < high)
        assert steps[high] == (float(inside), float(counts[high]))
        below = high


def test_histogram_of_nothing(spark):
    empty = spark.createDataFrame([], "k bigint")
    assert P.column_histogram(empty, "k").collect() == []
    assert P.even_histogram(empty, "k").collect() == []
    nulls = spark.createDataFrame([(None,), (None,)], "k bigint")
    assert steps_of(P.column_histogram(nulls, "k")) == {None: (0.0, 2.0)}
    assert steps_of(P.even_histogram(nulls, "k")) == {None: (0.0, 2.0)}


def test_histogram_of_floats_and_times(spark):
    frame = spark.createDataFrame([(float(i),) for i in range(100)] + [(float("nan"),), (None,)], "x double")
    steps = steps_of(P.column_histogram(frame, "x", 4))
    assert sum(a + b for a, b in steps.values()) == 102
    times = spark.createDataFrame([(datetime(2025, 1, 1 + i % 20),) for i in range(100)], "t timestamp_ntz")
    assert sum(a + b for a, b in steps_of(P.column_histogram(times, "t", 4)).values()) == 100


def test_many_tables_at_once(spark):
    rows = [(i % 3, None if i % 50 == 0 else i // 3) for i in range(3000)]
    frame = spark.createDataFrame(rows, "t int, k bigint")
    got = P.grouped_histogram(frame, ["t"], "k", 0, 999, 8).collect()
    totals = Counter()
    for r in got:
        totals[r["t"]] += r["range_rows"] + r["equal_rows"]
    assert totals == Counter(t for t, _ in rows)
    assert max(Counter(r["t"] for r in got).values()) <= 9


def test_bounds_counts_and_widths(spark):
    frame = spark.createDataFrame(
        [(1, "ä", None, [1.0, 2.0]), (3, None, b"abc", None)], "k bigint, s string, b binary, v array<float>"
    )
    assert P.key_bounds(frame, "k") == (1, 3)
    assert [tuple(r) for r in P.column_bounds(frame, ["k"], "t").collect()] == [("t", "k", "1", "3")]
    assert {r["table"]: r["rows"] for r in P.row_counts({"a": frame, "b": frame.limit(1)}).collect()} == {"a": 2, "b": 1}
    widths = {r["column"]: r["bytes"] for r in P.row_width(frame, "t").collect()}
    assert widths == {"k": 16, "s": 2, "b": 3, "v": 8, "*": 29}
    nothing = P.row_width(frame.filter("k > 9")).filter("column = '*'").first()
    assert (nothing["rows"], nothing["bytes"], nothing["avg_bytes"]) == (0, 0, 0.0)


def test_profile_from_data(spark):
    frame = spark.createDataFrame([(1, 1, "x"), (2, 1, None)], "id bigint, g int, s string")
    profile = {r["column"]: r for r in P.data_profile({"t": frame}, {"t": ["g", "id"]}, {"t": "g"}).collect()}
    assert profile["id"]["is_unique"] and profile["id"]["primary_key"] and not profile["id"]["clustered"]
    assert profile["g"]["clustered"] and not profile["g"]["is_unique"] and profile["g"]["index_id"] == 1
    assert profile["s"]["nullable"] and profile["s"]["index_id"] is None


def test_discovery_skips_unusable_indexes(spark):
    table = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    found = P.discover_columns(
        table([("t", 1, "a", 9, False, 19, 0), ("t", 2, "b", 9, True, 19, 0), ("t", 3, "c", 9, True, 19, 0)],
              "table string, column_id int, column string, type_id int, nullable boolean, precision int, scale int"),
        table([(9, "bigint")], "type_id int, sql_type string"),
        table([("t", 1, 1, True, True, False, False, False), ("t", 2, 2, True, False, False, False, False),
               ("t", 3, 2, True, False, True, False, False), ("t", 4, 2, False, False, False, False, True), ("t", 5, 2, False, False, False, False, False)],
              "table string, index_id int, index_type int, is_unique boolean, primary_key boolean, disabled boolean, hypothetical boolean, filtered boolean"),
        table([("t", 1, 1, 1), ("t", 1, 2, 2), ("t", 2, 1, 1), ("t", 3, 2, 1), ("t", 4, 2, 1), ("t", 5, 3, 1)],
              "table string, index_id int, column_id int, key_ordinal int"),
        table([("t", 1, False), ("t", 7, False), ("t", 8, True)], "table string, stats_id int, filtered boolean"),
        table([("t", 7, 1, 1), ("t", 1, 1, 1), ("t", 7, 2, 2), ("t", 8, 2, 1)], "table string, stats_id int, column_id int, stats_column_id int"),
    )
    rows = {r["column"]: (r["index_id"], r["clustered"], r["is_unique"], r["primary_key"], r["stats_id"]) for r in found.collect()}
    assert rows == {"a": (1, True, True, True, 1), "b": (None, False, False, False, None), "c": (5, False, False, False, None)}


def test_sketched_histogram(spark):
    rows = [("near", i) for i in range(1000)] + [("far", 10**15 + 7 * i) for i in range(3000)] + [("far", None)] * 5
    rows += [("one", 4)] * 50 + [("empty", None)] * 3 + [(None, i % 10) for i in range(100)]
    frame = spark.createDataFrame(rows, "t string, k bigint").repartition(5)
    found = P.sketched_histogram(frame, ["t"], "k", 10).collect()
    for name in ("near", "far", "one", "empty", None):
        own = sorted((r for r in found if r.t == name), key=lambda r: (r.high is not None, r.high))
        keys = [k for t, k in rows if t == name]
        highs = [r.high for r in own if r.high is not None]
        assert len(highs) <= 11 and highs == sorted(set(highs))
        below = None
        for r in own:
            if r.high is None:
                assert (r.range_rows, r.equal_rows) == (0, sum(k is None for k in keys))
                continue
            inside = [k for k in keys if k is not None and k <= r.high and (below is None or k > below)]
            assert (r.range_rows, r.equal_rows) == (sum(k < r.high for k in inside), sum(k == r.high for k in inside))
            below = r.high
        assert sum(r.range_rows + r.equal_rows for r in own) == len(keys)
        if name in ("near", "far"):
            assert max(r.range_rows + r.equal_rows for r in own if r.high is not None) < len(keys) / 7
    floats = spark.createDataFrame([("a", float(i)) for i in range(20)] + [("a", float("nan")), ("a", None)], "t string, k double")
    counted = P.sketched_histogram(floats, ["t"], "k", 4).collect()
    assert sum(r.range_rows + r.equal_rows for r in counted) == 22 and max(r.high for r in counted if r.high is not None) == 19.0
    dates = floats.select("t", F.date_add(F.lit("2024-01-01").cast("date"), F.when(~F.isnan("k"), F.col("k")).cast("int")).alias("k"))
    assert {r.high.year for r in P.sketched_histogram(dates, ["t"], "k", 4).collect() if r.high} == {2024}


def test_uniqueness_is_sketched_first(spark):
    frame = spark.range(5000).select(F.col("id").alias("a"), (F.col("id") % 100).alias("b"), F.when(F.col("id") > 0, F.least("id", F.lit(4998))).alias("c"), (F.col("id") / 2).alias("d"))
    found = {r.column: r for r in P.data_profile({"t": frame}, {"t": ["a", "b", "c", "d"]}).collect()}
    assert {c for c, r in found.items() if r.is_unique} == {"a", "d"}
    assert found["c"].nullable and not found["a"].nullable and found["a"].primary_key
    told = {r.column: r for r in P.data_profile({"t": frame}, {"t": ["c", "b"]}, declared={"t": ["c"]}).collect()}
    assert told["c"].is_unique and not told["c"].primary_key and told["a"].index_id is None
    empty = P.data_profile({"t": frame.limit(0)}, {"t": ["a"]}).filter("column = 'a'").first()
    assert empty.is_unique and not empty.nullable
