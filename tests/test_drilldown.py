from collections import Counter

import pytest
from pyspark.sql import functions as F

from rangehaul.operators.drilldown import differing_rows

SCHEMA = "k bigint, v string, w double"


def brute(left, right):
    keys = {r[0] for r in left} | {r[0] for r in right}
    out = set()
    for k in keys:
        a, b = (Counter(r for r in side if r[0] == k) for side in (left, right))
        if a != b:
            n, m = a.total(), b.total()
            out.add((k, n, m, "missing" if not m else "unexpected" if not n else "count" if n != m else "content"))
    return out


LEFT = [(i * 37, f"v{i % 5}", float(i)) for i in range(400)] + [(None, "n", 1.0), (None, "m", None), (7, "twice", 0.0), (7, "twice", 0.0), (-(1 << 62), "low", 0.0), (1 << 62, "high", 0.0)]
RIGHT = [r for r in LEFT if r[0] not in (37, 370)]
RIGHT = [(k, None if k == 740 else v, w) for k, v, w in RIGHT] + [(13, "new", 0.0), (7, "twice", 0.0), (111, "v3", 3.0)]
RIGHT.remove((None, "m", None))


@pytest.mark.parametrize("bits, leaf", [(8, 4096), (2, 1), (4, 20)])
def test_named_keys(spark, bits, leaf):
    left, right = (spark.createDataFrame(rows, SCHEMA) for rows in (LEFT, RIGHT))
    found = differing_rows(left, right, "k", fanout_bits=bits, leaf_rows=leaf)
    assert found.columns == ["k", "source_rows", "target_rows", "status"]
    assert {tuple(r) for r in found.collect()} == brute(LEFT, RIGHT)
    # Keys of other types are cut by hash.
    text = lambda df: df.withColumn("k", F.col("k").cast("string"))
    as_text = {(None if r[0] is None else str(r[0]), *r[1:]) for r in brute(LEFT, RIGHT)}
    assert {tuple(r) for r in differing_rows(text(left), text(right), "k", fanout_bits=bits, leaf_rows=leaf).collect()} == as_text


def test_equal_and_empty(spark):
    left, none = spark.createDataFrame(LEFT, SCHEMA), spark.createDataFrame([], SCHEMA)
    assert differing_rows(left, left.repartition(3), "k").collect() == []
    assert differing_rows(none, none, "k").collect() == []
    assert {tuple(r) for r in differing_rows(left, none, "k", leaf_rows=10).collect()} == brute(LEFT, [])
    with pytest.raises(ValueError, match="types differ"):
        differing_rows(left, left.withColumn("w", F.col("w").cast("float")), "k")


def test_only_differing_spans_are_read_again(spark, scratch):
    base = scratch()
    rows = spark.range(0, 20000, 1, 8).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    rows.write.parquet(f"{base}/a")
    rows.withColumn("v", F.when(F.col("k") == 12345, -1).otherwise(F.col("v"))).write.parquet(f"{base}/b")
    found = differing_rows(spark.read.parquet(f"{base}/a"), spark.read.parquet(f"{base}/b"), "k", leaf_rows=10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,123" in plan and "LessThanOrEqual(k,123" in plan
    assert [tuple(r) for r in found.collect()] == [(12345, 1, 1, "content")]
