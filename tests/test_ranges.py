import math
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from rangehaul.functions.interpolation import interpolate
from rangehaul.operators import ranges as R

STEP = "table string, column string, high bigint, range_rows double, equal_rows double"


def boundaries(spark, steps, n):
    frame = spark.createDataFrame([("t", "id", *s) for s in steps], STEP)
    return R.boundary_values(R.histogram_boundaries(frame, n))


def test_boundaries_follow_rows_not_key_space(spark):
    steps = [(1, 0.0, 1.0), (900000, 899998.0, 1.0), (1100000000, 99999.0, 1.0)]
    assert boundaries(spark, steps, 4) == [250001, 500001, 750001]


def test_heavy_hitter_cannot_be_split(spark):
    assert boundaries(spark, [(7, 0.0, 1e6)], 8) == []
    # Repeated targets inside one value give one boundary.
    assert boundaries(spark, [(1, 0.0, 1.0), (7, 0.0, 1e6), (9, 0.0, 1.0)], 8) == [7]


def test_null_rows_come_first(spark):
    assert boundaries(spark, [(None, 0.0, 50.0), (10, 10.0, 10.0), (20, 0.0, 30.0)], 4) == [20]


def test_no_rows_no_boundaries(spark):
    assert boundaries(spark, [(1, 0.0, 0.0), (2, 0.0, 0.0)], 4) == []
    assert boundaries(spark, [(None, 0.0, 5.0)], 4) == []
    assert boundaries(spark, [(1, -3.0, 1.0), (5, -1.0, 1.0)], 1) == []


def brute_boundaries(steps, n):
    """The rule written as a loop over targets and steps."""
    keyed = sorted(s for s in steps if s[0] is not None)
    total = sum(max(0, s[1]) + max(0, s[2]) for s in steps)
    if not keyed or total <= 0:
        return []
    below_first = sum(max(0, s[2]) for s in steps if s[0] is None)
    found = set()
    for i in range(1, n):
        target, seen, before = total * i / n, below_first, None
        for high, inside, equal in keyed:
            if target <= seen + inside + equal:
                if before is not None and inside > 0 and target < seen + inside:
                    ratio = Decimal(str((target - seen) / inside))
                    found.add(before + math.ceil((high - before) * ratio))
                else:
                    found.add(high)
                break
            seen, before = seen + inside + equal, high
    return sorted(b for b in found if keyed[0][0] < b <= keyed[-1][0])


@settings(max_examples=15, deadline=None)
@given(
    st.lists(st.tuples(st.integers(-1000, 10**12), st.integers(0, 1000), st.integers(0, 1000)), min_size=1, max_size=12, unique_by=lambda s: s[0]),
    st.integers(0, 500),
    st.integers(2, 12),
)
def test_boundaries_equal_brute_force(spark, steps, nulls, n):
    typed = [(h, float(r), float(e)) for h, r, e in steps] + ([(None, 0.0, float(nulls))] if nulls else [])
    assert boundaries(spark, typed, n) == brute_boundaries(typed, n)


def test_predicates_cover_every_value_once(spark):
    points = spark.createDataFrame([("t", "id", 10), ("t", "id", 20)], "table string, column string, boundary bigint")
    predicates = [r["predicate"] for r in R.range_predicates(points, True).orderBy("chunk").collect()]
    values = spark.createDataFrame([(v,) for v in (None, -100, 0, 10, 19, 20, 10**12)], "id bigint")
    assert [tuple(r) for r in R.range_coverage(values, predicates).collect()] == [(1, 7)]


@pytest.mark.parametrize(
    "dialect, name, expected",
    [
        ("sqlserver", "odd] column", "[odd]] column] < 5"),
        ("oracle", 'odd"column', '"odd""column" < 5'),
        ("spark", "odd`column", "`odd``column` < 5"),
    ],
)
def test_names_are_quoted(spark, dialect, name, expected):
    points = spark.createDataFrame([("t", name, 5)], "table string, column string, boundary int")
    assert R.range_predicates(points, False, dialect=dialect).orderBy("chunk").first()["predicate"] == expected


def test_temporal_literals_are_typed(spark):
    points = spark.createDataFrame(
        [("t", "at", datetime(2025, 1, 2, 3, 4, 5, 60))], "table string, column string, boundary timestamp_ntz"
    )
    last = lambda d: R.range_predicates(points, False, dialect=d).orderBy(F.desc("chunk")).first()["predicate"]
    assert last("oracle") == "\"at\" >= TIMESTAMP '2025-01-02 03:04:05.000060'"
    assert last("sqlserver") == "[at] >= CAST('2025-01-02T03:04:05.000060' AS datetime2)"
    assert last("spark") == "`at` >= TIMESTAMP_NTZ '2025-01-02 03:04:05.000060'"


def test_float_literals_read_back_exactly(spark):
    for value in (1.5e-7, 0.5 + 3e-15, 1e28, -2.0, 0.1):
        points = spark.createDataFrame([("t", "x", value)], "table string, column string, boundary double")
        predicate = R.range_predicates(points).orderBy("chunk").first()["predicate"]
        assert float(predicate.split(" < ")[1]) == value
        assert spark.range(1).select(F.expr(f"cast({value!r} as double) >= {predicate.split(' < ')[1]}")).first()[0]


@pytest.mark.parametrize("kind, low, high, expected", [
    ("decimal(20,2)", "0", "1000", [str(125 * k) + ".00" for k in range(1, 8)]),
    ("decimal(19,4)", "0", "100", [f"{12.5 * k:.4f}" for k in range(1, 8)]),
    ("decimal(38,6)", "-8", "8", [f"{2 * k - 8:.6f}" for k in range(1, 8)]),
])
def test_long_decimals_are_cut_exactly(spark, kind, low, high, expected):
    bounds = spark.range(1).select(F.lit("t").alias("table"), F.lit("k").alias("column"), F.lit(low).cast(kind).alias("low"), F.lit(high).cast(kind).alias("high"))
    assert [str(r["boundary"]) for r in R.linear_boundaries(bounds, 8).orderBy("boundary").collect()] == expected



@pytest.mark.parametrize(
    "low, high, ratio, dtype, expected",
    [
        (0, 100, 1 / 3, T.LongType(), 34),
        (0, 100, 1.7, T.LongType(), 100),
        (-(2**63), 2**63 - 1, 0.5, T.LongType(), 0),
        (Decimal("1" + "0" * 37), Decimal("9" * 38), 0.5, T.DecimalType(38, 0), Decimal(str((10**37 + 10**38 - 1) // 2))),
        (Decimal("1.25"), Decimal("9.99"), 0.5, T.DecimalType(18, 2), Decimal("5.62")),
        (datetime(2025, 1, 1), datetime(2025, 1, 3), 0.5, T.TimestampNTZType(), datetime(2025, 1, 2)),
        (date(2025, 1, 1), date(2025, 1, 4), 0.5, T.DateType(), date(2025, 1, 3)),
        (1.0, 2.0, 0.25, T.DoubleType(), 1.25),
    ],
)
def test_points_are_typed_as_the_key(spark, low, high, ratio, dtype, expected):
    schema = T.StructType([T.StructField("l", dtype), T.StructField("h", dtype)])
    frame = spark.createDataFrame([(low, high)], schema)
    point = frame.select(interpolate(F.col("l"), F.col("h"), F.lit(ratio), dtype).alias("p")).first()["p"]
    assert point == expected


def test_long_decimal_with_scale_stays_inside(spark):
    dtype = T.DecimalType(38, 4)
    high = Decimal("9" * 33 + ".0000")
    frame = spark.createDataFrame([(Decimal("1.5"), high)], T.StructType([T.StructField("l", dtype), T.StructField("h", dtype)]))
    point = frame.select(interpolate(F.col("l"), F.col("h"), F.lit(0.5), dtype).alias("p")).first()["p"]
    assert Decimal("1.5") < point < high


@pytest.mark.parametrize("count", [0, 1, 2, 7, 31, 32, 33, 64, 100, 257])
@pytest.mark.parametrize("above_equal", [True, False])
def test_range_index_equals_brute_force(spark, count, above_equal):
    points = [i * 3 for i in range(count)]
    values = [None, *range(-2, count * 3 + 2)]
    frame = spark.createDataFrame([(v,) for v in values], "k bigint")
    rows = R.with_range_index(frame, F.col("k"), points, "c", T.LongType(), above_equal).collect()
    for row in rows:
        k = row["k"]
        expected = 0 if k is None else sum(k >= p if above_equal else k > p for p in points)
        assert row["c"] == expected


def test_nan_lies_in_the_last_range(spark):
    frame = spark.createDataFrame([(float("nan"),), (-1.0,), (1.5,), (None,)], "x double")
    for points in ([0.0, 1.0], [float(i) for i in range(50)]):
        rows = R.assign_ranges(frame, "x", points).collect()
        assert rows[0]["chunk"] == len(points) and rows[3]["chunk"] == 0 and rows[1]["chunk"] == 0


def test_temporal_and_decimal_keys(spark):
    moments = [datetime(2025, 1, 1 + d % 28, d % 24, 0, 0, d) for d in range(40)]
    frame = spark.createDataFrame([(m, Decimal(i) / 4) for i, m in enumerate(sorted(moments))], "at timestamp_ntz, d decimal(20,2)")
    cuts = sorted(moments)
    by_time = R.assign_ranges(frame, "at", cuts).collect()
    assert [r["chunk"] for r in by_time] == list(range(1, 41))
    by_amount = R.assign_ranges(frame, "d", [Decimal(i) / 4 for i in range(40)]).collect()
    assert [r["chunk"] for r in by_amount] == list(range(1, 41))


def test_choice_of_key_and_skew(spark):
    columns = "table string, column string, position int, sql_type string, nullable boolean, index_id int, clustered boolean, is_unique boolean, primary_key boolean"
    rows = [
        ("a", "x", 1, "bigint", False, None, False, False, False),
        ("a", "y", 2, "nvarchar", False, 1, True, True, True),
        ("a", "z", 3, "datetime2", True, 2, False, True, False),
        ("a", "w", 4, "int", True, 3, False, True, False),
        ("b", "p", 1, "nvarchar", False, 1, True, True, True),
        ("c", "m", 1, "decimal", False, 1, True, False, False),
        ("c", "n", 2, "bigint", False, 2, False, True, True),
        ("d", "first", 1, "int", False, 5, False, True, False),
        ("d", "second", 2, "int", False, 6, False, True, False),
    ]
    chosen = {r["table"]: r["column"] for r in R.choose_split_key(spark.createDataFrame(rows, columns)).collect()}
    assert chosen == {"a": "w", "c": "m", "d": "first"}
    skew = R.range_skew(spark.createDataFrame([(10,), (30,)], "rows bigint")).first()
    assert (skew["ranges"], skew["rows"], skew["max_rows"], skew["variation"], skew["max_over_avg"]) == (2, 40, 30, 0.5, 1.5)
