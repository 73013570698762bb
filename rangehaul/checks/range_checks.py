"""Split keys, boundaries, predicates, range assignment and load decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rangehaul.checks.registry import check, table
from rangehaul.functions.sizing import ChunkLimits, FetchLimits, PartitionLimits, partition_count
from rangehaul.operators import profile as P, ranges as R
from rangehaul.plans.load_plan import load_strategy, size_plan

STEPS = 64
RANGES = 8


# --- SQL twins of histogram and boundaries, in another formulation: targets meet steps in a join ---


def steps_sql(source: str) -> str:
    """CTEs `st(tbl, high, rng, eq)` from a source with (tbl, k): slices of the common key span."""
    return f"""
    src AS ({source}),
    lim AS (SELECT min(k) AS lo, greatest(1, CAST(ceil((max(k) - min(k) + 1) / {STEPS}.0) AS BIGINT)) AS width FROM src),
    vals AS (SELECT tbl, k, (k - lo) // width AS s, count(*) AS c FROM src, lim WHERE k IS NOT NULL GROUP BY ALL),
    st AS (SELECT tbl, max(k) AS high, CAST(sum(c) - arg_max(c, k) AS DOUBLE) AS rng, CAST(arg_max(c, k) AS DOUBLE) AS eq
           FROM vals GROUP BY tbl, s
           UNION ALL SELECT tbl, NULL, 0, CAST(count(*) AS DOUBLE) FROM src WHERE k IS NULL GROUP BY tbl)"""


def even_steps_sql(source: str) -> str:
    """CTE `st` for one table: the lowest key is a step of its own, as `even_histogram` has it."""
    return f"""
    src AS ({source}),
    lim AS (SELECT min(k) AS lo, greatest(1, CAST(ceil((max(k) - min(k) + 1) / {STEPS}.0) AS BIGINT)) AS width FROM src),
    edges AS (SELECT max(k) AS edge FROM src, lim WHERE k IS NOT NULL GROUP BY (k - lo) // width UNION SELECT lo FROM lim),
    placed AS (SELECT src.k, e.edge FROM src ASOF LEFT JOIN edges e ON src.k <= e.edge),
    st AS (SELECT 0 AS tbl, edge AS high, CAST(CASE WHEN edge IS NULL THEN 0 ELSE count(*) FILTER (k < edge) END AS DOUBLE) AS rng,
                  CAST(CASE WHEN edge IS NULL THEN count(*) ELSE count(*) FILTER (k = edge) END AS DOUBLE) AS eq
           FROM placed GROUP BY edge)"""


def boundaries_sql(n: int) -> str:
    """CTE `bnd(tbl, b)` from `st`: for each target the first step that reaches it."""
    return f"""
    cum AS (SELECT *, sum(rng + eq) OVER (PARTITION BY tbl) AS total,
                   sum(rng + eq) OVER (PARTITION BY tbl ORDER BY high NULLS FIRST) AS end_step,
                   lag(high) OVER (PARTITION BY tbl ORDER BY high NULLS FIRST) AS prev,
                   min(high) OVER (PARTITION BY tbl) AS lowest, max(high) OVER (PARTITION BY tbl) AS highest FROM st),
    hit AS (SELECT cum.*, total * i / {n} AS target, end_step - rng - eq AS below
            FROM cum, range(1, {n}) AS r(i) WHERE high IS NOT NULL AND total > 0 AND total * i / {n} <= end_step
            QUALIFY row_number() OVER (PARTITION BY tbl, i ORDER BY high) = 1),
    pts AS (SELECT tbl, lowest, highest, CASE WHEN prev IS NOT NULL AND target < below + rng AND rng > 0
                   THEN prev + CAST(ceil(CAST(high - prev AS DECIMAL(20,0))
                        * CAST(CAST((target - below) / rng AS VARCHAR) AS DECIMAL(18,17))) AS BIGINT)
                   ELSE high END AS b FROM hit),
    bnd AS (SELECT DISTINCT tbl, b FROM pts WHERE lowest < b AND b <= highest)"""


def ranges_sql() -> str:
    """CTE `rng_of(tbl, chunk, low, high)` from `bnd`."""
    return """
    rng_of AS (SELECT tbl, CAST(row_number() OVER (PARTITION BY tbl ORDER BY low NULLS FIRST) - 1 AS INTEGER) AS chunk, low, high FROM (
               SELECT tbl, b AS low, lead(b) OVER (PARTITION BY tbl ORDER BY b) AS high FROM bnd
               UNION ALL SELECT tbl, NULL, min(b) FROM bnd GROUP BY tbl))"""


# --- many tables at once: customers in 40 groups stand for 40 tables ---

_GROUPED = (
    "SELECT o_custkey % 40 AS tbl, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey END AS k FROM orders"
)


def _grouped_keys(spark, sf) -> DataFrame:
    key = F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderkey"))
    return table(spark, sf, "orders").select((F.col("o_custkey") % 40).alias("table"), key.alias("k"))


def _grouped_steps(spark, sf) -> DataFrame:
    keys = _grouped_keys(spark, sf)
    low, high = P.key_bounds(keys, "k")
    return P.grouped_histogram(keys, ["table"], "k", low, high, STEPS)


@check(
    "histogram_boundaries",
    f'WITH {steps_sql(_GROUPED)}, {boundaries_sql(RANGES)} SELECT tbl AS "table", b AS boundary FROM bnd',
)
def histogram_boundaries(spark, sf):
    return R.histogram_boundaries(_grouped_steps(spark, sf), RANGES, by=["table"])


def _linear(spark, sf, n: int) -> DataFrame:
    bounds = _grouped_keys(spark, sf).groupBy("table").agg(F.min("k").alias("low"), F.max("k").alias("high"))
    return R.linear_boundaries(bounds, n, by=["table"])


def linear_sql(n: int) -> str:
    return f"""
    lim AS (SELECT tbl, min(k) AS lo, max(k) AS hi FROM ({_GROUPED}) GROUP BY tbl),
    pts AS (SELECT tbl, lo, hi, lo + CAST(ceil(CAST(hi - lo AS DECIMAL(20,0)) * CAST(CAST(i / {n} AS VARCHAR) AS DECIMAL(18,17))) AS BIGINT) AS b
            FROM lim, range(1, {n}) AS r(i) WHERE lo < hi),
    bnd AS (SELECT DISTINCT tbl, b FROM pts WHERE lo < b AND b <= hi)"""


@check("linear_boundaries", f'WITH {linear_sql(5)} SELECT tbl AS "table", b AS boundary FROM bnd')
def linear_boundaries(spark, sf):
    return _linear(spark, sf, 5)


@check(
    "linear_boundaries_temporal",
    """
    WITH lim AS (SELECT o_custkey % 40 AS tbl, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1)
    SELECT DISTINCT tbl AS "table", lo + to_microseconds(CAST(date_diff('microsecond', lo, hi) * i / 4 AS BIGINT)) AS boundary
    FROM lim, range(1, 4) AS r(i) WHERE lo < hi
    """,
)
def linear_boundaries_temporal(spark, sf):
    bounds = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 40).alias("table")).agg(
        F.min("o_orderdate").alias("low"), F.max("o_orderdate").alias("high")
    )
    return R.linear_boundaries(bounds, 4, by=["table"])


@check(
    "range_predicates",
    f"""
    WITH {linear_sql(5)}, {ranges_sql()}
    SELECT tbl AS "table", chunk, low, high,
           CASE WHEN low IS NULL THEN '([odd]] key] < ' || high || ' OR [odd]] key] IS NULL)'
                WHEN high IS NULL THEN '[odd]] key] >= ' || low
                ELSE '[odd]] key] >= ' || low || ' AND [odd]] key] < ' || high END AS predicate
    FROM rng_of
    """,
)
def range_predicates(spark, sf):
    boundaries = _linear(spark, sf, 5).withColumn("column", F.lit("odd] key"))
    return R.range_predicates(boundaries, True, by=["table"], dialect="sqlserver").drop("column")


@check(
    "range_predicates_temporal",
    """
    WITH b AS (SELECT tbl, max(v) AS v FROM (SELECT o_custkey % 40 AS tbl, o_orderdate AS v FROM orders) GROUP BY tbl)
    SELECT tbl AS "table", 0 AS chunk, '"when" < TIMESTAMP ''' || strftime(v, '%Y-%m-%d %H:%M:%S.%f') || '''' AS predicate FROM b
    UNION ALL
    SELECT tbl, 1, '"when" >= TIMESTAMP ''' || strftime(v, '%Y-%m-%d %H:%M:%S.%f') || '''' FROM b
    """,
)
def range_predicates_temporal(spark, sf):
    boundaries = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 40).alias("table")).agg(
        F.max("o_orderdate").alias("boundary")
    )
    named = boundaries.withColumn("column", F.lit("when"))
    return R.range_predicates(named, False, by=["table"], dialect="oracle").select("table", "chunk", "predicate")


# --- ranges over data rows ---

_LINE_KEYS = "SELECT l_orderkey AS k FROM lineitem"
_LINE_RANGES = f"{even_steps_sql(_LINE_KEYS)}, {boundaries_sql(RANGES)}"


def line_boundaries(spark, sf) -> list:
    """Eight ranges of line items by order key."""
    steps = P.even_histogram(table(spark, sf, "lineitem"), "l_orderkey", STEPS)
    return R.boundary_values(R.histogram_boundaries(steps.withColumn("table", F.lit(0)), RANGES, by=["table"]))


def assigned_lines(spark, sf) -> DataFrame:
    return R.assign_ranges(table(spark, sf, "lineitem"), "l_orderkey", line_boundaries(spark, sf))


ASSIGNED_SQL = f"""
WITH {_LINE_RANGES},
assigned AS (SELECT l.*, CAST((SELECT count(*) FROM bnd WHERE b <= l_orderkey) AS INTEGER) AS chunk FROM lineitem l)"""


@check("assign_ranges", f"{ASSIGNED_SQL} SELECT l_orderkey, l_linenumber, chunk FROM assigned")
def assign_ranges(spark, sf):
    return assigned_lines(spark, sf).select("l_orderkey", "l_linenumber", "chunk")


_NULLABLE_KEYS = "SELECT CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE l_orderkey END AS k FROM lineitem"


@check(
    "range_coverage",
    f"""
    WITH {even_steps_sql(_NULLABLE_KEYS)}, {boundaries_sql(RANGES)}, {ranges_sql()}
    SELECT matches, count(*) AS rows FROM (
      SELECT (SELECT CAST(count(*) AS INTEGER) FROM rng_of
              WHERE (low IS NULL AND (k < high OR k IS NULL)) OR (k >= low AND (high IS NULL OR k < high))) AS matches
      FROM src)
    GROUP BY matches
    """,
)
def range_coverage(spark, sf):
    key = F.when(F.col("l_orderkey") % 13 != 0, F.col("l_orderkey")).alias("k")
    keys = table(spark, sf, "lineitem").select(key)
    steps = P.even_histogram(keys, "k", STEPS).withColumns({"table": F.lit(0), "column": F.lit("k")})
    plan = R.range_predicates(R.histogram_boundaries(steps, RANGES), True)
    return R.range_coverage(keys, [r["predicate"] for r in plan.orderBy("chunk").collect()])


@check(
    "range_skew",
    f"""
    {ASSIGNED_SQL}, counts AS (SELECT chunk, count(*) AS rows FROM assigned GROUP BY chunk)
    SELECT count(*) AS ranges, CAST(sum(rows) AS BIGINT) AS rows, max(rows) AS max_rows,
           round(stddev_pop(rows) / avg(rows), 9) AS variation, round(max(rows) / avg(rows), 9) AS max_over_avg
    FROM counts
    """,
)
def range_skew(spark, sf):
    balance = R.range_skew(R.range_counts(assigned_lines(spark, sf)))
    return balance.withColumns(
        {"variation": F.round("variation", 9), "max_over_avg": F.round("max_over_avg", 9)}
    )


# --- split keys and sizes ---

_INDEXED = {
    "customer": ["c_custkey", "c_nationkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_size", "p_partkey"],
    "orders": ["o_orderdate", "o_custkey", "o_orderkey"],
    "lineitem": ["l_orderkey", "l_shipdate", "l_quantity"],
    "events": ["ts", "event_id"],
    "documents": ["lang", "n_chars"],
    "pages": ["url"],
}
_CLUSTERED = {"customer": "c_nationkey"}
_KINDS = {"o_orderdate": "datetime2", "l_shipdate": "datetime2", "ts": "datetime2", "l_quantity": "float",
          "lang": "string", "url": "string", "p_size": "int", "c_nationkey": "int"}


def _candidate_sql(name: str, column: str) -> str:
    kind = _KINDS.get(column, "bigint")
    return (
        f"SELECT '{name}' AS t, '{column}' AS c, '{kind}' AS kind, {str(_CLUSTERED.get(name) == column).lower()} AS clustered, "
        f"count(DISTINCT {column}) = count({column}) AS uniq, count(*) > count({column}) AS nullable, "
        f"(SELECT column_index FROM duckdb_columns() WHERE table_name = '{name}' AND column_name = '{column}' LIMIT 1) AS pos FROM {name}"
    )


@check(
    "split_key",
    f"""
    WITH cand AS ({' UNION ALL '.join(_candidate_sql(t, c) for t, cols in _INDEXED.items() for c in cols)})
    SELECT t AS "table", c AS "column", uniq AS is_unique, nullable FROM cand WHERE kind <> 'string'
    QUALIFY row_number() OVER (PARTITION BY t ORDER BY clustered DESC, uniq DESC, (uniq AND NOT nullable) DESC, nullable,
            (kind IN ('int', 'bigint')) DESC, pos) = 1
    """,
)
def split_key(spark, sf):
    profile = P.data_profile({t: table(spark, sf, t) for t in _INDEXED}, _INDEXED, _CLUSTERED)
    return R.choose_split_key(profile).select("table", "column", "is_unique", "nullable")


_SIZES_SQL = """
sizes AS (SELECT c_custkey AS t, coalesce(n, 0) * 150000 AS rows, coalesce(cents, 0) * 10 AS bytes
          FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents
                                   FROM orders GROUP BY 1) ON o_custkey = c_custkey)"""


def _sizes(spark, sf) -> DataFrame:
    """A size per customer: orders count as 150,000 rows each, a cent as 10 bytes."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    sums = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("table")).agg(
        (F.count("*") * 150000).alias("rows"), (F.sum(cents) * 10).alias("bytes")
    )
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("table"))
    return customers.join(sums, "table", "left").na.fill(0, ["rows", "bytes"])


def _up(amount: str, unit: str) -> str:
    return f"(({amount} + {unit} - 1) // {unit})"


_MIB = 1 << 20
_PARTS = f"greatest(1, least(8, 16, {_up('bytes', str(32 * _MIB))}))"
_USEFUL = f"greatest(1, least(128, {_up('bytes', str(32 * _MIB))}, {_up('rows', '100000')}))"
_CHUNKS = f"""CASE WHEN bytes <= {128 * _MIB} OR rows = 0 THEN 1 ELSE
    greatest(1, least({_USEFUL}, greatest({_up('bytes', str(4096 * _MIB))}, {_up('rows', '5000000')},
             {_up('bytes', str(256 * _MIB))}, least(8, {_USEFUL})))) END"""
_MANUAL = f"greatest(1, least(64, {_up('bytes', str(8 * _MIB))}))"


def _fetch(chunks: str) -> str:
    width = f"greatest(1, {_up('bytes', 'greatest(1, rows)')})"
    return f"""CASE WHEN rows = 0 THEN 1000 ELSE
        least(greatest(1000, least(100000, {16 * _MIB} // {width})), greatest(1, {_up('rows', f'({chunks})')})) END"""


_SPARK_LIMITS = PartitionLimits(task_slots=16)


@check("size_plan_partitions", f'WITH {_SIZES_SQL} SELECT t AS "table", CAST({_PARTS} AS BIGINT) AS partitions FROM sizes')
def size_plan_partitions(spark, sf):
    return size_plan(_sizes(spark, sf), _SPARK_LIMITS).select("table", "partitions")


@check(
    "size_plan_chunks",
    f"""
    WITH {_SIZES_SQL}, a AS (SELECT *, {_CHUNKS} AS chunks, {_MANUAL} AS manual FROM sizes)
    SELECT t AS "table", CAST(chunks AS BIGINT) AS chunks, CAST(greatest(1, {_up('bytes', 'chunks')}) AS BIGINT) AS chunk_bytes,
           CAST(manual AS BIGINT) AS manual_chunks FROM a
    """,
)
def size_plan_chunks(spark, sf):
    from rangehaul.functions.sizing import chunk_count

    manual = ChunkLimits(max_chunks=64, target_bytes=8 * _MIB)
    plan = size_plan(_sizes(spark, sf)).withColumn("manual_chunks", chunk_count(F.col("rows"), F.col("bytes"), manual))
    return plan.select("table", "chunks", "chunk_bytes", "manual_chunks")


@check(
    "size_plan_fetch",
    f"""
    WITH {_SIZES_SQL} SELECT t AS "table", CAST({_fetch(_PARTS)} AS BIGINT) AS partition_fetch_rows,
           CAST({_fetch(_CHUNKS)} AS BIGINT) AS chunk_fetch_rows FROM sizes
    """,
)
def size_plan_fetch(spark, sf):
    return size_plan(_sizes(spark, sf), _SPARK_LIMITS, fetch=FetchLimits()).select(
        "table", "partition_fetch_rows", "chunk_fetch_rows"
    )


@check(
    "load_strategy",
    f"""
    WITH {_SIZES_SQL}, {steps_sql(_GROUPED)}, {boundaries_sql(RANGES)},
    tabs AS (SELECT t % 40 AS tbl, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum(bytes) AS BIGINT) // (1 + (t % 40) * 40) AS bytes
             FROM sizes GROUP BY t % 40),
    hist AS (SELECT tbl, count(*) AS n FROM bnd WHERE tbl % 3 <> 0 GROUP BY tbl),
    lin AS ({linear_sql(5).replace("lim AS", "WITH lim AS").replace("bnd AS (", "bnd2 AS (")} SELECT tbl, count(*) AS n FROM bnd2 WHERE tbl % 5 <> 0 GROUP BY tbl),
    j AS (SELECT tabs.*, {_PARTS} AS requested, CASE WHEN tbl % 4 <> 0 THEN 'k' END AS col, coalesce(hist.n, 0) AS h, coalesce(lin.n, 0) AS l
          FROM tabs LEFT JOIN hist USING (tbl) LEFT JOIN lin USING (tbl)),
    d AS (SELECT *, CASE WHEN requested <= 1 OR col IS NULL THEN 0 WHEN h > 0 THEN h ELSE l END AS points FROM j)
    SELECT tbl AS "table", CASE WHEN requested > 1 THEN col END AS "column", rows, bytes, CAST(requested AS BIGINT) AS requested,
           points + 1 AS ranges, least(points + 1, 8) AS parallelism,
           CASE WHEN points = 0 THEN 'single_scan' WHEN h > 0 THEN 'histogram_ranges' ELSE 'indexed_ranges' END AS strategy,
           points > 0 AND points + 1 < requested AS fewer
    FROM d
    """,
)
def load_strategies(spark, sf):
    group = F.col("table") % 40
    sizes = _sizes(spark, sf).groupBy(group.alias("table")).agg(
        F.sum("rows").alias("rows"), F.sum("bytes").alias("_bytes")
    )
    sizes = sizes.select("table", "rows", F.call_function("div", F.col("_bytes"), F.col("table") * 40 + 1).alias("bytes"))
    keys = sizes.filter(F.col("table") % 4 != 0).select("table", F.lit("k").alias("column"))
    by_histogram = R.histogram_boundaries(_grouped_steps(spark, sf), RANGES, by=["table"]).filter(F.col("table") % 3 != 0)
    evenly = _linear(spark, sf, 5).filter(F.col("table") % 5 != 0)
    plan = load_strategy(sizes, keys, by_histogram, evenly, partition_count(F.col("bytes"), _SPARK_LIMITS))
    return plan.withColumn("fewer", F.col("warning").isNotNull()).drop("reason", "warning")
