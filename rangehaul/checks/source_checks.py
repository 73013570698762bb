"""Scans, sources and generated tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rangehaul.checks.registry import check, table
from rangehaul.operators.profile import column_histogram
from rangehaul.operators.ranges import boundary_values, histogram_boundaries
from rangehaul.operators.snapshot import snapshot_as_of
from rangehaul.session import scratch_path
from rangehaul.sinks.snapshots import replace_table
from rangehaul.sources import generated
from rangehaul.sources.arrow import scan_row_groups
from rangehaul.sources.files import file_inventory, file_schemas, load_runs, row_groups
from rangehaul.sources.zones import read_zone_ranges

SCANNED = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_shipdate"]


@check("scan_arrow_ranges", "SELECT l_orderkey, l_linenumber, l_extendedprice, l_shipdate FROM lineitem")
def scan_arrow_ranges(spark, sf):
    controls = row_groups(file_inventory(spark, f"{sf}/lineitem.parquet"))
    return scan_row_groups(controls, table(spark, sf, "lineitem").schema, SCANNED)


@check("scan_zone_ranges", "SELECT * FROM lineitem WHERE l_orderkey % 7 <> 3 AND l_shipdate >= DATE '1995-06-01'")
def scan_zone_ranges(spark, sf):
    """Line items laid out by their order key in row groups, read by eight ranges that open their own groups; a pushed filter on dates."""
    lines, path = table(spark, sf, "lineitem"), scratch_path(spark, "zoned")
    laid = lines.repartitionByRange(16, "l_orderkey").sortWithinPartitions("l_orderkey")
    laid.write.option("parquet.block.size", 1 << 20).parquet(path)
    steps = column_histogram(lines, "l_orderkey", 64).withColumns({"table": F.lit("lineitem"), "column": F.lit("l_orderkey")})
    read = read_zone_ranges(spark, path, lines.schema, "l_orderkey", boundary_values(histogram_boundaries(steps, 8)))
    return read.filter((F.col("l_orderkey") % 7 != 3) & (F.col("l_shipdate") >= F.lit("1995-06-01").cast(lines.schema["l_shipdate"].dataType)))


@check("scan_single", "SELECT * FROM part")
def scan_single(spark, sf):
    return table(spark, sf, "part")


@check(
    "snapshot_as_of",
    """
    SELECT user_id, event_id, event_type, value FROM events WHERE ts <= TIMESTAMP '2024-01-15 00:00:00'
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def snapshot(spark, sf):
    boundary = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    rows = snapshot_as_of(table(spark, sf, "events"), boundary, ["user_id"], "ts", "event_id")
    return rows.select("user_id", "event_id", "event_type", "value")


@check("load_replace", "SELECT * FROM customer")
def load_replace(spark, sf):
    path = scratch_path(spark, "replace")
    replace_table(table(spark, sf, "supplier"), path)
    replace_table(table(spark, sf, "customer"), path)
    return spark.read.parquet(path)


@check(
    "load_runs",
    """
    SELECT 'run-' || event_id AS run_id, CASE WHEN event_type = 'purchase' THEN 'direct' ELSE 'spark' END AS engine,
           CASE WHEN user_id % 3 = 0 THEN 'arrow'
                WHEN user_id % 3 = 1 THEN 'columnar'
                WHEN event_type = 'purchase' THEN 'unknown' ELSE 'jdbc' END AS read_mode,
           'table_' || (user_id % 3) AS "table", event_id AS rows
    FROM events
    WHERE event_type NOT IN ('error', 'signup')
    """,
)
def runs(spark, sf):
    events = table(spark, sf, "events")
    kind = F.col("event_type")
    run_id = (
        F.when(kind == "error", F.concat(F.lit("verification-"), F.col("event_id")))
        .when(kind == "signup", F.lit("site-smoke"))
        .otherwise(F.concat(F.lit("run-"), F.col("event_id")))
    )
    # NULL fields are left out of the JSON text, as in documents of older runs.
    documents = events.select(
        kind,
        F.to_json(
            F.struct(
                run_id.alias("run_id"),
                F.when(kind == "purchase", "direct").when(kind == "view", "spark").alias("engine"),
                F.when(F.col("user_id") % 3 == 0, "arrow").alias("read_mode"),
                F.when(F.col("user_id") % 3 == 1, "columnar").alias("extract_backend"),
                F.concat(F.lit("table_"), F.col("user_id") % 3).alias("table"),
                F.col("event_id").alias("rows"),
            )
        ).alias("value"),
    )
    base = scratch_path(spark, "runs")
    documents.filter(kind != "purchase").select("value").write.text(f"{base}/runs")
    documents.filter(kind == "purchase").select("value").write.text(f"{base}/runs-direct")
    found = load_runs(spark, [f"{base}/runs", f"{base}/runs-direct"], excluded_ids=["site-smoke"], excluded_prefixes=["verification-"], glob="*.txt")
    return found.select("run_id", "engine", "read_mode", "table", "rows")


@check("file_inventory")
def inventory(spark, sf):
    return file_inventory(spark, sf).select(F.substring_index("path", "/", -1).alias("file"), "size")


@check("file_schemas")
def schemas(spark, sf):
    found = file_schemas(file_inventory(spark, sf))
    return found.withColumn("path", F.substring_index("path", "/", -1))


def _numbers(spark, sf):
    """Row numbers from the orders table, so that generated rows grow with it."""
    return table(spark, sf, "orders").select((F.col("o_orderkey") + 1).alias("n"))


_N = "(SELECT o_orderkey + 1 AS n FROM orders)"
_UPDATED = "TIMESTAMP '2025-01-01 00:00:00' + to_seconds(n) AS updated_at"


@check(
    "gen_small",
    f"""
    SELECT n AS id, 'Cliente São Paulo ' || n AS name, CAST(round((n % 100000) / 100.0, 2) AS DECIMAL(18,2)) AS amount,
           {_UPDATED}, n % 2 = 1 AS active
    FROM {_N}
    """,
)
def gen_small(spark, sf):
    return generated.small(_numbers(spark, sf))


@check(
    "gen_medium",
    f"""
    SELECT n AS id, 'Pedido ação ' || n AS name, CAST(round((n % 100000) / 100.0, 2) AS DECIMAL(18,2)) AS amount,
           {_UPDATED}, CAST(n % 100 AS INTEGER) AS category, CASE WHEN n % 5 = 0 THEN NULL ELSE n % 10000 END AS parent_id,
           repeat(upper(md5(CAST(n AS VARCHAR))), 3) AS payload, CAST(n % 1000 AS INTEGER) AS a, n * 1000 AS b,
           CAST(round(n / 7.0, 6) AS DECIMAL(28,6)) AS c, DATE '2025-01-01' + CAST(n % 365 AS INTEGER) AS d,
           'Cat-' || (n % 30) AS e, n % 2 = 1 AS f, sqrt(n) AS g,
           CASE WHEN n % 3 = 0 THEN NULL ELSE 'Informação' END AS h,
           CASE WHEN n % 7 = 0 THEN NULL ELSE CAST(n % 20 AS INTEGER) END AS i
    FROM {_N}
    """,
)
def gen_medium(spark, sf):
    return generated.medium(_numbers(spark, sf))


_SPARSE = ",\n".join(
    f"CASE WHEN (n + {17 * k}) % {7 + k % 7} = 0 THEN 'atributo-{k}-' || upper(md5(n || ':{k}')) END AS sparse_{k:02d}"
    for k in range(1, 44)
)


@check(
    "gen_wide",
    f"""
    SELECT CASE WHEN n <= (SELECT count(*) * 9 // 10 FROM orders) THEN n ELSE 1000000000 + n * 100 END AS id,
           CAST(n % 100 AS INTEGER) AS category, {_UPDATED}, CAST(round(n / 7.0, 6) AS DECIMAL(28,6)) AS amount,
           'Esparso ' || n AS label, {_SPARSE}
    FROM {_N}
    """,
)
def gen_wide(spark, sf):
    numbers = _numbers(spark, sf)
    dense = numbers.agg(F.call_function("div", F.count("*") * 9, F.lit(10)).alias("d")).scalar()
    return generated.wide(numbers, dense)


_ATTRIBUTES = ",\n".join(f"'a{k:02d}-' || (n % {999 + k}) AS attr_{k:02d}" for k in range(1, 21))


@check(
    "gen_oracle_wide",
    f"""
    SELECT n AS id, n % 250000 + 1 AS account_id, n % 100 + 1 AS tenant_id,
           TIMESTAMP '2024-01-01 00:00:00' + to_seconds(n % 31536000) AS event_ts,
           TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(n % 365 AS INTEGER)) AS event_date,
           CAST(round((n * 7919 % 100000000) / 100.0, 2) AS DECIMAL(14,2)) AS amount, n % 10000 AS quantity,
           CAST(round((n % 10000) / 10000.0, 6) AS DECIMAL(12,6)) AS rate,
           CASE n % 5 WHEN 0 THEN 'NEW' WHEN 1 THEN 'ACTIVE' WHEN 2 THEN 'PENDING' WHEN 3 THEN 'CLOSED' ELSE 'ERROR' END AS status,
           'category-' || lpad(CAST(n % 50 AS VARCHAR), 2, '0') AS category,
           'subcategory-' || lpad(CAST(n % 250 AS VARCHAR), 3, '0') AS subcategory,
           'oracle-local' AS source_system, 'region-' || (n % 8) AS region, 'BR' AS country,
           'city-' || lpad(CAST(n % 500 AS VARCHAR), 3, '0') AS city,
           lpad(CAST(n % 99999999 AS VARCHAR), 8, '0') AS postal_code,
           'customer-' || lpad(CAST(n AS VARCHAR), 10, '0') AS customer_name, 'user' || n || '@example.test' AS email,
           '+55' || lpad(CAST(n % 10000000000 AS VARCHAR), 10, '0') AS phone,
           'REF-' || lpad(CAST(n AS VARCHAR), 12, '0') AS reference_code,
           rpad('deterministic oracle benchmark row ' || n || ' ', 180, chr(CAST(65 + n % 26 AS INTEGER))) AS description,
           {_ATTRIBUTES},
           CASE WHEN n % 10 = 0 THEN 'sparse-' || n END AS sparse_01, CASE WHEN n % 20 = 0 THEN n // 20 END AS sparse_02,
           CASE WHEN n % 50 = 0 THEN TIMESTAMP '2020-01-01 00:00:00' + to_days(CAST(n % 1000 AS INTEGER)) END AS sparse_03,
           CASE WHEN n % 100 = 0 THEN repeat('x', 100) END AS sparse_04,
           CASE WHEN n % 200 = 0 THEN CAST(round((n % 7) / 7.0, 8) AS DECIMAL(18,8)) END AS sparse_05,
           CAST(CASE WHEN n % 2 = 0 THEN 1 ELSE 0 END AS BIGINT) AS flag_active,
           TIMESTAMP '2026-01-01 00:00:00' AS created_at
    FROM {_N}
    """,
)
def gen_oracle_wide(spark, sf):
    return generated.oracle_wide(_numbers(spark, sf))
