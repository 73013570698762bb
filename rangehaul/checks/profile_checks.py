"""Catalog discovery, sizes, bounds, histograms and widths.

Rows of the test tables stand in for catalog rows: an order is a table, a line number a column,
a supplier an index or a partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rangehaul.checks.registry import check, table
from rangehaul.operators import profile as P
from rangehaul.sources.catalog import key_type, typed_steps

_CATALOG_SQL = """
WITH cols AS (
  SELECT l_orderkey AS t, l_linenumber AS column_id, 'c' || l_linenumber AS col, min(l_suppkey % 5) AS type_id,
         max(l_discount) > 0.05 AS nullable, CAST(max(l_quantity) AS INTEGER) AS precision
  FROM lineitem GROUP BY ALL),
types AS (
  SELECT r_regionkey AS type_id, CASE r_regionkey WHEN 0 THEN 'bigint' WHEN 1 THEN 'int' WHEN 2 THEN 'decimal'
         WHEN 3 THEN 'datetime2' ELSE 'nvarchar' END AS sql_type FROM region),
idx AS (
  SELECT l_orderkey AS t, l_suppkey + 1 AS index_id, 1 + min(l_partkey) % 3 AS index_type, max(l_tax) > 0.04 AS is_unique,
         max(l_returnflag) = 'N' AS primary_key, max(l_returnflag) = 'A' AS disabled, min(l_discount) = 0 AS filtered
  FROM lineitem GROUP BY l_orderkey, l_suppkey),
idxc AS (
  SELECT l_orderkey AS t, l_suppkey + 1 AS index_id, l_linenumber AS column_id, 1 + min(l_partkey) % 2 AS key_ordinal
  FROM lineitem GROUP BY l_orderkey, l_suppkey, l_linenumber),
st AS (SELECT l_orderkey AS t, l_suppkey + 1 AS stats_id, max(l_tax) = 0 AS filtered FROM lineitem GROUP BY l_orderkey, l_suppkey),
stc AS (
  SELECT l_orderkey AS t, l_suppkey + 1 AS stats_id, l_linenumber AS column_id, 1 + max(l_partkey) % 2 AS stats_column_id
  FROM lineitem GROUP BY l_orderkey, l_suppkey, l_linenumber),
bi AS (
  SELECT idx.t, idxc.column_id, idx.index_id, idx.index_type, idx.is_unique, idx.primary_key
  FROM idx JOIN idxc ON idx.t = idxc.t AND idx.index_id = idxc.index_id AND key_ordinal = 1
  WHERE NOT disabled AND NOT filtered AND index_type IN (1, 2)
  QUALIFY row_number() OVER (PARTITION BY idx.t, idxc.column_id
          ORDER BY index_type, is_unique DESC, primary_key DESC, idx.index_id) = 1),
bs AS (
  SELECT st.t, stc.column_id, st.stats_id
  FROM st JOIN stc ON st.t = stc.t AND st.stats_id = stc.stats_id AND stats_column_id = 1
  LEFT JOIN bi ON bi.t = st.t AND bi.column_id = stc.column_id
  WHERE NOT filtered
  QUALIFY row_number() OVER (PARTITION BY st.t, stc.column_id
          ORDER BY CASE WHEN st.stats_id = bi.index_id THEN 0 ELSE 1 END, st.stats_id) = 1)
SELECT cols.t AS "table", cols.column_id, cols.col AS "column", sql_type, nullable, precision, 0 AS scale, bi.index_id,
       coalesce(index_type = 1, false) AS clustered, coalesce(is_unique, false) AS is_unique,
       coalesce(primary_key, false) AS primary_key, bs.stats_id
FROM cols JOIN types USING (type_id)
LEFT JOIN bi ON bi.t = cols.t AND bi.column_id = cols.column_id
LEFT JOIN bs ON bs.t = cols.t AND bs.column_id = cols.column_id
"""


@check("discover_columns", _CATALOG_SQL)
def discover_columns(spark, sf):
    lines = table(spark, sf, "lineitem").withColumns(
        {"table": F.col("l_orderkey"), "column_id": F.col("l_linenumber"), "index_id": F.col("l_suppkey") + 1}
    )
    columns = lines.groupBy("table", "column_id").agg(
        F.min(F.col("l_suppkey") % 5).alias("type_id"),
        (F.max("l_discount") > 0.05).alias("nullable"),
        F.max("l_quantity").cast("int").alias("precision"),
    ).withColumns({"column": F.concat(F.lit("c"), F.col("column_id")), "scale": F.lit(0)})
    names = F.array(*[F.lit(n) for n in ("bigint", "int", "decimal", "datetime2", "nvarchar")])
    types = table(spark, sf, "region").select(
        F.col("r_regionkey").alias("type_id"), F.get(names, F.col("r_regionkey")).alias("sql_type")
    )
    indexes = lines.groupBy("table", "index_id").agg(
        (F.min("l_partkey") % 3 + 1).alias("index_type"),
        (F.max("l_tax") > 0.04).alias("is_unique"),
        (F.max("l_returnflag") == "N").alias("primary_key"),
        (F.max("l_returnflag") == "A").alias("disabled"),
        F.lit(False).alias("hypothetical"),
        (F.min("l_discount") == 0).alias("filtered"),
    )
    index_columns = lines.groupBy("table", "index_id", "column_id").agg((F.min("l_partkey") % 2 + 1).alias("key_ordinal"))
    stats = lines.groupBy("table", F.col("index_id").alias("stats_id")).agg((F.max("l_tax") == 0).alias("filtered"))
    stats_columns = lines.groupBy("table", F.col("index_id").alias("stats_id"), "column_id").agg(
        (F.max("l_partkey") % 2 + 1).alias("stats_column_id")
    )
    return P.discover_columns(columns, types, indexes, index_columns, stats, stats_columns)


@check(
    "discover_columns_oracle",
    """
    WITH cols AS (
      SELECT l_orderkey AS t, l_linenumber AS column_id, 'C' || l_linenumber AS col,
             CASE min(l_suppkey) % 5 WHEN 0 THEN 'NUMBER' WHEN 1 THEN 'TIMESTAMP(6)' WHEN 2 THEN 'BINARY_DOUBLE' WHEN 3 THEN 'DATE' ELSE 'VARCHAR2' END AS kind,
             max(l_discount) > 0.05 AS nullable, CASE WHEN min(l_partkey) % 6 > 0 THEN CAST(min(l_partkey) % 6 * 5 AS INTEGER) END AS p,
             CAST(min(l_partkey) % 2 AS INTEGER) AS s
      FROM lineitem GROUP BY ALL),
    lead AS (
      SELECT i.t, ic.col, i.name, i.uniq, i.pk FROM
        (SELECT l_orderkey AS t, 'IX_' || l_suppkey AS name, max(l_tax) > 0.04 AS uniq, max(l_returnflag) <> 'A' AS ok, max(l_returnflag) = 'R' AS pk
         FROM lineitem GROUP BY l_orderkey, l_suppkey) i
        JOIN (SELECT l_orderkey AS t, 'IX_' || l_suppkey AS name, 'C' || l_linenumber AS col FROM lineitem
              GROUP BY l_orderkey, l_suppkey, l_linenumber HAVING min(l_partkey) % 2 = 0) ic ON i.t = ic.t AND i.name = ic.name
      WHERE ok QUALIFY row_number() OVER (PARTITION BY i.t, ic.col ORDER BY pk DESC, uniq DESC, i.name) = 1)
    SELECT cols.t AS "table", column_id, cols.col AS "column",
           CASE kind WHEN 'NUMBER' THEN CASE WHEN s > 0 OR p IS NULL OR p > 18 THEN 'decimal' WHEN p <= 9 THEN 'int' ELSE 'bigint' END
                WHEN 'BINARY_DOUBLE' THEN 'float' WHEN 'VARCHAR2' THEN 'varchar2' ELSE 'datetime2' END AS sql_type,
           nullable, coalesce(p, 0) AS precision, s AS scale, lead.name AS index_name, false AS clustered,
           coalesce(uniq, false) AS is_unique, coalesce(pk, false) AS primary_key
    FROM cols LEFT JOIN lead ON lead.t = cols.t AND lead.col = cols.col
    """,
)
def discover_columns_oracle(spark, sf):
    lines = table(spark, sf, "lineitem").withColumns(
        {
            "table": F.col("l_orderkey"),
            "column_id": F.col("l_linenumber"),
            "column": F.concat(F.lit("C"), F.col("l_linenumber")),
            "index_name": F.concat(F.lit("IX_"), F.col("l_suppkey")),
        }
    )
    kinds = F.array(*[F.lit(k) for k in ("NUMBER", "TIMESTAMP(6)", "BINARY_DOUBLE", "DATE", "VARCHAR2")])
    part = F.min("l_partkey")
    columns = lines.groupBy("table", "column_id", "column").agg(
        F.get(kinds, (F.min("l_suppkey") % 5).cast("int")).alias("data_type"),
        F.when(F.max("l_discount") > 0.05, "Y").otherwise("N").alias("nullable"),
        F.when(part % 6 > 0, part % 6 * 5).cast("int").alias("precision"),
        (part % 2).cast("int").alias("scale"),
    )
    per_index = lines.groupBy("table", "index_name")
    indexes = per_index.agg(
        F.when(F.max("l_tax") > 0.04, "UNIQUE").otherwise("NONUNIQUE").alias("uniqueness"),
        F.when(F.max("l_returnflag") != "A", "VALID").otherwise("UNUSABLE").alias("status"),
        F.lit("NORMAL").alias("index_type"),
    )
    index_columns = lines.groupBy("table", "index_name", "column").agg((part % 2 + 1).alias("key_ordinal"))
    constraints = per_index.agg(F.when(F.max("l_returnflag") == "R", "P").otherwise("C").alias("constraint_type"))
    return P.discover_columns_oracle(columns, indexes, index_columns, constraints)


def _partition_stats(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("table"),
        (F.col("l_linenumber") - 1).alias("index_id"),
        F.col("l_quantity").cast("bigint").alias("row_count"),
        (F.col("l_partkey") % 1000).alias("used_page_count"),
    )


def _suppliers(spark, sf):
    return table(spark, sf, "supplier").select(F.col("s_suppkey").alias("table"))


@check(
    "table_size",
    """
    SELECT s_suppkey AS "table", CAST(coalesce(sum(l_quantity), 0) AS BIGINT) AS rows,
           CAST(coalesce(sum(l_partkey % 1000), 0) * 8192 AS BIGINT) AS bytes
    FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey AND l_linenumber IN (1, 2) GROUP BY s_suppkey
    """,
)
def table_size(spark, sf):
    return P.table_size(_suppliers(spark, sf), _partition_stats(spark, sf))


@check(
    "table_size_fallback",
    """
    WITH r AS (SELECT l_suppkey AS t, sum(l_quantity) AS n FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY 1),
    w AS (SELECT l_suppkey AS t, sum(CASE WHEN l_linenumber = 7 THEN 1024 ELSE l_linenumber * 10 END) AS width
          FROM lineitem GROUP BY 1)
    SELECT s_suppkey AS "table", CAST(coalesce(n, 0) AS BIGINT) AS rows,
           CAST(CAST(coalesce(n, 0) AS BIGINT) * coalesce(width, 1) AS BIGINT) AS bytes
    FROM supplier LEFT JOIN r ON r.t = s_suppkey LEFT JOIN w ON w.t = s_suppkey
    """,
)
def table_size_fallback(spark, sf):
    columns = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("table"),
        F.when(F.col("l_linenumber") == 7, -1).otherwise(F.col("l_linenumber") * 10).alias("max_length"),
    )
    sizes = P.table_size_fallback(_suppliers(spark, sf), _partition_stats(spark, sf), columns)
    return sizes.drop("warning")


@check(
    "table_size_greatest",
    """
    WITH w AS (SELECT l_orderkey AS t, count(*) AS n,
                      sum(CASE WHEN l_linenumber > 1 THEN l_linenumber - 1 WHEN l_quantity <> 0 THEN l_quantity ELSE 1 END) AS width
               FROM lineitem GROUP BY 1),
    o AS (SELECT o_orderkey AS t, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE (o_custkey % 7) * 1000 END AS num_rows,
                 (o_custkey % 5) * 10 AS len, CAST(floor(o_totalprice / 1000) AS BIGINT) AS blocks FROM orders)
    SELECT o.t AS "table", CAST(coalesce(num_rows, n, 0) AS BIGINT) AS rows,
           CAST(greatest(coalesce(num_rows, n, 0) * greatest(1, CASE WHEN len > 0 THEN len ELSE coalesce(width, 0) END),
                         blocks * 8192) AS BIGINT) AS bytes,
           num_rows IS NULL AS counted
    FROM o LEFT JOIN w ON w.t = o.t
    """,
)
def table_size_greatest(spark, sf):
    tables = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("table"),
        F.when(F.col("o_custkey") % 7 != 0, (F.col("o_custkey") % 7) * 1000).alias("num_rows"),
        ((F.col("o_custkey") % 5) * 10).alias("avg_row_len"),
        F.floor(F.col("o_totalprice") / 1000).alias("blocks"),
    )
    lines = table(spark, sf, "lineitem")
    columns = lines.select(
        F.col("l_orderkey").alias("table"),
        (F.col("l_linenumber") - 1).alias("avg_col_len"),
        F.col("l_quantity").cast("bigint").alias("data_length"),
    )
    counts = lines.groupBy(F.col("l_orderkey").alias("table")).agg(F.count("*").alias("exact_rows"))
    return P.table_size_greatest(tables, columns, counts)


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@check("row_count", " UNION ALL ".join(f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in TABLES))
def row_count(spark, sf):
    return P.row_counts({name: table(spark, sf, name) for name in TABLES})


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


_BOUNDED = {
    "lineitem": ("l_orderkey", "l_shipdate"),
    "orders": ("o_custkey", "o_orderdate"),
    "events": ("event_id", "ts"),
    "documents": ("n_chars",),
}
_TEMPORAL = ("l_shipdate", "o_orderdate", "ts")


def _bound_sql(name: str, column: str) -> str:
    text = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')" if column in _TEMPORAL else "CAST({} AS VARCHAR)"
    low, high = text.format(f"min({column})"), text.format(f"max({column})")
    return f"SELECT '{name}' AS \"table\", '{column}' AS \"column\", {low} AS low, {high} AS high FROM {name}"


@check("column_bounds", " UNION ALL ".join(_bound_sql(t, c) for t, columns in _BOUNDED.items() for c in columns))
def column_bounds(spark, sf):
    return _union([P.column_bounds(table(spark, sf, t), columns, t) for t, columns in _BOUNDED.items()])


def _sparse_key(spark, sf):
    """Order keys of which every fifth is NULL."""
    key = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderkey")).alias("k")
    return table(spark, sf, "orders").select(key)


@check(
    "column_histogram",
    """
    WITH src AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderkey END AS k FROM orders),
    lim AS (SELECT min(k) AS lo, greatest(1, CAST(ceil((max(k) - min(k) + 1) / 50.0) AS BIGINT)) AS width FROM src),
    edges AS (SELECT max(k) AS edge FROM src, lim WHERE k IS NOT NULL GROUP BY (k - lo) // width
              UNION SELECT lo FROM lim),
    placed AS (SELECT k, (SELECT min(edge) FROM edges WHERE edge >= k) AS high FROM src)
    SELECT high, CAST(CASE WHEN high IS NULL THEN 0 ELSE count(*) FILTER (k < high) END AS DOUBLE) AS range_rows,
           CAST(CASE WHEN high IS NULL THEN count(*) ELSE count(*) FILTER (k = high) END AS DOUBLE) AS equal_rows
    FROM placed GROUP BY high
    """,
)
def column_histogram(spark, sf):
    return P.even_histogram(_sparse_key(spark, sf), "k", 50)


@check(
    "column_histogram_quantiles",
    """
    SELECT CAST(count(*) AS DOUBLE) AS rows, CAST(count(*) FILTER (o_orderkey % 5 = 0) AS DOUBLE) AS null_rows,
           min(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END) AS low,
           max(CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END) AS high, true AS balanced
    FROM orders
    """,
)
def column_histogram_quantiles(spark, sf):
    """Steps at approximate quantiles: totals are exact, and no step is far above its share."""
    steps = P.column_histogram(_sparse_key(spark, sf), "k", 50)
    rows = F.col("range_rows") + F.col("equal_rows")
    keyed = F.when(F.col("high").isNotNull(), rows)
    return steps.agg(
        F.sum(rows).alias("rows"),
        F.sum(F.when(F.col("high").isNull(), rows)).alias("null_rows"),
        F.min("high").alias("low"),
        F.max("high").alias("high"),
        (F.max(keyed) <= F.sum(keyed) / 25).alias("balanced"),
    )


_FAR_APART = "SELECT o_custkey % 40 AS t, (o_custkey % 40) * 1000000000 + o_orderkey AS k0, o_orderkey FROM orders"


@check(
    "sketched_histogram",
    f"""
    WITH src AS (SELECT t, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE k0 END AS k FROM ({_FAR_APART}))
    SELECT t AS "table", CAST(count(*) AS DOUBLE) AS rows, CAST(count(*) - count(k) AS DOUBLE) AS null_rows, max(k) AS high, true AS balanced
    FROM src GROUP BY t
    """,
)
def sketched_histogram(spark, sf):
    """Forty tables whose keys lie a thousand million apart: totals are exact, and no step of any table is far above its share."""
    orders = table(spark, sf, "orders").withColumn("table", F.col("o_custkey") % 40)
    key = F.when(F.col("o_orderkey") % 11 != 0, F.col("table") * 1_000_000_000 + F.col("o_orderkey"))
    steps = P.sketched_histogram(orders.select("table", key.alias("k")), ["table"], "k", 16)
    rows = F.col("range_rows") + F.col("equal_rows")
    keyed = F.when(F.col("high").isNotNull(), rows)
    return steps.groupBy("table").agg(
        F.sum(rows).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("high").isNull(), rows)), F.lit(0.0)).alias("null_rows"),
        F.max("high").alias("high"),
        (F.max(keyed) <= F.greatest(F.lit(4.0), F.sum(keyed) / 8)).alias("balanced"),
    )


@check(
    "catalog_histogram",
    """
    SELECT 'bigint' AS kind, CAST(o_orderkey * 1000003 AS VARCHAR) AS high, CAST(o_custkey AS DOUBLE) AS range_rows, CAST(1 AS DOUBLE) AS equal_rows FROM orders
    UNION ALL SELECT 'decimal', CAST(CAST(o_totalprice AS DECIMAL(18,4)) AS VARCHAR), CAST(o_custkey AS DOUBLE), CAST(1 AS DOUBLE) FROM orders
    UNION ALL SELECT 'datetime2', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'), CAST(o_custkey AS DOUBLE), CAST(1 AS DOUBLE) FROM orders
    UNION ALL SELECT 'date', strftime(o_orderdate, '%Y-%m-%d'), CAST(o_custkey AS DOUBLE), CAST(1 AS DOUBLE) FROM orders
    """,
)
def catalog_histogram(spark, sf):
    """Steps of a catalog as its views give them, keys as text, read back as typed keys (an order stands for a step)."""
    orders = table(spark, sf, "orders")
    texts = {
        ("bigint", None, None): (F.col("o_orderkey") * 1000003).cast("string"),
        ("decimal", 18, 4): F.col("o_totalprice").cast("decimal(18,4)").cast("string"),
        ("datetime2", None, None): F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0'"),
        ("date", None, None): F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00"),
    }
    frames = []
    for (kind, precision, scale), text in texts.items():
        steps = orders.select(text.alias("high"), F.col("o_custkey").cast("string").alias("range_rows"), F.lit("1").alias("equal_rows"))
        frames.append(typed_steps(steps, key_type(kind, precision, scale)).select(F.lit(kind).alias("kind"), F.col("high").cast("string").alias("high"), "range_rows", "equal_rows"))
    return _union(frames)


@check(
    "row_width",
    """
    WITH d AS (SELECT count(*) AS rows, count(*) * 8 AS a, coalesce(sum(strlen(text)), 0) AS b, coalesce(sum(strlen(lang)), 0) AS c,
                      coalesce(sum(strlen(source)), 0) AS d FROM documents),
    e AS (SELECT count(*) AS rows, count(*) * 8 AS a, coalesce(sum(strlen(event_type)), 0) AS b, coalesce(sum(strlen(props)), 0) AS c FROM events),
    u AS (SELECT 'documents' AS t, 'doc_id' AS c, rows, a AS bytes FROM d UNION ALL SELECT 'documents', 'text', rows, b FROM d
          UNION ALL SELECT 'documents', 'lang', rows, c FROM d UNION ALL SELECT 'documents', 'source', rows, d FROM d
          UNION ALL SELECT 'documents', 'n_chars', rows, a FROM d UNION ALL SELECT 'documents', '*', rows, a + b + c + d + a FROM d
          UNION ALL SELECT 'events', 'event_id', rows, a FROM e UNION ALL SELECT 'events', 'ts', rows, a FROM e
          UNION ALL SELECT 'events', 'user_id', rows, a FROM e UNION ALL SELECT 'events', 'event_type', rows, b FROM e
          UNION ALL SELECT 'events', 'value', rows, a FROM e UNION ALL SELECT 'events', 'props', rows, c FROM e
          UNION ALL SELECT 'events', '*', rows, 4 * a + b + c FROM e)
    SELECT t AS "table", c AS "column", rows, CAST(bytes AS BIGINT) AS bytes,
           CAST(bytes AS DOUBLE) / greatest(rows, 1) AS avg_bytes FROM u
    """,
)
def row_width(spark, sf):
    return _union([P.row_width(table(spark, sf, t), t) for t in ("documents", "events")])
