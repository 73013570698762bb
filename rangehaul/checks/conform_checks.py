"""Typed projections and schema conformity."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rangehaul.checks.registry import check, table
from rangehaul.functions.types import SourceColumn as C
from rangehaul.operators import conform as K
from rangehaul.sources.files import file_inventory, file_schemas


@check(
    "typed_projection",
    """
    SELECT l_orderkey, CAST(l_linenumber AS SMALLINT) AS l_linenumber, CAST(l_quantity AS DECIMAL(15,2)) AS l_quantity,
           CAST(l_extendedprice AS DECIMAL(19,4)) AS l_extendedprice, CAST(l_discount AS DECIMAL(10,4)) AS l_discount,
           l_tax, l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate, CAST(l_partkey AS INTEGER) AS l_partkey
    FROM lineitem
    """,
)
def typed_projection(spark, sf):
    columns = [
        C("l_orderkey", "bigint"),
        C("l_linenumber", "tinyint"),
        C("l_quantity", "decimal", 15, 2),
        C("l_extendedprice", "money"),
        C("l_discount", "smallmoney"),
        C("l_tax", "float"),
        C("l_returnflag", "nchar"),
        C("l_shipdate", "date"),
        C("l_partkey", "int"),
    ]
    return K.typed_projection(table(spark, sf, "lineitem"), columns)


@check(
    "typed_projection_oracle",
    """
    SELECT o_orderkey, CAST(o_custkey AS DECIMAL(20,0)) AS o_custkey, o_orderstatus,
           CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice, o_orderdate, o_orderpriority
    FROM orders
    """,
)
def typed_projection_oracle(spark, sf):
    columns = [
        C("o_orderkey", "NUMBER", 18, 0),
        C("o_custkey", "NUMBER", 20, 0),
        C("o_orderstatus", "CHAR"),
        C("o_totalprice", "NUMBER", 14, 2),
        C("o_orderdate", "DATE"),
        C("o_orderpriority", "VARCHAR2"),
    ]
    return K.typed_projection(table(spark, sf, "orders"), columns, "oracle")


def differing_frames(spark, sf) -> list[DataFrame]:
    """Two frames of the same meaning with narrowed, missing and reordered columns."""
    customers = table(spark, sf, "customer").selectExpr(
        "c_custkey AS id", "c_name AS name", "c_nationkey AS nation", "CAST(c_acctbal AS DECIMAL(12,2)) AS balance"
    )
    suppliers = table(spark, sf, "supplier").selectExpr(
        "CAST(s_nationkey AS BIGINT) AS nation", "CAST(s_suppkey AS INT) AS id", "s_name AS name", "'S' AS kind"
    )
    return [customers, suppliers]


UNIFIED_SQL = """
SELECT c_custkey AS id, c_name AS name, CAST(c_nationkey AS BIGINT) AS nation, CAST(c_acctbal AS DECIMAL(12,2)) AS balance,
       CAST(NULL AS VARCHAR) AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, NULL, 'S' FROM supplier
"""


@check("unify_union", UNIFIED_SQL)
def unify_union(spark, sf):
    return K.unify_union(differing_frames(spark, sf))


@check(
    "conform_schema",
    """
    SELECT s_suppkey AS c_custkey, CAST(NULL AS VARCHAR) AS c_name, s_nationkey AS c_nationkey, s_acctbal AS c_acctbal,
           CAST(NULL AS VARCHAR) AS c_mktsegment FROM supplier
    """,
)
def conform_schema(spark, sf):
    rows = table(spark, sf, "supplier").selectExpr(
        "CAST(s_suppkey AS STRING) AS c_custkey", "CAST(s_nationkey AS BIGINT) AS c_nationkey", "s_acctbal AS c_acctbal", "s_name AS other"
    )
    return K.conform(rows, table(spark, sf, "customer").schema)


@check("schema_compat")
def schema_compat(spark, sf):
    return K.schema_compat(file_schemas(file_inventory(spark, sf)))


@check(
    "parse_keys",
    """
    SELECT o_orderkey, CAST(CASE o_orderkey % 4 WHEN 0 THEN o_orderkey WHEN 1 THEN o_totalprice END AS DECIMAL(18,2)) AS numeric_key,
           CASE WHEN o_orderkey % 4 = 2 THEN CAST(o_orderdate AS DATE) END AS date_key,
           CASE WHEN o_orderkey % 4 = 3 THEN o_orderdate END AS datetime_key
    FROM orders
    """,
)
def parse_keys(spark, sf):
    kinds = F.array(*[F.lit(k) for k in ("bigint", "decimal", "date", "datetime2")])
    kind = F.get(kinds, (F.col("o_orderkey") % 4).cast("int"))
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    text = (
        F.when(kind == "bigint", F.col("o_orderkey").cast("string"))
        .when(kind == "decimal", F.col("o_totalprice").cast("decimal(18,2)").cast("string"))
        .otherwise(stamp)
    )
    rows = table(spark, sf, "orders").select("o_orderkey", kind.alias("sql_type"), text.alias("text"))
    return K.parse_keys(rows).select(
        "o_orderkey", F.col("numeric_key").cast("decimal(18,2)").alias("numeric_key"), "date_key", "datetime_key"
    )
