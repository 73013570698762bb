"""Joins and first/latest choices over manifests, objects, plans and attempts.

Events stand in for attempts (user = run, event = attempt), documents for stored objects.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rangehaul.checks.registry import check, table
from rangehaul.operators import manifests as M

_KEY_SQL = "'data/part-' || lpad(CAST(doc_id AS VARCHAR), 8, '0') || '.parquet'"


def _key(number):
    return F.concat(F.lit("data/part-"), F.lpad(number.cast("string"), 8, "0"), F.lit(".parquet"))


def objects(spark, sf, name: str = "documents") -> DataFrame:
    size = F.col("n_chars") if name == "documents" else F.lit(0).cast("bigint")
    return table(spark, sf, name).select(F.lit("lake").alias("bucket"), _key(F.col("doc_id")).alias("key"), size.alias("size"))


@check(
    "active_files",
    f"SELECT 'lake' AS bucket, {_KEY_SQL} AS key, n_chars AS size FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
)
def active_files(spark, sf):
    return M.active_files(objects(spark, sf), objects(spark, sf, "labels"))


@check(
    "orphan_files",
    f"SELECT 'lake' AS bucket, {_KEY_SQL} AS key, n_chars AS size FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def orphan_files(spark, sf):
    # Ten document numbers form a manifest, so a file list has at most ten entries.
    selected = table(spark, sf, "labels").groupBy(F.call_function("div", F.col("doc_id"), F.lit(10)).alias("index")).agg(
        F.lit("r").alias("run_id"),
        F.lit("a").alias("attempt_id"),
        F.collect_list(F.struct(F.lit("lake").alias("bucket"), _key(F.col("doc_id")).alias("key"), F.lit(0).alias("size"))).alias("files"),
    )
    return M.orphan_files(objects(spark, sf), selected)


_MANIFESTS_SQL = """
m AS (SELECT CAST(user_id AS VARCHAR) AS run_id, CAST(event_id % 16 AS INTEGER) AS index, 'attempt-' || event_id AS attempt_id,
             event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
             CASE WHEN event_id % 9 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS completed_at FROM events),
v AS (SELECT * FROM m WHERE event_type <> 'signup' AND (event_type = 'error' OR
      ((k * 5) IN (SELECT doc_id FROM labels) AND (k * 3) IN (SELECT doc_id FROM labels))))"""


def k_of():
    return F.get_json_object("props", "$.k").cast("bigint")


def manifests(spark, sf) -> DataFrame:
    """Manifests with two files each; sign-ups have no file list, errors an empty one."""
    file = lambda n: F.struct(F.lit("lake").alias("bucket"), _key(n).alias("key"), F.lit(1).cast("bigint").alias("size"))
    k = k_of()
    files = F.array(file(k * 5), file(k * 3))
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("run_id"),
        (F.col("event_id") % 16).cast("int").alias("index"),
        F.concat(F.lit("attempt-"), F.col("event_id")).alias("attempt_id"),
        F.when(kind == "error", F.slice(files, 1, 0)).when(kind != "signup", files).alias("files"),
        k.alias("rows"),
        F.when(F.col("event_id") % 9 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("completed_at"),
    )


def valid(spark, sf) -> DataFrame:
    return M.valid_manifests(manifests(spark, sf), objects(spark, sf, "labels"))


@check("valid_manifests", f"WITH {_MANIFESTS_SQL} SELECT run_id, index, attempt_id, k AS rows, completed_at FROM v")
def valid_manifests(spark, sf):
    return valid(spark, sf).drop("files")


_SELECTED_SQL = f"""
{_MANIFESTS_SQL}, s AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY run_id, index
                        ORDER BY coalesce(completed_at, ''), attempt_id) = 1)"""


@check("select_manifests", f"WITH {_SELECTED_SQL} SELECT run_id, index, attempt_id, k AS rows, completed_at FROM s")
def select_manifests(spark, sf):
    return M.select_manifests(valid(spark, sf)).drop("files")


def plans(spark, sf) -> DataFrame:
    """A plan per user: 16 chunks, or 20 for every third."""
    count = F.when(F.col("user_id") % 3 == 0, 20).otherwise(16)
    users = table(spark, sf, "events").select("user_id").distinct()
    return users.select(F.col("user_id").cast("string").alias("run_id"), count.alias("chunk_count"))


_PLANNED_SQL = """
p AS (SELECT DISTINCT user_id FROM events),
planned AS (SELECT CAST(user_id AS VARCHAR) AS run_id, CAST(i AS INTEGER) AS index FROM p, range(0, 20) AS r(i)
            WHERE user_id % 3 = 0 OR i < 16)"""


@check(
    "missing_chunks",
    f"WITH {_MANIFESTS_SQL}, {_PLANNED_SQL} SELECT run_id, index FROM planned EXCEPT SELECT run_id, index FROM v",
)
def missing_chunks(spark, sf):
    return M.missing_chunks(plans(spark, sf), valid(spark, sf))


@check(
    "pending_chunks",
    f"""
    WITH {_MANIFESTS_SQL}, {_PLANNED_SQL}
    SELECT run_id, index AS chunk, 'k >= ' || index * 100 AS predicate FROM planned
    WHERE NOT EXISTS (SELECT 1 FROM v WHERE v.run_id = planned.run_id AND v.index = planned.index)
    """,
)
def pending_chunks(spark, sf):
    ranges = M.planned_chunks(plans(spark, sf)).withColumnRenamed("index", "chunk")
    ranges = ranges.withColumn("predicate", F.concat(F.lit("k >= "), F.col("chunk") * 100))
    return M.pending_chunks(ranges, valid(spark, sf))


@check(
    "relative_paths",
    """
    SELECT doc_id, CASE WHEN source <> 'web' AND lang = 'en' THEN source || '/part-' || doc_id END AS path,
           source <> 'web' AND lang = 'en' AS inside
    FROM documents
    """,
)
def relative_paths(spark, sf):
    files = table(spark, sf, "documents").select(
        "doc_id",
        F.when(F.col("source") == "web", "other").otherwise("lake").alias("bucket"),
        F.concat(F.lit("tables/"), F.col("lang"), F.lit("/"), F.col("source"), F.lit("/part-"), F.col("doc_id")).alias("key"),
    )
    return M.relative_paths(files, F.lit("tables/en/"), F.lit("lake")).select("doc_id", "path", "inside")


@check(
    "latest_attempt",
    """
    SELECT user_id, event_id % 8 AS task, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_id % 8 ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def latest_attempt(spark, sf):
    documents = table(spark, sf, "events").withColumn("task", F.col("event_id") % 8)
    return M.latest_attempt(documents, ["user_id", "task"], "ts", "event_id").select("user_id", "task", "event_id", "value")


@check(
    "completed_chunks",
    """
    SELECT lang AS bucket, count(DISTINCT doc_id % 300) AS chunks FROM documents WHERE doc_id % 3 <> 0 GROUP BY lang
    """,
)
def completed_chunks(spark, sf):
    leaf = F.when(F.col("doc_id") % 3 != 0, "manifest.json").otherwise("data.parquet")
    key = F.concat(
        F.lit("control/chunks/"), F.lpad((F.col("doc_id") % 300).cast("string"), 5, "0"), F.lit("/attempts/"), F.col("source"), F.lit("/"), leaf
    )
    stored = table(spark, sf, "documents").select(F.col("lang").alias("bucket"), key.alias("key"))
    return M.completed_chunks(stored)


@check(
    "retry_count",
    """
    SELECT event_type, CAST(sum(greatest(n - 1, 0)) AS BIGINT) AS retries
    FROM (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL) GROUP BY event_type
    """,
)
def retry_count(spark, sf):
    return M.retry_count(table(spark, sf, "events"), ["user_id"], ["event_type"])
