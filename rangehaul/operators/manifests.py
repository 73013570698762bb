"""Chunk manifests, stored files and attempts: joins and first/latest choices over control tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

OBJECT = ["bucket", "key"]
MANIFEST = ["run_id", "index", "attempt_id"]


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order.

    Spark limits each key to one row per task before the shuffle (window group limit), so a
    key that holds a third of all rows does not gather in one task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def active_files(objects: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Stored objects that the published snapshot refers to."""
    return objects.join(snapshot.select(*OBJECT), OBJECT, "left_semi")


def listed_files(manifests: DataFrame) -> DataFrame:
    """One row per file that a manifest lists."""
    return manifests.select(*MANIFEST, F.inline("files"))


def orphan_files(objects: DataFrame, selected: DataFrame) -> DataFrame:
    """Stored objects that no selected manifest lists (left for a later clean-up)."""
    return objects.join(listed_files(selected).select(*OBJECT), OBJECT, "left_anti")


def valid_manifests(manifests: DataFrame, objects: DataFrame, plan: DataFrame | None = None) -> DataFrame:
    """Manifests with a file list whose files all exist; with a plan, only planned (run, chunk) pairs.

    Missing files are found by an anti join and disqualify their manifest by a second one, so that a
    manifest with very many files is never gathered as one group.
    """
    known = manifests.filter(F.col("files").isNotNull())
    if plan is not None:
        known = known.join(plan.select("run_id", "index"), ["run_id", "index"], "left_semi")
    gone = listed_files(known).join(objects.select(*OBJECT), OBJECT, "left_anti").select(*MANIFEST).distinct()
    return known.join(gone, MANIFEST, "left_anti")


def select_manifests(valid: DataFrame) -> DataFrame:
    """The manifest that counts for each chunk: completed first, then by attempt id.

    A missing completion time sorts as an empty text, that is first.
    """
    return first_per_key(
        valid, ["run_id", "index"], F.coalesce(F.col("completed_at"), F.lit("")).asc(), F.col("attempt_id").asc()
    )


def latest_attempt(documents: DataFrame, keys: Sequence[str], finished: str, tie: str) -> DataFrame:
    """The document of a task attempt that was written last."""
    return first_per_key(documents, keys, F.col(finished).desc(), F.col(tie).desc())


def planned_chunks(plans: DataFrame) -> DataFrame:
    """(run_id, index) rows 0 … chunk_count - 1."""
    return plans.filter("chunk_count > 0").select(
        "run_id", F.explode(F.sequence(F.lit(0), (F.col("chunk_count") - 1).cast("int"))).alias("index")
    )


def missing_chunks(plans: DataFrame, valid: DataFrame) -> DataFrame:
    """Planned chunks without a valid manifest; a run with any of them must not be published."""
    done = valid.select("run_id", F.col("index").cast("int").alias("index"))
    return planned_chunks(plans).join(done, ["run_id", "index"], "left_anti")


def pending_chunks(ranges: DataFrame, valid: DataFrame) -> DataFrame:
    """Ranges still to be read when a run resumes."""
    done = valid.select("run_id", F.col("index").alias("chunk"))
    return ranges.join(done, ["run_id", "chunk"], "left_anti")


# Fixed value: where an attempt leaves its manifest.
MANIFEST_KEY = r"/chunks/(\d{5})/attempts/[^/]+/manifest\.json$"


def completed_chunks(objects: DataFrame, by: Sequence[str] = ("bucket",)) -> DataFrame:
    """Chunks that have left a manifest, counted from object keys alone."""
    index = F.regexp_extract(F.concat(F.lit("/"), F.col("key")), MANIFEST_KEY, 1)
    return (
        objects.withColumn("_index", index)
        .filter("_index <> ''")
        .select(*by, F.col("_index").cast("int").alias("_index"))
        .distinct()
        .groupBy(*by)
        .agg(F.count("*").alias("chunks"))
    )


def retry_count(attempts: DataFrame, worker: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Attempts beyond the first, over all workers."""
    per_worker = attempts.groupBy(*by, *worker).agg(F.count("*").alias("_attempts"))
    extra = F.greatest(F.col("_attempts") - 1, F.lit(0))
    return per_worker.groupBy(*by).agg(F.coalesce(F.sum(extra), F.lit(0)).cast("bigint").alias("retries"))


def relative_paths(files: DataFrame, root: Column, bucket: Column) -> DataFrame:
    """Path of each file below its table root; NULL when the file lies elsewhere."""
    prefix = F.concat(F.rtrim(root, F.lit("/")), F.lit("/"))
    inside = (F.col("bucket") == bucket) & F.startswith(F.col("key"), prefix)
    rest = F.substring(F.col("key"), F.length(prefix) + 1, F.length(F.col("key")))
    return files.withColumn("path", F.when(inside, rest)).withColumn("inside", F.coalesce(inside, F.lit(False)))
