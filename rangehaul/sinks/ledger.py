"""The run ledger: small append-only tables that say what was asked, written and published.

A reader sees a run only through its ledger rows, which are appended after the data is complete. Several writers
may share a ledger: who asks for a run and who publishes a version is settled by documents that are written once.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rangehaul.sinks.commits import document, documents, put_if_absent

# Tables of the ledger.
SCHEMAS = {
    "requests": "run_id string, request string, request_hash string, requested_at timestamp",
    "plans": "run_id string, chunk int, low string, high string, predicate string, strategy string, `column` string, "
    "requested int, source_rows bigint",
    "boundaries": "run_id string, kind string, `value` string",
    "sources": "run_id string, chunk int, path string, size bigint, modified timestamp, rows bigint, bytes bigint",
    "manifests": "run_id string, index int, attempt_id string, path string, rows bigint, bytes bigint, "
    "files bigint, completed_at string",
    "discards": "run_id string, attempt_id string",
    "snapshots": "run_id string, `table` string, version bigint, mode string, index int, path string, rows bigint, "
    "bytes bigint, files bigint, published_at timestamp",
    "runs": "run_id string, engine string, read_mode string, profile string, `table` string, started_at timestamp, "
    "status string, error_type string, strategy string, `column` string, partitions int, rows bigint, "
    "source_rows bigint, output_bytes bigint, files bigint, mode string, durations_seconds map<string,double>, "
    "success int",
}
# What tells rows of `snapshots` apart.
PUBLISHED = ["run_id", "table", "version", "index", "path"]


class RunConflict(ValueError):
    """A run id was used again with another request."""


def canonical(request: dict) -> str:
    """One text per request, whatever the order of its keys."""
    return json.dumps(request, sort_keys=True, separators=(",", ":"), ensure_ascii=False, default=str)


class Ledger:
    """Ledger tables below a root folder, in Parquet."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._present: set[str] = set()

    def _exists(self, name: str) -> bool:
        return self.present(f"{self.root}/{name}")

    def present(self, folder: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def read(self, name: str) -> DataFrame:
        """A ledger table; one that nothing was appended to yet is empty."""
        schema = T.StructType.fromDDL(SCHEMAS[name])
        if name not in self._present and not self._exists(name):
            return self.spark.createDataFrame([], schema)
        self._present.add(name)
        # Files of older ledgers lie in the table's folder itself.
        rows = self.spark.read.option("recursiveFileLookup", "true").schema(schema).parquet(f"{self.root}/{name}")
        # Writers of one run may both append what its version document names.
        return rows.dropDuplicates(PUBLISHED) if name == "snapshots" else rows

    def append(self, name: str, rows: DataFrame) -> None:
        schema = T.StructType.fromDDL(SCHEMAS[name])
        typed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
        # Writers do not share a folder while they write; a hidden one gets its name when it is whole.
        part = uuid.uuid4().hex
        typed.write.parquet(f"{self.root}/{name}/_{part}")
        hidden, final = (self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}/{p}") for p in (f"_{part}", part))
        if not hidden.getFileSystem(self.spark._jsc.hadoopConfiguration()).rename(hidden, final):
            raise OSError(f"{hidden} cannot be renamed")

    def append_row(self, name: str, **values) -> None:
        schema = T.StructType.fromDDL(SCHEMAS[name])
        row = tuple(values.get(field) for field in schema.names)
        self.append(name, self.spark.createDataFrame([row], schema).coalesce(1))

    def claim(self, run_id: str, request: dict) -> bool:
        """Record a request. True when it is new, False when it is known; another content fails."""
        text = canonical(request)
        offered = hashlib.sha256(text.encode()).hexdigest()
        known = [r["request_hash"] for r in self.read("requests").filter(F.col("run_id") == run_id).select("request_hash").distinct().collect()]
        if any(h != offered for h in known):
            raise RunConflict(f"run {run_id!r} exists with another request")
        if known:
            return False
        claim = f"{self.root}/claims/{quote(run_id, safe='')}"
        first = put_if_absent(self.spark, claim, offered)
        if not first and document(self.spark, claim) != offered:
            raise RunConflict(f"run {run_id!r} exists with another request")
        row = self.spark.range(1).select(
            F.lit(run_id).alias("run_id"),
            F.lit(text).alias("request"),
            F.lit(offered).alias("request_hash"),
            F.current_timestamp().alias("requested_at"),
        )
        self.append("requests", row)
        return first

    def commit(self, table: str, run_id: str, rows: list[dict], after: int = 0) -> tuple[int, list[dict]]:
        """Take the next version of a table for a run; returns the version and the rows to publish.

        A run has one version: where another writer took it for the same run, that version and its rows are returned.
        Versions have no gaps, and every one behind the last known is looked at before the next is taken.
        """
        folder = f"{self.root}/versions/{quote(table, safe='')}"
        offered = json.dumps({"run_id": run_id, "rows": rows}, default=str)
        seen: set[str] = set()
        while True:
            names = documents(self.spark, folder)
            for name in names:
                if name not in seen:
                    stored = json.loads(document(self.spark, f"{folder}/{name}"))
                    if stored["run_id"] == run_id:
                        return int(name), stored["rows"]
                    seen.add(name)
            version = max([after, *(int(n) for n in names[-1:])]) + 1
            if put_if_absent(self.spark, f"{folder}/{version:020d}", offered):
                return version, rows

    def finished(self, run_id: str) -> DataFrame:
        """The stored result of a run that succeeded, at most one row."""
        done = self.read("runs").filter((F.col("run_id") == run_id) & (F.col("success") == 1))
        return done.orderBy(F.desc("started_at")).limit(1)


def run_conflicts(stored: DataFrame, offered: DataFrame) -> DataFrame:
    """Requests against the ledger: new, repeat (same content) or conflict (other content).

    The ledger is reduced to one row per run before it meets the requests, however many
    requests a run has.
    """
    known = stored.groupBy("run_id").agg(F.min("request_hash").alias("_low"), F.max("request_hash").alias("_high"))
    asked = offered.select("run_id", "request_hash").distinct()
    same = (F.col("_low") == F.col("request_hash")) & (F.col("_high") == F.col("request_hash"))
    status = F.when(F.col("_low").isNull(), "new").when(same, "repeat").otherwise("conflict")
    return asked.join(known, "run_id", "left").select("run_id", "request_hash", status.alias("status"))
