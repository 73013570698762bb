"""The load job: plan, stage by ranges, publish once, validate, record."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F, types as T

from rangehaul.functions.hashing import row_hash, wide_sum
from rangehaul.functions.sizing import PartitionLimits, cluster_limits, planned_ranges
from rangehaul.operators.manifests import select_manifests
from rangehaul.operators.profile import _FIXED_WIDTHS, column_histogram, key_bounds
from rangehaul.operators.ranges import assign_ranges, histogram_boundaries, linear_boundaries, range_predicates
from rangehaul.operators.reconcile import reconcile_ranges, table_checksum
from rangehaul.sinks.ledger import Ledger
from rangehaul.sources.files import file_inventory
from rangehaul.sinks import snapshots as sink

CHUNK = "chunk"
# Strategy of a plan whose chunks are sets of source files.
FILE_CHUNKS = "file_chunks"
# Assumed width of text in a size estimate when the caller gives no source size.
TEXT_WIDTH = 32


@dataclass(frozen=True)
class IngestOptions:
    """What a load may choose. `ranges` or `source_bytes` settle the number of ranges."""

    ranges: int | None = None
    source_bytes: int | None = None
    # None: as many ranges as the cluster's slots and the bytes call for.
    limits: PartitionLimits | None = None
    histogram_steps: int = 200
    accuracy: int = 10_000
    compression: str = "zstd"
    rows_per_file: int = 5_000_000
    # The source is sorted by the key: rows of a task belong to few ranges and need not move.
    sorted_by_key: bool = False
    # "auto" publishes staged files by reference, "rewrite" writes sized files.
    publication: str = "auto"
    files: int | None = None
    # Size of rewritten files; the staged chunks, in the same codec, tell how many that makes.
    file_bytes: int | None = None
    # "strict": counts and fingerprints, "metadata": counts only.
    validation: str = "strict"
    require_source_match: bool = True
    profile: str = "default"
    # Chunks of files that are staged by one job.
    wave_chunks: int = 64

    def __post_init__(self) -> None:
        # Codecs and modes a load knows.
        allowed = {"compression": ("snappy", "zstd", "none", "uncompressed"), "publication": ("auto", "rewrite"),
                   "validation": ("strict", "metadata")}
        for name, values in allowed.items():
            if getattr(self, name) not in values:
                raise ValueError(f"{name} must be one of {', '.join(values)}")


@dataclass(frozen=True)
class RangePlan:
    """Boundaries of one table: the only thing planning brings to the driver."""

    strategy: str
    column: str | None
    boundaries: tuple
    predicates: tuple[str, ...]
    requested: int
    source_rows: int | None

    @property
    def ranges(self) -> int:
        return len(self.predicates)


def _declared_width(schema: T.StructType) -> int:
    return sum(_FIXED_WIDTHS.get(f.dataType.simpleString(), TEXT_WIDTH) for f in schema.fields)


def _requested(spark: SparkSession, source_bytes: int, options: IngestOptions) -> int:
    if options.ranges is not None:
        return max(1, options.ranges)
    return planned_ranges(source_bytes, options.limits or cluster_limits(spark.sparkContext.defaultParallelism))


def plan_ranges(df: DataFrame, key: str | None, options: IngestOptions = IngestOptions()) -> RangePlan:
    """Boundaries of a key from its histogram, else from its bounds; scans read the key column only."""
    spark = df.sparkSession
    rows = None
    source_bytes = options.source_bytes
    if source_bytes is None and options.ranges is None:
        rows = df.count()
        source_bytes = rows * _declared_width(df.schema)
    requested = _requested(spark, source_bytes or 0, options)
    if requested == 1 or key is None:
        return RangePlan("single_scan", None if requested == 1 else key, (), ("1=1",), requested, rows)
    found = column_histogram(df, key, options.histogram_steps, options.accuracy)
    # At most one row per step; kept so that the scan does not run twice.
    rows_of_steps = found.collect()
    rows = int(sum(r["range_rows"] + r["equal_rows"] for r in rows_of_steps))
    steps = spark.createDataFrame(rows_of_steps, found.schema).coalesce(1)
    named = lambda df: df.withColumns({"table": F.lit(""), "column": F.lit(key)})
    cut = lambda points: range_predicates(points, True).orderBy("chunk").collect()
    ranges, strategy = cut(histogram_boundaries(named(steps), requested)), "histogram_ranges"
    if not ranges:
        low, high = key_bounds(df, key)
        if low is not None and low < high:
            dtype = df.schema[key].dataType
            schema = T.StructType([T.StructField("low", dtype), T.StructField("high", dtype)])
            bounds = spark.createDataFrame([(low, high)], schema)
            ranges, strategy = cut(linear_boundaries(named(bounds), requested)), "indexed_ranges"
    if not ranges:
        return RangePlan("single_scan", key, (), ("1=1",), requested, rows)
    boundaries = tuple(r["low"] for r in ranges[1:])
    return RangePlan(strategy, key, boundaries, tuple(r["predicate"] for r in ranges), requested, rows)


def run_plan(
    ledger: Ledger, run_id: str, df: DataFrame, key: str | None, options: IngestOptions, given: RangePlan | None = None
) -> RangePlan:
    """The plan of a run: made once and stored, so that a resumed run keeps its ranges even when
    the source has changed meanwhile."""
    stored = ledger.read("plans").filter(F.col("run_id") == run_id)
    column = given.column if given is not None else key
    dtype = df.schema[column].dataType if column is not None else T.StringType()
    known = stored.select("*", F.col("low").cast(dtype).alias("boundary")).orderBy("chunk").collect()
    if known:
        first = known[0]
        return RangePlan(
            first["strategy"], first["column"], () if first["strategy"] == FILE_CHUNKS else tuple(r["boundary"] for r in known[1:]),
            tuple(r["predicate"] for r in known), first["requested"], first["source_rows"],
        )
    plan = given if given is not None else plan_ranges(df, key, options)
    schema = T.StructType(
        [T.StructField("chunk", T.IntegerType()), T.StructField("low", dtype), T.StructField("high", dtype),
         T.StructField("predicate", T.StringType())]
    )
    edges = [None, *plan.boundaries, *[None] * (plan.ranges - len(plan.boundaries))]
    rows = [(i, edges[i], edges[i + 1], predicate) for i, predicate in enumerate(plan.predicates)]
    constants = {"run_id": run_id, "strategy": plan.strategy, "column": plan.column, "requested": plan.requested,
                 "source_rows": plan.source_rows}
    frame = ledger.spark.createDataFrame(rows, schema).withColumns({k: F.lit(v) for k, v in constants.items()})
    ledger.append("plans", frame.coalesce(1))
    return plan


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def ingest(
    source: DataFrame,
    root: str,
    run_id: str,
    table: str,
    key: str | None = None,
    options: IngestOptions = IngestOptions(),
    plan: RangePlan | None = None,
    read: Callable[[list[str]], DataFrame] | None = None,
) -> DataFrame:
    """Load a whole table and return its run row.

    A finished run returns its stored result. An unfinished run continues: chunks with a
    manifest are not read again.

    A database table brings its own `plan` (from its catalog) and `read`, which turns predicates
    into a frame with one partition per predicate; its rows are written where they were read.
    `source` then only gives the schema and, for a strict check over several attempts, the rows.
    """
    spark = source.sparkSession
    ledger = Ledger(spark, f"{root.rstrip('/')}/ledger")
    # How many chunks go in one job may differ between attempts.
    chosen = {name: value for name, value in asdict(options).items() if name != "wave_chunks" and (name, value) != ("file_bytes", None)}
    request = {"table": table, "key": key, "schema": source.schema.simpleString(), "options": chosen}
    ledger.claim(run_id, request)
    finished = ledger.finished(run_id)
    if not finished.isEmpty():
        return finished
    started_at = datetime.now(timezone.utc)
    clock = time.perf_counter()
    durations: dict[str, float] = {}
    known = {"engine": "spark", "read_mode": "ranges", "profile": options.profile, "table": table, "started_at": started_at}

    def lap(phase: str, since: float) -> float:
        durations[phase] = time.perf_counter() - since
        return time.perf_counter()

    try:
        mark = time.perf_counter()
        plan = run_plan(ledger, run_id, source, key, options, plan)
        mark = lap("planning", mark)
        attempt = _stage(ledger, source, root, run_id, plan, options, read)
        mark = lap("extraction", mark)
        selected = _selected(ledger, run_id, plan.ranges)
        # Nothing is published before the staged chunks are proven; what fails the proof is staged again by a retry.
        try:
            totals, checksum = _validate(ledger, source, plan, selected, attempt, options)
        except ContentMismatch:
            _discard(ledger, run_id, selected)
            raise
        mark = lap("validation", mark)
        mode = _publish(ledger, source.schema, root, run_id, table, selected, options, totals, checksum)
        lap("publication", mark)
        durations["engine_total"] = time.perf_counter() - clock
        snapshot = sink.snapshot_rows(ledger, run_id).agg(F.sum("bytes").alias("b"), F.sum("files").alias("f")).first()
        ledger.append_row(
            "runs", run_id=run_id, status="succeeded", strategy=plan.strategy, column=plan.column, partitions=plan.ranges,
            rows=totals, source_rows=plan.source_rows, output_bytes=snapshot["b"], files=snapshot["f"], mode=mode,
            durations_seconds=durations, success=1, **known,
        )
    except Exception as error:
        durations["engine_total"] = time.perf_counter() - clock
        ledger.append_row(
            "runs", run_id=run_id, status="failed", error_type=type(error).__name__, durations_seconds=durations,
            success=0, **known,
        )
        raise
    return ledger.finished(run_id)


# What a published chunk is.
PARTS = {"index": "int", "path": "string", "rows": "bigint", "bytes": "bigint", "files": "bigint"}


class ContentMismatch(RuntimeError):
    """Rows that were staged are not the rows of the source."""


def _sound(ledger: Ledger, run_id: str) -> DataFrame:
    """Manifests of a run that count: not discarded, and their folders hold the files and bytes they promise."""
    manifests = ledger.read("manifests").filter(F.col("run_id") == run_id)
    discards = ledger.read("discards").filter(F.col("run_id") == run_id).select("attempt_id").distinct()
    known = manifests.join(discards, "attempt_id", "left_anti")
    plain = lambda path: F.regexp_replace(path, r"^[a-zA-Z][a-zA-Z0-9+.-]*:/+", "/")
    # One folder per attempt, wherever its manifests say that it is.
    attempts = known.filter("files > 0").select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).distinct().collect()
    folders = sorted(r["folder"] for r in attempts if ledger.present(r["folder"]))
    if not folders:
        return known.filter("files = 0")
    listed = file_inventory(ledger.spark, folders)
    folders = listed.groupBy(F.regexp_replace(plain(F.col("path")), "/[^/]*$", "").alias("_folder")).agg(
        F.count(F.lit(1)).alias("_files"), F.sum("size").alias("_bytes")
    )
    found = known.withColumn("_folder", plain(F.col("path"))).join(folders, "_folder", "left")
    whole = (F.col("files") == 0) | ((F.col("files") == F.col("_files")) & (F.col("bytes") == F.col("_bytes")))
    return found.filter(whole).select(*manifests.columns)


def _discard(ledger: Ledger, run_id: str, selected: list[Row]) -> None:
    attempts = sorted({r["attempt_id"] for r in selected})
    rows = ledger.spark.createDataFrame([(run_id, a) for a in attempts], "run_id string, attempt_id string")
    ledger.append("discards", rows.coalesce(1))


def _done(ledger: Ledger, run_id: str) -> set[int]:
    """Chunks that have a sound manifest (their number is bounded by the plan)."""
    return {r["index"] for r in _sound(ledger, run_id).select("index").distinct().collect()}


def _pending_rows(source: DataFrame, plan: RangePlan, pending: list[int], options: IngestOptions, read) -> DataFrame:
    """The rows of the pending ranges with their range number, placed for writing."""
    if plan.strategy == FILE_CHUNKS:
        return read(pending)
    # The predicates of the pending ranges reach the scan.
    if read is not None:
        kept = read([plan.predicates[i] for i in pending])
    elif len(pending) < plan.ranges:
        kept = source.filter(F.expr(" OR ".join(f"({plan.predicates[i]})" for i in pending)))
    else:
        kept = source
    if not plan.boundaries:
        return kept.withColumn(CHUNK, F.lit(0))
    assigned = assign_ranges(kept, plan.column, plan.boundaries, CHUNK)
    # Partitions that already are ranges stay where they were read.
    return assigned if options.sorted_by_key or read is not None else assigned.hint("rebalance", CHUNK)


def _stage(ledger: Ledger, source: DataFrame, root: str, run_id: str, plan: RangePlan, options: IngestOptions, read):
    """Write the pending chunks and their manifests; returns what was observed while writing.

    Chunks of files go in waves, each with manifests of its own: what a failure loses is one wave.
    """
    done = _done(ledger, run_id)
    pending = [i for i in range(plan.ranges) if i not in done]
    if not pending:
        return None
    wave = options.wave_chunks if plan.strategy == FILE_CHUNKS else len(pending)
    seen = [_stage_wave(ledger, source, root, run_id, plan, pending[at : at + wave], options, read) for at in range(0, len(pending), wave)]
    checksum = sum(int(c) for _, c in seen) if options.validation == "strict" else None
    return {"rows": sum(n for n, _ in seen), "checksum": checksum, "whole": not done}


def _stage_wave(ledger: Ledger, source: DataFrame, root: str, run_id: str, plan: RangePlan, pending: list[int], options: IngestOptions, read) -> tuple:
    spark = ledger.spark
    placed = _pending_rows(source, plan, pending, options, read)
    attempt_id = uuid.uuid4().hex
    path = f"{root.rstrip('/')}/staging/{run_id}/{attempt_id}"
    seen = Observation(f"staged-{attempt_id}")
    # Observed behind the shuffle, in the tasks that write: each is counted once, even when
    # lost map output is computed again.
    metrics = [F.count(F.lit(1)).alias("rows")]
    if options.validation == "strict":
        metrics.append(wide_sum(row_hash(placed, source.columns)).alias("checksum"))
    observed = placed.observe(seen, *metrics)
    sink.stage_chunks(observed, path, CHUNK, options.compression, options.rows_per_file, already_split=True)
    counted = seen.get
    found = sink.chunk_manifests(sink.chunk_files(spark, path, CHUNK), run_id, attempt_id, path, _now())
    # One small row per range. A range without rows leaves no file, yet it is done.
    rows = found.collect()
    empty = set(pending) - {r["index"] for r in rows}
    rows += [Row(run_id, i, attempt_id, None, 0, 0, 0, _now()) for i in sorted(empty)]
    ledger.append("manifests", spark.createDataFrame(rows, found.schema).coalesce(1))
    return counted["rows"], counted.get("checksum")


def _selected(ledger: Ledger, run_id: str, ranges: int) -> list[Row]:
    """The manifest of each chunk, one small row per range of the plan; none may be missing."""
    selected = select_manifests(_sound(ledger, run_id)).collect()
    missing = sorted(set(range(ranges)) - {r["index"] for r in selected})
    if missing:
        raise RuntimeError(f"no manifest for chunks {missing}")
    return selected


def _publish(ledger: Ledger, schema: T.StructType, root: str, run_id: str, table: str, selected: list[Row], options: IngestOptions, rows: int, checksum) -> str:
    spark = ledger.spark
    snapshots = ledger.read("snapshots")
    known = snapshots.filter(F.col("table") == table).agg(
        F.max("version").alias("version"), F.max(F.when(F.col("run_id") == run_id, F.col("mode"))).alias("mode")
    ).first()
    if known["mode"] is not None:
        return known["mode"]
    taken = lambda rows: ledger.commit(table, run_id, rows, known["version"] or 0)
    filled = [r for r in selected if r["files"]]
    final = f"{root.rstrip('/')}/{table}/{run_id}"
    if not filled:
        # An empty table is published as an empty file with its schema.
        sink.write_snapshot(spark.createDataFrame([], schema), final, compression=options.compression)
        sink.publish_rewrite(ledger, run_id, table, final, taken([])[0])
        return "rewrite"
    if options.publication == "rewrite":
        staged = spark.read.schema(schema).parquet(*sorted(r["path"] for r in filled))
        files = options.files
        if files is None and options.file_bytes is not None:
            files = sink.desired_files(sum(r["bytes"] for r in filled), target_bytes=options.file_bytes, ratio=1.0)
        sink.rewrite(spark, [staged], final, files, options.compression)
        written = spark.read.schema(schema).parquet(final)
        found = table_checksum(written).first() if checksum is not None else Row(rows=written.count(), checksum=None)
        if (found["rows"], found["checksum"]) != (rows, checksum):
            raise RuntimeError("rewritten files differ from the staged rows")
        sink.publish_rewrite(ledger, run_id, table, final, taken([])[0])
        return "rewrite"
    version, chosen = taken([{name: r[name] for name in PARTS} for r in filled])
    sink.publish_by_reference(ledger, run_id, table, spark.createDataFrame([tuple(c[name] for name in PARTS) for c in chosen], ", ".join(f"{n} {t}" for n, t in PARTS.items())), version)
    return "zero_copy"


def _validate(ledger: Ledger, source: DataFrame, plan: RangePlan, selected: list[Row], staged, options: IngestOptions):
    """Counts of manifests, staged chunks and source agree; strictly, so do the fingerprints. Returns rows and fingerprint."""
    promised = sum(r["rows"] for r in selected)
    paths = sorted(r["path"] for r in selected if r["files"])
    snapshot = sink.read_chunks(ledger.spark, paths, source.schema)
    checksum = None
    if options.validation == "strict":
        found = table_checksum(snapshot).first()
        rows, checksum = found["rows"], found["checksum"]
        if staged and staged["whole"]:
            proof = (staged["rows"], staged["checksum"])
        elif options.require_source_match:
            # Written over several attempts: the source itself is the proof.
            again = table_checksum(source).first()
            proof = (again["rows"], again["checksum"])
        else:
            proof = (rows, checksum)
        if (rows, checksum) != proof:
            raise ContentMismatch("snapshot differs from the rows that were read")
    else:
        rows = snapshot.count()
    if staged and staged["whole"] and rows != staged["rows"]:
        raise ContentMismatch(f"snapshot holds {rows} rows, {staged['rows']} were written")
    if rows != promised:
        raise ContentMismatch(f"snapshot holds {rows} rows, manifests promise {promised}")
    if options.require_source_match and plan.source_rows is not None and rows != plan.source_rows:
        raise ContentMismatch(f"snapshot holds {rows} rows, the source {plan.source_rows}")
    return rows, checksum


def reconcile(source: DataFrame, root: str, run_id: str, key: str, options: IngestOptions = IngestOptions()) -> DataFrame:
    """Source against published snapshot, range by range."""
    ledger = Ledger(source.sparkSession, f"{root.rstrip('/')}/ledger")
    plan = run_plan(ledger, run_id, source, key, options)
    copy = sink.read_snapshot(ledger, run_id, source.schema)
    place = lambda df: assign_ranges(df, key, plan.boundaries, CHUNK)
    return reconcile_ranges(place(source), place(copy), CHUNK)
