"""Loading a database table: plan from its catalog, read by JDBC ranges, publish as any load."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from rangehaul.functions.sizing import FetchLimits, PartitionLimits, cluster_limits, fetch_rows, partition_count
from rangehaul.functions.types import SourceColumn
from rangehaul.operators.conform import typed_projection
from rangehaul.operators.profile import split_candidates
from rangehaul.operators.ranges import choose_split_key, histogram_boundaries, linear_boundaries, range_predicates
from rangehaul.plans.ingest import IngestOptions, RangePlan, ingest
from rangehaul.sinks.ledger import Ledger
from rangehaul.sources import catalog as C
from rangehaul.sources.jdbc import JdbcTable, read_query, read_ranges


def plan_from_catalog(
    profile: DataFrame,
    sizes: DataFrame,
    steps: DataFrame | None = None,
    bounds: DataFrame | None = None,
    limits: PartitionLimits = PartitionLimits(),
    dialect: str = "sqlserver",
) -> RangePlan:
    """Ranges of one table from catalog frames.

    profile: columns of the table as `discover_columns` gives them (with `position`), sizes: (table, rows, bytes),
    steps: (high, range_rows, equal_rows) of the key in order of its catalog histogram, bounds: (low, high).
    """
    requested = sizes.select(partition_count(F.col("bytes"), limits).alias("n")).first()["n"]
    chosen = choose_split_key(profile).select("column", "nullable").first()
    if requested == 1 or chosen is None:
        return RangePlan("single_scan", None, (), ("1=1",), requested, None)
    key = chosen["column"]
    named = lambda df: df.withColumns({"table": F.lit(""), "column": F.lit(key)})
    candidates = []
    if steps is not None:
        candidates.append(("histogram_ranges", histogram_boundaries(named(steps), requested)))
    if bounds is not None:
        candidates.append(("indexed_ranges", linear_boundaries(named(bounds), requested)))
    for strategy, points in candidates:
        ranges = range_predicates(points, chosen["nullable"], dialect=dialect).orderBy("chunk").collect()
        if ranges:
            return RangePlan(
                strategy, key, tuple(r["low"] for r in ranges[1:]), tuple(r["predicate"] for r in ranges), requested, None
            )
    return RangePlan("single_scan", key, (), ("1=1",), requested, None)


def planned_fetch_rows(sizes: DataFrame, ranges: int, limits: FetchLimits = FetchLimits()) -> int:
    """Rows per fetch for a plan; catalog sizes are estimates, so this affects speed only."""
    return sizes.select(fetch_rows(F.col("rows"), F.col("bytes"), F.lit(ranges), limits).alias("n")).first()["n"]


def ingest_jdbc(
    spark: SparkSession,
    table: JdbcTable,
    plan: RangePlan,
    columns: Sequence[SourceColumn],
    root: str,
    run_id: str,
    fetch: int | None = None,
    options: IngestOptions = IngestOptions(),
) -> DataFrame:
    """Load a database table by the ranges of its plan; one task and connection per range."""
    read = lambda predicates: typed_projection(read_ranges(spark, table, predicates, columns, fetch), columns, table.dialect)
    # As source of proof the table is read by its ranges too, not through one connection.
    return ingest(read(list(plan.predicates)), root, run_id, table.table, plan.column, options, plan, read)


@dataclass(frozen=True)
class TablePlan:
    """All that a load of one table needs: the table at its snapshot, its ranges, its columns, rows per fetch, and what planning had to do without."""

    table: JdbcTable
    plan: RangePlan
    columns: tuple[SourceColumn, ...]
    fetch: int
    warnings: tuple[str, ...]


def plan_table(
    spark: SparkSession,
    table: JdbcTable,
    limits: PartitionLimits | None = None,
    query: C.Query | None = None,
    connections: int = 8,
    count_rows: bool = False,
) -> TablePlan:
    """From a table's name to its ranges: catalog, split key, histogram of the key, else its bounds, else one scan.

    Without `limits` the ranges follow the cluster's slots, its `connections` and the size of the table. Statistics that cannot be read are a warning, not a
    failure. `count_rows` counts the source at its snapshot, so that the load is checked against it. `query` stands in for the database in tests.
    """
    run = query or (lambda text: read_query(spark, table, text))
    found = C.resolve(spark, table, run)
    table, warnings = found.table, list(found.warnings)
    limits = limits or cluster_limits(spark.sparkContext.defaultParallelism, connections)
    candidates, dialect = split_candidates(found.profile), table.dialect
    sizes = spark.createDataFrame(found.sizes.collect(), found.sizes.schema).coalesce(1)
    plan = plan_from_catalog(candidates, sizes, None, None, limits, dialect)
    # A key was chosen, and one range is not enough: only now its statistics are read.
    if plan.column is not None:
        key = found.profile.filter(F.col("column") == plan.column).first()
        kind = C.key_type(key["sql_type"], key["precision"], key["scale"])
        stats = key["stats_id"] if "stats_id" in found.profile.columns else None
        if stats is not None:
            steps = _local(spark, warnings, "histogram", lambda: C.typed_steps(run(C.histogram_query(found.object_id, stats, key["sql_type"])), kind))
            if steps is not None:
                plan = plan_from_catalog(candidates, sizes, steps, None, limits, dialect)
        if plan.strategy == "single_scan":
            column = SourceColumn(plan.column, key["sql_type"])
            bounds = _local(spark, warnings, "bounds", lambda: C.typed_bounds(run(C.bounds_query(table, column)), kind))
            if bounds is not None:
                plan = plan_from_catalog(candidates, sizes, None, bounds, limits, dialect)
    if count_rows:
        plan = replace(plan, source_rows=int(run(C.count_query(table)).first()[0]))
    return TablePlan(table, plan, found.columns, planned_fetch_rows(sizes, plan.ranges), tuple(warnings))


def _local(spark: SparkSession, warnings: list[str], what: str, frame: Callable[[], DataFrame]) -> DataFrame | None:
    """A few catalog rows as a frame of the driver; None with a warning where the source refuses or has none."""
    try:
        found = frame()
        rows = found.collect()
    except Exception as error:  # drivers raise what they like where a permission is missing
        warnings.append(f"{what} not available: {type(error).__name__}")
        return None
    if not rows:
        warnings.append(f"{what} not available: no rows")
        return None
    return spark.createDataFrame(rows, found.schema).coalesce(1)


def ingest_table(
    spark: SparkSession,
    table: JdbcTable,
    root: str,
    run_id: str,
    options: IngestOptions = IngestOptions(),
    query: C.Query | None = None,
    read: Callable[[TablePlan, list[str]], DataFrame] | None = None,
    connections: int = 8,
) -> DataFrame:
    """Plan and load a table by its name. The snapshot of the first attempt is kept: catalog, bounds, ranges and every retry share it."""
    ledger = Ledger(spark, f"{root.rstrip('/')}/ledger")
    finished = ledger.finished(run_id)
    if not finished.isEmpty():
        return finished
    kept = ledger.read("boundaries").filter((F.col("run_id") == run_id) & (F.col("kind") == "snapshot")).first()
    if kept is not None:
        table = replace(table, snapshot=int(kept["value"]))
    planned = plan_table(spark, table, options.limits, query, connections, options.require_source_match)
    if kept is None and planned.table.snapshot is not None:
        ledger.append_row("boundaries", run_id=run_id, kind="snapshot", value=str(planned.table.snapshot))
    if read is None:
        return ingest_jdbc(spark, planned.table, planned.plan, planned.columns, root, run_id, planned.fetch, options)
    typed = lambda predicates: typed_projection(read(planned, predicates), planned.columns, planned.table.dialect)
    return ingest(typed(list(planned.plan.predicates)), root, run_id, table.table, planned.plan.column, options, planned.plan, typed)
