"""Bench: headline loads and operators, one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Every query runs over its whole tables; results go to Spark's `noop` sink unless the query is
a load, which writes, publishes and validates.
"""

from __future__ import annotations

import json
import os
import sys
import time

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
# Rows of the wide table, as in the published numbers.
WIDE_ROWS = int(os.environ.get("BENCH_WIDE_ROWS", "1000000"))

OPERATORS = [
    "scan_arrow_ranges",
    "column_histogram",
    "column_histogram_quantiles",
    "histogram_boundaries",
    "assign_ranges",
    "range_coverage",
    "range_skew",
    "load_strategy",
    "discover_columns",
    "typed_projection",
    "valid_manifests",
    "select_manifests",
    "task_summary",
    "rate_per_minute",
    "metrics_long",
    "table_checksum",
    "table_fingerprint_md5",
    "reconcile_ranges",
    "publish_zero_copy",
    "publish_rewrite",
    "rate_stream",
]


def main() -> None:
    from rangehaul.checks import all_checks
    from rangehaul.plans.ingest import IngestOptions, ingest
    from rangehaul.session import load_session, scratch_path
    from rangehaul.sinks.snapshots import Variant, write_snapshot, writer_matrix
    from rangehaul.sources.generated import numbers, wide

    spark = load_session(
        "rangehaul-bench",
        f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "6g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    facts: dict[str, object] = {}

    def timed(name, action):
        started = time.perf_counter()
        result = action()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]} s", file=sys.stderr)
        return result

    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    rows = lines.count()
    for ranges in (1, 4, 8):
        options = IngestOptions(ranges=ranges)
        run = timed(
            f"ingest_lineitem_{ranges}_ranges",
            lambda: ingest(lines, scratch_path(spark, "bench"), "bench", "lineitem", "l_orderkey", options).first(),
        )
        phases = {k: round(v, 3) for k, v in run["durations_seconds"].items()}
        facts[f"ingest_lineitem_{ranges}_ranges"] = {
            "rows_per_second": round(rows / phases["extraction"]), "output_bytes": run["output_bytes"], **phases
        }
    variants = [Variant("snappy"), Variant("zstd", compression="zstd"), Variant("uncompressed", compression="uncompressed")]
    written = timed("writer_matrix_lineitem", lambda: writer_matrix(lines, scratch_path(spark, "bench"), variants).collect())
    facts["writers"] = {r["name"]: {"seconds": round(r["write_seconds"], 3), "bytes": r["output_bytes"]} for r in written}

    # The table of the published numbers: 1,000,000 rows of 48 columns, dense keys then stretched ones.
    source_path = scratch_path(spark, "wide-source")
    write_snapshot(wide(numbers(spark, WIDE_ROWS), WIDE_ROWS * 9 // 10), source_path)
    table = spark.read.parquet(source_path)
    # Once as a file set in any order (rows move to their range), once as a table sorted by its key.
    for name, in_order in (("ingest_wide_8_ranges", False), ("ingest_wide_8_ranges_sorted", True)):
        options = IngestOptions(ranges=8, sorted_by_key=in_order)
        run = timed(name, lambda: ingest(table, scratch_path(spark, "bench"), "bench", "wide", "id", options).first())
        phases = {k: round(v, 3) for k, v in run["durations_seconds"].items()}
        facts[name] = {
            "rows_per_second": round(run["rows"] / phases["extraction"]), "output_bytes": run["output_bytes"], "files": run["files"], **phases
        }

    queries = all_checks().QUERIES
    for name in OPERATORS:
        timed(name, lambda: queries[name](spark, SF).write.format("noop").mode("overwrite").save())

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF.rstrip("/")),
                "cpus": CPUS,
                "facts": facts,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
