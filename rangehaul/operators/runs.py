"""Run metrics as tables: summaries, throughput, rates, progress and comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from rangehaul.operators.manifests import first_per_key


def per_second(amount: Column, seconds: Column) -> Column:
    """Amount over seconds; the divisor never falls below a nanosecond."""
    return amount.cast("double") / F.greatest(seconds.cast("double"), F.lit(1e-9))


def task_summary(tasks: DataFrame, phases: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Totals over task documents. Phase seconds add up across tasks that ran side by side;
    `span_seconds` is the wall clock from the first start to the last finish."""
    zero = F.lit(0).cast("bigint")
    total = lambda name: F.coalesce(F.sum(name), zero).alias(name)
    span = F.coalesce(F.max("finished_at") - F.min("started_at"), F.lit(0.0))
    summed = tasks.groupBy(*by).agg(
        F.count("*").alias("tasks"),
        total("chunks"),
        total("batches"),
        total("rows"),
        total("bytes"),
        *[F.coalesce(F.sum(p).cast("double"), F.lit(0.0)).alias(f"{p}_sum") for p in phases],
        F.coalesce(F.max("wall_seconds"), F.lit(0.0)).alias("wall_seconds_max"),
        span.alias("span_seconds"),
    )
    return summed.withColumns(
        {
            "rows_per_second": per_second(F.col("rows"), F.col("span_seconds")),
            "bytes_per_second": per_second(F.col("bytes"), F.col("span_seconds")),
        }
    )


def throughput(runs: DataFrame, seconds: str = "seconds") -> DataFrame:
    """Rows and output bytes per second of each run."""
    return runs.withColumns(
        {
            "rows_per_second": per_second(F.col("rows"), F.col(seconds)),
            "bytes_per_second": per_second(F.col("output_bytes"), F.col(seconds)),
        }
    )


def write_amplification(staged: DataFrame, published: DataFrame, by: Sequence[str] = ("run_id",)) -> DataFrame:
    """(staged + rewritten bytes) over active bytes, per run.

    staged(by…, size): files below the staging root. published(by…, size, mode): active files;
    only mode 'rewrite' writes its bytes a second time.
    """
    zero = F.lit(0).cast("bigint")
    written = staged.groupBy(*by).agg(F.sum("size").alias("staging_bytes"))
    active = published.groupBy(*by).agg(
        F.sum("size").alias("output_bytes"),
        F.sum(F.when(F.col("mode") == "rewrite", F.col("size")).otherwise(zero)).alias("rewritten_bytes"),
    )
    names = ["staging_bytes", "output_bytes", "rewritten_bytes"]
    joined = written.join(active, list(by), "full_outer").na.fill(0, names)
    ratio = (F.col("staging_bytes") + F.col("rewritten_bytes")).cast("double") / F.greatest(
        F.col("output_bytes"), F.lit(1).cast("bigint")
    )
    return joined.select(*by, *names, ratio.alias("amplification"))


def phase_totals(documents: DataFrame, durations: str = "durations_seconds", by: Sequence[str] = ()) -> DataFrame:
    """Seconds per phase over all documents; the map is opened before the shuffle."""
    opened = documents.select(*by, F.explode(durations).alias("phase", "_seconds"))
    return opened.groupBy(*by, "phase").agg(F.sum("_seconds").alias("seconds"))


def max_by_group(samples: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    return samples.groupBy(*by).agg(F.max(value).alias(value))


def latest_sample(samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    return samples.groupBy(*series).agg(F.max_by(value, ts).alias(value))


def gauge_by_group(samples: DataFrame, series: Sequence[str], by: Sequence[str], ts: str = "ts", value: str = "value") -> DataFrame:
    """Sum over the latest sample of each series."""
    return latest_sample(samples, series, ts, value).groupBy(*by).agg(F.sum(value).alias(value))


def rate_per_minute(
    samples: DataFrame, series: Sequence[str], by: Sequence[str], ts: str = "ts", value: str = "value", tie: str | None = None
) -> DataFrame:
    """Increase of counters per minute and group, divided by 60 seconds.

    A step is the difference to the sample before; after a counter reset it is the new reading.
    A step counts in the minute of its later sample; the edge extrapolation of monitoring
    servers is not applied. A series is cut into minutes before samples are compared, so one
    hot series spreads over as many tasks as it has minutes; only minute summaries (one row
    each) are then compared across minutes.
    """
    # Zone-free truncation: take the seconds off.
    seconds = F.date_part(F.lit("SECOND"), F.col(ts))
    minute = F.col(ts) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    within = W.partitionBy(*series, "_minute").orderBy(F.col(ts), *([F.col(tie)] if tie else []))
    step = lambda now, before: F.when(now >= before, now - before).otherwise(now)
    stepped = samples.withColumn("_minute", minute).withColumn("_before", F.lag(value).over(within))
    order = F.struct(ts, tie) if tie else F.col(ts)
    summaries = stepped.groupBy(*series, "_minute").agg(
        F.sum(F.when(F.col("_before").isNotNull(), step(F.col(value), F.col("_before")))).alias("_inside"),
        F.min_by(value, order).alias("_first"),
        F.max_by(value, order).alias("_last"),
    )
    across = W.partitionBy(*series).orderBy("_minute")
    joined = summaries.withColumn("_before", F.lag("_last").over(across))
    gained = F.coalesce(F.col("_inside"), F.lit(0)) + F.when(
        F.col("_before").isNotNull(), step(F.col("_first"), F.col("_before"))
    ).otherwise(F.lit(0))
    return (
        joined.withColumn("_gained", gained)
        .groupBy(*by, F.col("_minute").alias("minute"))
        .agg(F.sum("_gained").alias("increase"))
        .withColumn("per_second", F.col("increase").cast("double") / F.lit(60.0))
    )


def progress_pct(chunks: DataFrame, done: Column, by: Sequence[str] = ("table",)) -> DataFrame:
    """Done, total and percent of chunks per table."""
    counted = chunks.groupBy(*by).agg(F.count_if(done).alias("done"), F.count("*").alias("total"))
    return counted.withColumn("percent", F.lit(100.0) * F.col("done") / F.greatest(F.col("total"), F.lit(1)))


def select_series(samples: DataFrame, patterns: Mapping[str, str | None]) -> DataFrame:
    """Keep the series whose labels match regular expressions as a whole; None or `.*` means all."""
    kept = samples
    for label, pattern in patterns.items():
        if pattern not in (None, ".*"):
            kept = kept.filter(F.col(label).rlike(f"^(?:{pattern})$"))
    return kept


def label_values(samples: DataFrame, label: str) -> DataFrame:
    return samples.select(label).distinct()


def latest_run(runs: DataFrame, keys: Sequence[str] = ("engine", "read_mode", "profile", "table"), tie: str = "run_id") -> DataFrame:
    """The run that started last for each engine, reader, profile and table."""
    return first_per_key(runs, list(keys), F.col("started_at").desc(), F.col(tie).desc())


def compare_modes(latest: DataFrame, base: str, other: str, by: Sequence[str] = ("profile", "table"), mode: str = "read_mode") -> DataFrame:
    """Throughput of two readers side by side, and their ratio; only where both exist."""
    pick = lambda m: F.max(F.when(F.col(mode) == m, F.col("rows_per_second")))
    return (
        latest.groupBy(*by)
        .agg(pick(base).alias("base_rate"), pick(other).alias("other_rate"))
        .filter(F.col("base_rate").isNotNull() & F.col("other_rate").isNotNull())
        .withColumn("ratio", F.col("other_rate") / F.greatest(F.col("base_rate"), F.lit(1e-9)))
    )


def benchmark_report(latest: DataFrame, keys: Sequence[str] = ("engine", "read_mode", "profile", "table")) -> DataFrame:
    """The comparison table: sizes in MiB, seconds and rates rounded, ordered by key."""
    mib = lambda name: F.round(F.col(name) / F.lit(1048576.0), 2)
    return latest.select(
        *keys,
        "rows",
        mib("source_estimated_bytes").alias("source_mib"),
        mib("output_bytes").alias("output_mib"),
        "partitions",
        "strategy",
        F.round("seconds", 2).alias("seconds"),
        F.round(per_second(F.col("rows"), F.col("seconds")), 1).alias("rows_per_second"),
    ).orderBy(*keys)


def latest_version(versions: DataFrame, by: Sequence[str] = ("table",), version: str = "version") -> DataFrame:
    """The last committed version per table."""
    return first_per_key(versions, list(by), F.col(version).desc())


def metrics_long(
    runs: DataFrame,
    metrics: Sequence[str],
    labels: Sequence[str],
    durations: Mapping[str, str] | str = "durations_seconds",
    infos: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per metric, per phase and per information: (metric, labels map, value).

    `durations` names maps of seconds by phase, each with the prefix its phases get. `infos` gives metrics
    of constant value 1 that carry further columns as labels. A NULL metric gives no row. One
    projection per run: gauges, phases and infos are built side by side, without a join.
    """
    maps = {durations: ""} if isinstance(durations, str) else durations
    pairs = lambda names: F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("string"))])
    row = lambda metric, extra, value: F.struct(
        F.lit(metric).alias("metric"), extra.alias("labels"), value.cast("double").alias("value")
    )
    base = F.col("_labels")
    parts = [F.array(*[row(m, base, F.col(m)) for m in metrics])] if metrics else []
    phase = lambda entry, prefix: F.create_map(F.lit("phase"), F.concat(F.lit(prefix), entry["key"]))
    by_phase = lambda prefix: lambda e: row("duration_seconds", F.map_concat(base, phase(e, prefix)), e["value"])
    for column, prefix in maps.items():
        entries = F.transform(F.map_entries(column), by_phase(prefix))
        parts.append(F.coalesce(entries, F.array().cast(_METRIC_ROWS)))
    for metric, names in (infos or {}).items():
        parts.append(F.array(row(metric, F.map_concat(base, pairs(names)), F.lit(1))))
    labelled = runs.withColumn("_labels", pairs(labels))
    return labelled.select(F.inline(F.concat(*parts))).filter(F.col("value").isNotNull())


_METRIC_ROWS = "array<struct<metric:string,labels:map<string,string>,value:double>>"


def _plain(value):
    """Whole numbers in full, others as they are."""
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    return F.when(whole, value.cast("decimal(20,1)").cast("string")).otherwise(value.cast("string"))


def metrics_text(metrics: DataFrame, prefix: str = "") -> DataFrame:
    """Metrics as text lines `name{label="value",…} number`, with quotes, backslashes and line ends escaped."""
    escaped = lambda v: F.replace(
        F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n")
    )
    pairs = F.transform(
        F.map_entries("labels"), lambda e: F.concat(e["key"], F.lit('="'), F.coalesce(escaped(e["value"]), F.lit("")), F.lit('"'))
    )
    line = F.concat(F.lit(prefix), F.col("metric"), F.lit("{"), F.array_join(pairs, ","), F.lit("} "), _plain(F.col("value")))
    return metrics.select(line.alias("value"))
