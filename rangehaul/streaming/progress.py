"""Live progress and rates over arriving manifests and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rangehaul.operators.runs import progress_pct


def stream_files(spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_trigger: int | None = None) -> DataFrame:
    """Files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def progress_stream(manifests: DataFrame, done: Column, by: Sequence[str] = ("table",)) -> DataFrame:
    """Done, total and percent per table; state is one small row per table (`complete` mode)."""
    return progress_pct(manifests, done, by)


def rate_stream(samples: DataFrame, by: Sequence[str], ts: str = "ts", value: str = "value", delay: str = "1 minute") -> DataFrame:
    """Sum of differenced counters per minute and group (`append` mode).

    A minute is given out once the watermark has passed its end, then its state is dropped.
    """
    timed = samples.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    return (
        timed.groupBy(*by, F.window("_ts", "1 minute"))
        .agg(F.sum(value).alias("increase"))
        .select(
            *by,
            F.col("window.start").cast("timestamp_ntz").alias("minute"),
            "increase",
            (F.col("increase").cast("double") / F.lit(60.0)).alias("per_second"),
        )
    )


def run_available(stream: DataFrame, path: str, mode: str, checkpoint: str, name: str) -> DataFrame:
    """Process what is there and return the result.

    Append results go to files; a complete result is written anew by each batch.
    """
    spark = stream.sparkSession
    if mode == "append":
        writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    else:
        writer = stream.writeStream.outputMode(mode).foreachBatch(
            lambda batch, _: batch.write.mode("overwrite").parquet(path)
        )
    query = writer.queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
