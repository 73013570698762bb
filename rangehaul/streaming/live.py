"""Results of a stream that are complete after every batch: updates kept by batch, the newest row of each key counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

BATCH = "batch"


def keep_batch(updates: DataFrame, batch_id: int, path: str) -> None:
    """Store what a batch changed. A batch that is repeated after a failure replaces itself, so nothing counts twice."""
    updates.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def newest_rows(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """The result as of the last batch: of each key the row of its newest batch; empty before the first batch."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    kept = spark.read.schema(T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).parquet(path)
    newest = Window.partitionBy(*keys).orderBy(F.desc(BATCH))
    return kept.withColumn("_newest", F.row_number().over(newest)).where("_newest = 1").select(*schema.names)


def run_updates(stream: DataFrame, path: str, keys: Sequence[str], checkpoint: str, name: str) -> DataFrame:
    """Process what is there in `update` mode and return the whole result, minutes that are still open included.

    Late rows: those of a group whose window has passed the watermark are dropped by Spark, all others correct
    the row that was given out before.
    """
    writer = stream.writeStream.outputMode("update").foreachBatch(lambda updates, batch_id: keep_batch(updates, batch_id, path))
    writer.queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return newest_rows(stream.sparkSession, path, stream.schema, keys)
