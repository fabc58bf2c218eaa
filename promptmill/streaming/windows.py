"""Reward means over logging windows of a stream: a windowed aggregation in the state store, in update mode.

Steps are event time (one step a second), a logging window is ``logging_steps``
steps. Each micro-batch emits the windows it changed; ``foreachBatch`` writes
them under the batch id (a replayed batch overwrites its own folder), and the
reader keeps, per window, the row of the latest batch: the window's mean over
all its rows so far. Windows older than the watermark are dropped from the
state, and rows of a window that ended behind the watermark of the batch
before are not counted (Spark's rule for late rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from promptmill.streaming.exactly_once import BATCH, COMMITS, committed_batches
from promptmill.workspace import path_exists, touch


def window_means(scored: DataFrame, names: Sequence[str], step: str = "step", logging_steps: int = 10, late_steps: int = 100) -> DataFrame:
    """(logging_step, n, means of ``names``) of a stream, by windows of ``logging_steps`` steps.

    ``logging_step`` is the first step of the window. Rows without a step are
    not counted; a mean over no values is null.
    """
    at = F.timestamp_seconds(F.col(step).cast("bigint"))
    timed = scored.where(F.col(step).isNotNull()).withColumn("__at", at).withWatermark("__at", f"{late_steps} seconds")
    grouped = timed.groupBy(F.window("__at", f"{logging_steps} seconds").alias("__window"))
    means = grouped.agg(F.count("*").alias("n"), *[F.avg(name).alias(name) for name in names])
    return means.select(F.unix_seconds(F.col("__window.start")).alias("logging_step"), "n", *names)


def write_window_means(means: DataFrame, folder: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start writing the changed windows of each batch under its id, then its marker."""

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{BATCH}={batch_id}")
        touch(batch.sparkSession, f"{folder}/{COMMITS}/{batch_id}")

    writer = means.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_window_means(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Each window's latest row among the committed batches."""
    done = [b for b in committed_batches(spark, folder) if path_exists(spark, f"{folder}/{BATCH}={b}")]
    if not done:
        return spark.createDataFrame([], schema)
    rows = spark.read.option("basePath", folder).schema(schema.add(BATCH, "long")).parquet(*[f"{folder}/{BATCH}={b}" for b in done])
    names = [f.name for f in schema.fields if f.name not in ("logging_step", BATCH)]
    latest = rows.groupBy("logging_step").agg(F.max_by(F.struct(*names), F.col(BATCH)).alias("last"))
    return latest.select("logging_step", "last.*")


def run_window_means(means: DataFrame, folder: str, checkpoint: str) -> DataFrame:
    """Process what has arrived, then read each window's mean."""
    query = write_window_means(means, folder, checkpoint)
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return read_window_means(means.sparkSession, folder, means.schema)
