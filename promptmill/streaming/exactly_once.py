"""Samples and rejects of one stream in two folders, exactly once.

Each micro-batch is written by ``foreachBatch`` into a folder named by its batch
id in both places, overwriting whatever an earlier attempt of the same batch
left, and then a commit marker for the id is written. A batch that Spark runs
again after a failure (same id, same input offsets) therefore replaces its own
files and changes nothing else; readers take only batches with a marker, so
they never see the samples of a batch without its rejects.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from promptmill.workspace import path_exists, touch

COMMITS = "_commits"
BATCH = "batch_id"


def _jvm_list(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder on whatever file system it names; none if it does not exist."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    return [status.getPath().getName() for status in system.listStatus(path)]


def committed_batches(spark: SparkSession, folder: str) -> list[int]:
    """Ids of the batches whose samples and rejects are both written (one marker a batch)."""
    return sorted(int(name) for name in _jvm_list(spark, f"{folder}/{COMMITS}") if name.isdigit())


def write_batch(batch: DataFrame, batch_id: int, samples: str, rejects: str, reason: str = "reject_reason") -> None:
    """One micro-batch into both folders, then its marker; safe to repeat with the same id.

    Rejects are kept in one folder per reason below the batch's folder.
    """
    spark = batch.sparkSession
    batch.persist()
    try:
        batch.where(F.col(reason).isNull()).drop(reason).write.mode("overwrite").parquet(f"{samples}/{BATCH}={batch_id}")
        batch.where(F.col(reason).isNotNull()).write.mode("overwrite").partitionBy(reason).parquet(f"{rejects}/{BATCH}={batch_id}")
    finally:
        batch.unpersist()
    touch(spark, f"{samples}/{COMMITS}/{batch_id}")


def write_samples_and_rejects(
    labelled: DataFrame, samples: str, rejects: str, checkpoint: str, reason: str = "reject_reason", available_now: bool = True
) -> StreamingQuery:
    """Start a stream whose rows with a null ``reason`` go to ``samples`` and the rest to ``rejects``."""
    writer = labelled.writeStream.foreachBatch(
        lambda batch, batch_id: write_batch(batch, batch_id, samples, rejects, reason)
    ).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_committed(spark: SparkSession, folder: str, marks: str, schema: StructType) -> DataFrame:
    """Rows of the committed batches of a folder written by ``write_batch``; ``marks`` is the samples folder.

    ``schema`` is that of the rows with ``batch_id`` (and, for rejects, the
    reason) last. A batch folder without its marker (an attempt cut short) is
    left out.
    """
    done = [b for b in committed_batches(spark, marks) if path_exists(spark, f"{folder}/{BATCH}={b}")]
    if not done:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", folder).schema(schema)
    return reader.parquet(*[f"{folder}/{BATCH}={b}" for b in done])


def run_split_stream(
    transform: Callable[[DataFrame], DataFrame], arriving: DataFrame, samples: str, rejects: str, checkpoint: str
) -> tuple[DataFrame, DataFrame]:
    """Process what has arrived into both folders, then read the committed samples and rejects."""
    query = write_samples_and_rejects(transform(arriving), samples, rejects, checkpoint)
    try:
        query.awaitTermination()
    finally:
        query.stop()
    spark = arriving.sparkSession
    labelled = transform(arriving).schema
    batch = StructField(BATCH, LongType())
    kept = StructType([f for f in labelled.fields if f.name != "reject_reason"] + [batch])
    gone = StructType([f for f in labelled.fields if f.name != "reject_reason"] + [batch, labelled["reject_reason"]])
    return read_committed(spark, samples, samples, kept), read_committed(spark, rejects, samples, gone)
