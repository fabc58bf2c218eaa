"""Finished sets as Parquet or JSON lines, and the rejects beside them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _write(df: DataFrame, path: str, format: str, mode: str, by: Sequence[str] = ()) -> None:
    writer = df.write.format(format).mode(mode)
    if by:
        writer = writer.partitionBy(*by)
    writer.save(path)


def write_training_set(
    df: DataFrame, path: str, split: str = "train", format: str = "parquet", mode: str = "overwrite"
) -> None:
    """Rows with their ``text`` into the folder of a split."""
    if "text" not in df.columns:
        raise ValueError("a training set needs a text column")
    target = df if "split" in df.columns else df.withColumn("split", F.lit(split))
    _write(target, path, format, mode, ["split"])


def write_prompt_set(
    df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite"
) -> None:
    """Prompt messages with their answers."""
    missing = {"prompt", "answer"} - set(df.columns)
    if missing:
        raise ValueError(f"a prompt set lacks {sorted(missing)}")
    _write(df, path, format, mode)


def write_vision_set(
    df: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite"
) -> None:
    """Conversations as they are; all columns pass through."""
    if "messages" not in df.columns:
        raise ValueError("a vision set needs a messages column")
    _write(df, path, format, mode)


def write_rejects(
    labelled: DataFrame, path: str, format: str = "parquet", mode: str = "overwrite"
) -> None:
    """Rejected rows or files in one folder per reason."""
    _write(labelled.where(F.col("reject_reason").isNotNull()), path, format, mode, ["reject_reason"])


def write_schedule_shards(scheduled: DataFrame, path: str, steps_per_shard: int) -> None:
    """Scheduled rows in numbered shards of ``steps_per_shard`` optimizer steps, in order, with a range manifest.

    ``scheduled`` has ``step`` (and ``micro_step``, ``rank`` as ``training_schedule``
    gives them). Each shard is its own folder ``rows/shard=N``, its rows sorted by
    step; shards hold equal numbers of steps, so no task gets more than one
    shard's rows. The manifest (shard, first_step, last_step, n_rows) is counted
    from the written rows, reading their steps only.
    """
    shard = F.expr(f"step div {int(steps_per_shard)}L")
    placed = scheduled.withColumn("shard", shard).repartition("shard").sortWithinPartitions("step", "micro_step", "rank")
    placed.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/rows")
    written = scheduled.sparkSession.read.parquet(f"{path}/rows").select("shard", "step")
    manifest = written.groupBy("shard").agg(
        F.min("step").alias("first_step"), F.max("step").alias("last_step"), F.count(F.lit(1)).alias("n_rows")
    )
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest")


def read_from_step(spark, path: str, step: int) -> DataFrame:
    """The scheduled rows from ``step`` on; only shards that reach it are opened (the manifest says which).

    The manifest has one row per shard, so it is read on the driver.
    """
    shards = [r.shard for r in spark.read.parquet(f"{path}/manifest").where(F.col("last_step") >= step).select("shard").collect()]
    if not shards:
        return spark.read.parquet(f"{path}/rows").drop("shard").limit(0)
    rows = spark.read.option("basePath", f"{path}/rows").parquet(*[f"{path}/rows/shard={s}" for s in sorted(shards)])
    return rows.where(F.col("step") >= step).drop("shard")
