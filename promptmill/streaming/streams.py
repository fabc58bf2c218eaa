"""Formatting and scoring of rows as they arrive.

Both work row by row (scoring against a static prompt table), so no state is
kept and no watermark is needed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from promptmill.functions.rewards import RewardList
from promptmill.operators.instructions import InstructionOptions, format_instructions
from promptmill.operators.scoring import attach_gold, score_completions


def read_arriving(
    spark: SparkSession, path: str, schema: StructType | str, format: str = "parquet", **options
) -> DataFrame:
    """Files of a folder as a stream."""
    return spark.readStream.format(format).schema(schema).options(**options).load(path)


def stream_format(
    arriving: DataFrame, options: InstructionOptions = InstructionOptions()
) -> DataFrame:
    """Arriving instruction rows with their training text."""
    return format_instructions(arriving, options)


def stream_score(
    arriving: DataFrame,
    prompts: DataFrame,
    rewards: RewardList | None = None,
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Arriving completions with gold text and scores."""
    return score_completions(attach_gold(arriving, prompts), rewards, weights)


def write_arriving(
    df: DataFrame,
    path: str,
    checkpoint: str,
    format: str = "parquet",
    available_now: bool = True,
) -> StreamingQuery:
    """Append to a folder exactly once, for what is there now or continuously."""
    writer = (
        df.writeStream.format(format)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def run_to_end(
    transform: Callable[[DataFrame], DataFrame], arriving: DataFrame, path: str, checkpoint: str
) -> DataFrame:
    """Process what has arrived, then read the written result."""
    result = transform(arriving)
    query = write_arriving(result, path, checkpoint)
    query.awaitTermination()
    return arriving.sparkSession.read.schema(result.schema).parquet(path)
