"""Completion scoring and statistics over the completions of a prompt."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from promptmill.functions.chat import build_chat_prompt
from promptmill.functions.rewards import (
    CompletionColumns,
    RewardList,
    default_rewards,
    total_reward,
)
from promptmill.functions.text import (
    extract_hash_answer,
    extract_xml_answer,
    first_message_content,
)


def build_prompts(df: DataFrame, system_prompt: str | None = None) -> DataFrame:
    """Add ``prompt`` messages and replace ``answer`` by the gold text behind its marker.

    A row without marker keeps its prompt and gets a null answer.
    """
    return df.withColumns(
        {
            "prompt": build_chat_prompt(F.col("question"), system_prompt),
            "answer": extract_hash_answer(F.col("answer")),
        }
    )


def attach_gold(
    completions: DataFrame, prompts: DataFrame, on: str = "prompt_id", gold: str = "answer"
) -> DataFrame:
    """Add each completion's gold text; completions without a prompt get null.

    ``on`` must be unique in ``prompts``. The join strategy is left to adaptive
    execution, which broadcasts a side only if it turns out small and splits a
    prompt that holds a large share of the completions.
    """
    table = prompts.select(on, F.col(gold).alias("gold"))
    return completions.join(table, on, "left")


def score_completions(
    df: DataFrame,
    rewards: RewardList | None = None,
    weights: dict[str, float] | None = None,
    completion: str = "completion",
    gold: str = "gold",
    prompt: str | None = None,
) -> DataFrame:
    """Add one double column per reward and their sum ``reward_total``.

    A completion is a text, or a list of messages whose first one counts.
    """
    rewards = rewards or default_rewards()
    spoken = F.col(completion)
    if isinstance(df.schema[completion].dataType, T.ArrayType):
        spoken = first_message_content(spoken)
    columns = CompletionColumns(
        completion=spoken,
        extracted=F.col("extracted"),
        gold=F.col(gold),
        prompt=F.col(prompt) if prompt else None,
    )
    scored = df.withColumn("extracted", extract_xml_answer(spoken)).withColumns(
        {name: reward(columns) for name, reward in rewards.items()}
    )
    return scored.withColumn("reward_total", total_reward(rewards.names(), weights))


def reward_by_function(
    scored: DataFrame, names: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Mean of each reward in long form, over the table or per logging window."""
    means = scored.groupBy(*by).agg(*[F.avg(name).alias(name) for name in names])
    return means.unpivot(list(by), list(names), "reward_name", "mean_reward")


def group_reward_stats(
    scored: DataFrame, group: str = "prompt_id", reward: str = "reward_total"
) -> DataFrame:
    """Count, mean, sample standard deviation and maximum per group.

    The deviation of a group of one is null. Rows are combined before they are
    shuffled, so a group of any size costs one row per input partition.
    """
    value = F.col(reward)
    return scored.groupBy(group).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean_reward"),
        F.stddev_samp(value).alias("std_reward"),
        F.max(value).alias("max_reward"),
    )


def best_of_n(
    scored: DataFrame,
    id: str,
    group: str = "prompt_id",
    reward: str = "reward_total",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The row with the highest reward of each group; of equals the one with the smallest id.

    Rows without a reward come last. Rows are combined before they are shuffled,
    so a group of any size costs one row per input partition.
    """
    order = F.struct(F.col(reward).alias("reward"), (-F.col(id)).alias("id"))
    best = F.max_by(F.struct(id, *keep, reward), order).alias("best")
    return scored.groupBy(group).agg(best).select(group, "best.*")


def _advantage(value: Column, epsilon: float) -> Column:
    deviation = F.col("std_reward") + F.lit(epsilon)
    # Equal rewards differ from their mean by rounding noise at most.
    same = F.col("std_reward").isNull() | (F.col("min_reward") == F.col("max_reward"))
    return F.when(same, F.lit(0.0)).otherwise((value - F.col("mean_reward")) / deviation)


def group_advantage(
    scored: DataFrame,
    group: str = "prompt_id",
    reward: str = "reward_total",
    epsilon: float = 1e-4,
) -> DataFrame:
    """Add ``advantage``: reward less group mean, over group deviation plus epsilon.

    A group of one gets 0. Joining pre-aggregated statistics rather than using
    a window lets adaptive execution split a group that holds a large share of
    all rows; a window would put it into one task.
    """
    stats = scored.groupBy(F.col(group).alias("stat_group")).agg(
        F.avg(reward).alias("mean_reward"),
        F.stddev_samp(reward).alias("std_reward"),
        F.min(reward).alias("min_reward"),
        F.max(reward).alias("max_reward"),
    )
    return (
        scored.join(stats, scored[group].eqNullSafe(stats["stat_group"]), "left")
        .withColumn("advantage", _advantage(F.col(reward), epsilon))
        .drop("stat_group", "mean_reward", "std_reward", "min_reward", "max_reward")
    )
