"""Scores of a completion as double columns, and the ordered list of them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, Row
from pyspark.sql import functions as F

from promptmill.functions.text import (
    WHITESPACE_CLASS,
    count_occurrences,
    is_digit,
    tail_after_last,
)

# The two completion layouts. (?d) limits "." and "$" to the
# newline character, which is how Python reads these patterns; \A stands for
# the anchored start of a match.
STRICT_LAYOUT = (
    r"(?d)\A<reasoning>\n.*?\n</reasoning>\n<answer>\n.*?\n</answer>\n\n?\z"
)
SOFT_LAYOUT = (
    r"(?d)\A<reasoning>.*?</reasoning>[" + WHITESPACE_CLASS + r"]*<answer>.*?</answer>"
)


def _score(condition: Column, points: float) -> Column:
    return F.when(condition, F.lit(points)).otherwise(F.lit(0.0))


def reward_correctness(extracted: Column, gold: Column) -> Column:
    """2.0 when the extracted answer is exactly the gold text; null gold scores 0."""
    return _score(extracted == gold, 2.0)


def reward_integer(extracted: Column) -> Column:
    """0.5 when the extracted answer consists of digits."""
    return _score(is_digit(extracted), 0.5)


def reward_strict_format(completion: Column) -> Column:
    """0.5 when the whole text has the multi-line tagged layout."""
    return _score(F.rlike(completion, F.lit(STRICT_LAYOUT)), 0.5)


def reward_soft_format(completion: Column) -> Column:
    """0.5 when the text starts with one-line reasoning followed by an answer."""
    return _score(F.rlike(completion, F.lit(SOFT_LAYOUT)), 0.5)


def reward_xml_count(completion: Column) -> Column:
    """0.125 per marker that occurs exactly once, less 0.001 per trailing character.

    A text that ends in the closing tag without newline gains 0.001, and a long
    tail makes the score negative. Additions keep one fixed order, so equal
    texts give bit-equal scores.
    """
    share, per_char = F.lit(0.125), F.lit(0.001)
    once = {
        marker: count_occurrences(completion, marker) == 1
        for marker in ("<reasoning>\n", "\n</reasoning>\n", "\n<answer>\n", "\n</answer>")
    }
    tail = F.length(tail_after_last(completion, "\n</answer>\n"))
    short_tail = F.length(tail_after_last(completion, "\n</answer>")) - F.lit(1)

    # Each count stands in one condition, so a text is searched once per marker.
    score = F.when(once["<reasoning>\n"], share).otherwise(F.lit(0.0))
    score = score + F.when(once["\n</reasoning>\n"], share).otherwise(F.lit(0.0))
    opened = F.when(once["\n<answer>\n"], F.struct(share.alias("gain"), (tail * per_char).alias("loss")))
    closed = F.when(once["\n</answer>"], F.struct(share.alias("gain"), (short_tail * per_char).alias("loss")))
    for part in (opened, closed):
        part = F.coalesce(part, F.struct(F.lit(0.0).alias("gain"), F.lit(0.0).alias("loss")))
        score = score + part["gain"] - part["loss"]
    return score


@dataclass(frozen=True)
class CompletionColumns:
    """The columns a reward may read."""

    completion: Column
    extracted: Column
    gold: Column
    prompt: Column | None = None


RewardColumn = Callable[[CompletionColumns], Column]


def python_reward(
    function: Callable[..., Sequence[float]], extra: dict[str, Column] | None = None
) -> RewardColumn:
    """Wrap a list-based Python reward ``f(prompts, completions, answer, **columns)``.

    The function sees one Arrow batch at a time: ``completions`` as lists of
    one assistant message, ``prompts`` as lists of messages (empty ones when no
    prompt column is given), further columns as lists.
    """
    extra = dict(extra or {})

    def as_messages(cell) -> list[dict]:
        return [m.asDict() if isinstance(m, Row) else dict(m) for m in cell]

    def scorer(names: list[str], with_prompt: bool):
        def score(*batch: pd.Series) -> pd.Series:
            completions, gold, *rest = (column.tolist() for column in batch)
            prompts = [as_messages(cell) for cell in rest.pop()] if with_prompt else None
            scores = function(
                prompts=prompts or [[] for _ in completions],
                completions=[[{"role": "assistant", "content": text}] for text in completions],
                answer=gold,
                **dict(zip(names, rest)),
            )
            return pd.Series(scores, dtype="float64")

        return F.pandas_udf(score, "double")

    def build(columns: CompletionColumns) -> Column:
        prompt = [] if columns.prompt is None else [columns.prompt]
        score = scorer(list(extra), bool(prompt))
        return score(columns.completion, columns.gold, *extra.values(), *prompt)

    return build


class RewardList:
    """Ordered, extensible list of named rewards."""

    def __init__(self, rewards: dict[str, RewardColumn] | None = None):
        self._rewards = dict(rewards or {})

    def with_reward(self, name: str, reward: RewardColumn) -> RewardList:
        """A list with one more reward at its end (or the named one replaced)."""
        return RewardList({**self._rewards, name: reward})

    def without(self, name: str) -> RewardList:
        return RewardList({k: v for k, v in self._rewards.items() if k != name})

    def names(self) -> list[str]:
        return list(self._rewards)

    def items(self):
        return self._rewards.items()


def default_rewards() -> RewardList:
    """The five built-in rewards in scoring order."""
    return RewardList(
        {
            "reward_xml_count": lambda c: reward_xml_count(c.completion),
            "reward_soft_format": lambda c: reward_soft_format(c.completion),
            "reward_strict_format": lambda c: reward_strict_format(c.completion),
            "reward_integer": lambda c: reward_integer(c.extracted),
            "reward_correctness": lambda c: reward_correctness(c.extracted, c.gold),
        }
    )


def total_reward(names: Sequence[str], weights: dict[str, float] | None = None) -> Column:
    """Sum of the named reward columns, each times its weight (1 by default)."""
    weights = weights or {}
    unknown = set(weights) - set(names)
    if unknown:
        raise ValueError(f"weights for unknown rewards: {sorted(unknown)}")
    total = None
    for name in names:
        term = F.col(name) if name not in weights else F.col(name) * F.lit(float(weights[name]))
        total = term if total is None else total + term
    return F.lit(0.0) if total is None else total
